"""Raw stations to price rows: one annotated plan, from which five consistent outputs are filtered.

The order of the rules is the order of one ``when`` chain for stations and of the columns added for
prices: gate, prices, zone, watch list, parse, grade, conflict, bounds, regular grade.
"""

from __future__ import annotations

from dataclasses import dataclass
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import feed_id, join_labels, parse_price, station_key
from ..schemas import DROPS, HELD, ROW, STATION
from . import fx as rates_of

#: A raw station: who it is, what the locator says of it, and its prices in source order.
RAW_STATION = (
    "country string, brand string, source_station_id string, alt_id string, id_origin string, ecom_state string,"
    " name string, name_local string, address string, city string, region string, postcode string, lat double,"
    " lon double, timezone string, opening_date date, has_hours boolean,"
    " prices array<struct<grade_raw:string,price_raw:string>>"
)
STATION_COLUMNS = ("source_station_id", "alt_id", "name", "name_local", "address", "city", "region", "postcode", "lat", "lon", "timezone")


@dataclass
class Dimensions:
    """Small tables of the interpretation config; every one is broadcast.

    grades: country, brand, grade_raw, grade, priority. units: country, region (null: the country's), unit.
    bounds: unit, grade_raw (null: all labels), low, high. watch: feed, source_station_id, status, publish_from.
    """

    grades: DataFrame
    units: DataFrame
    bounds: DataFrame
    watch: DataFrame


@dataclass
class Normalized:
    rows: DataFrame
    stations: DataFrame
    drops: DataFrame
    warnings: DataFrame
    held: DataFrame


def valid_zone(zone: str) -> Column:
    """Whether a zone exists; from_utc_timestamp raises on one that doesn't."""
    return F.coalesce(F.col(zone).isin(sorted(available_timezones())), F.lit(False))


def gate(day: Column) -> Column:
    """The first station-level gate that stops a station, or null. Extras pass them all."""
    return (
        F.when(F.col("id_origin") == "extra", F.lit(None).cast("string"))
        .when(F.col("ecom_state") == "no_gas", "no_gas_service")
        .when(F.col("opening_date") > day, "not_open")
        .when(~F.col("has_hours"), "no_hours")
    )


def source_filter_reason(day: Column) -> Column:
    """Why a looked-up station isn't usable, or null."""
    return F.when(F.col("opening_date") > day, "not_open").when(~F.col("has_hours"), "no_hours").when(F.coalesce(F.size("prices"), F.lit(0)) < 1, "no_price").when(F.coalesce("timezone", F.lit("")) == "", "no_timezone")


def turned_on(stations: DataFrame, watch: DataFrame, day: Column) -> DataFrame:
    """``stations`` with ``is_on``: on the watch list with status on, from its publish date."""
    on = watch.where("status = 'on' AND source_station_id <> '' AND publish_from <> ''").select(F.col("feed").alias("_f"), F.col("source_station_id").alias("_s"), F.col("publish_from").cast("date").alias("_from"))
    out = stations.withColumn("feed", feed_id("country", "brand")).join(F.broadcast(on), (F.col("feed") == F.col("_f")) & (F.col("source_station_id") == F.col("_s")), "left")
    return out.withColumn("is_on", F.coalesce(F.col("_from") <= day, F.lit(False))).drop("_f", "_s", "_from")


def with_unit(stations: DataFrame, units: DataFrame) -> DataFrame:
    """``stations`` with price_unit: the region's, else the country's."""
    own = units.where("region IS NOT NULL").select(F.col("country").alias("_c"), F.col("region").alias("_r"), F.col("unit").alias("_own"))
    general = units.where("region IS NULL").select(F.col("country").alias("_k"), F.col("unit").alias("_general"))
    out = stations.join(F.broadcast(own), (F.col("country") == F.col("_c")) & (F.col("region") == F.col("_r")), "left").join(F.broadcast(general), F.col("country") == F.col("_k"), "left")
    return out.withColumn("price_unit", F.coalesce("_own", "_general")).drop("_c", "_r", "_own", "_k", "_general")


def with_zone(stations: DataFrame, zones: DataFrame) -> DataFrame:
    """``stations`` with timezone filled from (country, region), else from the country's ``*``."""
    own = zones.where("region <> '*'").select(F.col("country").alias("_c"), F.col("region").alias("_r"), F.col("zone").alias("_own"))
    general = zones.where("region = '*'").select(F.col("country").alias("_k"), F.col("zone").alias("_general"))
    out = stations.join(F.broadcast(own), (F.col("country") == F.col("_c")) & (F.col("region") == F.col("_r")), "left").join(F.broadcast(general), F.col("country") == F.col("_k"), "left")
    return out.withColumn("timezone", F.coalesce("timezone", "_own", "_general")).drop("_c", "_r", "_own", "_k", "_general")


def with_bounds(prices: DataFrame, bounds: DataFrame) -> DataFrame:
    """``prices`` with low and high: the label's own bounds, else the unit's, else null (no check)."""
    own = bounds.where("grade_raw IS NOT NULL").select(F.col("unit").alias("_u"), F.col("grade_raw").alias("_g"), F.struct("low", "high").alias("_own"))
    general = bounds.where("grade_raw IS NULL").select(F.col("unit").alias("_v"), F.struct("low", "high").alias("_general"))
    out = prices.join(F.broadcast(own), (F.col("price_unit") == F.col("_u")) & (F.col("grade_raw") == F.col("_g")), "left").join(F.broadcast(general), F.col("price_unit") == F.col("_v"), "left")
    pick = F.coalesce("_own", "_general")
    return out.withColumn("low", pick["low"]).withColumn("high", pick["high"]).drop("_u", "_g", "_own", "_v", "_general")


def in_bounds() -> Column:
    """Inclusive; without bounds every price is in."""
    return F.coalesce(F.col("price").between(F.col("low"), F.col("high")), F.lit(True))


def with_grade(prices: DataFrame, grades: DataFrame) -> DataFrame:
    """``prices`` with grade, priority and unknown: labels without a mapping are ``other`` with priority 0."""
    known = grades.select(F.col("country").alias("_c"), F.col("brand").alias("_b"), F.col("grade_raw").alias("_g"), F.col("grade").alias("_grade"), F.col("priority").alias("_priority"))
    out = prices.join(F.broadcast(known), (F.col("country") == F.col("_c")) & (F.col("brand") == F.col("_b")) & (F.col("grade_raw") == F.col("_g")), "left")
    return out.withColumn("unknown", F.col("_grade").isNull()).withColumn("grade", F.coalesce("_grade", F.lit("other"))).withColumn("priority", F.coalesce("_priority", F.lit(0))).drop("_c", "_b", "_g", "_grade", "_priority")


def resolve_conflicts(prices: DataFrame, station: list[str], position: str = "pos") -> DataFrame:
    """``prices`` with ``lost``: of several rows of a grade at a station all but the highest priority, the
    earliest position breaking ties. Losers become ``other``. ``mapped`` keeps the grade they had."""
    place = F.row_number().over(Window.partitionBy(*station, "grade").orderBy(F.desc("priority"), F.asc(position)))
    out = prices.withColumn("mapped", F.col("grade")).withColumn("lost", (F.col("grade") != "other") & (place > 1))
    return out.withColumn("grade", F.when(F.col("lost"), "other").otherwise(F.col("grade")))


def below_regular(prices: DataFrame, station: list[str], label: str = "UNLEAD") -> DataFrame:
    """``prices`` with ``below``: under the station's own regular price; false where it has none."""
    regular = F.max(F.when(F.col("grade_raw") == label, F.col("price"))).over(Window.partitionBy(*station))
    return prices.withColumn("below", F.coalesce(F.col("price") < regular, F.lit(False)))


def normalize(stations: DataFrame, rates: DataFrame, dims: Dimensions, capture_id: str | None = None, capture_date: str | None = None, captured_at: str | None = None, source: str | None = None) -> Normalized:
    """The outputs of one or more captures of one or more feeds; ``stations`` has the columns of RAW_STATION.

    The capture is named by the arguments or, where stations of several captures are normalized at once, by columns
    ``capture_id``, ``capture_date`` and ``captured_at_utc``; so is the ``source`` of the feeds. Rows may repeat a
    station within a capture; they are told apart by their order. Drops and warnings name their feed and capture.
    """
    given = {"capture_id": F.lit(capture_id), "capture_date": F.lit(capture_date).cast("date"), "captured_at_utc": F.lit(captured_at).cast("timestamp"), "source": F.lit(source)}
    stations = stations.withColumns({c: v for c, v in given.items() if c not in stations.columns})
    day, at = F.col("capture_date"), F.col("captured_at_utc")
    base = with_unit(turned_on(stations, dims.watch, day), dims.units)
    base = base.withColumn("station_key", station_key("country", "brand", "source_station_id"))
    base = base.withColumn("_seq", F.row_number().over(Window.partitionBy("capture_id", "station_key").orderBy(F.struct("id_origin", "name", "address"))))
    stop = F.when(~F.col("is_on"), gate(day))
    priced, zoned = F.coalesce(F.size("prices"), F.lit(0)) > 0, valid_zone("timezone")
    watched = (F.col("id_origin") == "watch") & ~F.col("is_on")
    reason = F.coalesce(stop, F.when(~priced, "no_price"), F.when(~zoned, "no_timezone"), F.when(watched, "watch"))
    base = base.withColumn("gate", stop).withColumn("reason", reason)
    base = base.withColumn("disposition", F.when(F.col("reason").isNull(), "publish").when(priced & zoned, "hold").otherwise("drop"))
    own = ["capture_id", "station_key", "_seq"]
    prices = base.select("*", F.posexplode("prices").alias("pos", "p")).select("*", "p.grade_raw", "p.price_raw").drop("p", "prices")
    prices = prices.withColumn("price", parse_price("price_raw"))
    parsed = with_bounds(resolve_conflicts(with_grade(prices.where("price IS NOT NULL"), dims.grades), own), dims.bounds).withColumn("inside", in_bounds())
    regular = F.max(F.when(F.col("inside"), (F.col("grade") == "regular").cast("int"))).over(Window.partitionBy(*own))
    parsed = parsed.withColumn("has_regular", regular)
    empty_ca = (F.col("country") == "US") & (F.col("id_origin") == "seen") & (F.col("ecom_state") == "absent")
    parsed = parsed.withColumn("refused", F.coalesce((F.col("has_regular") == 0) & empty_ca & (F.col("disposition") == "publish"), F.lit(False)))

    surviving = parsed.where("inside")
    origin = F.when((F.col("country") == "US") & (F.col("id_origin") == "lookup"), "costco-ca-lookup-us").when((F.col("country") == "CA") & (F.col("id_origin") == "cache"), "costco-ca-gasprices").otherwise(F.col("source"))
    records = surviving.withColumn("source", origin)
    zone = F.when(valid_zone("timezone"), F.col("timezone"))
    records = rates_of.apply(records.withColumn("local_date", F.to_date(F.from_utc_timestamp("captured_at_utc", zone))), rates)
    published = records.where("disposition = 'publish' AND NOT refused")
    holdable = records.where("disposition = 'hold'").withColumn("hold_reason", F.col("reason"))
    broken = F.max(F.col("name").isNull().cast("int")).over(Window.partitionBy("capture_id", "station_key"))
    holdable = holdable.withColumn("_bad", broken)
    held = holdable.where("_seq = 1 AND _bad = 0")

    said_of = ("feed", "capture_id")
    detail = lambda df, reason, text: df.select("source_station_id", F.lit(reason).alias("reason"), text.alias("detail"), *said_of)
    in_play = parsed.where("disposition = 'publish'")
    posted = F.concat("grade_raw", F.lit("="), "price_raw")
    drops = base.where("reason IS NOT NULL").select("source_station_id", "reason", F.lit("").alias("detail"), *said_of)
    drops = drops.union(detail(prices.where("price IS NULL AND disposition = 'publish'"), "unparseable_price", posted))
    drops = drops.union(detail(in_play.where("NOT inside"), "out_of_bounds", F.concat(posted, F.lit(" "), "price_unit")))
    drops = drops.union(detail(in_play.where("refused").dropDuplicates(own), "no_regular", F.lit("")))

    warn = lambda df, code, text: df.select(F.lit(code).alias("code"), text.alias("detail"), *said_of)
    warnings = warn(in_play.where("unknown").select("grade_raw", *said_of).distinct(), "unknown_grade", F.col("grade_raw"))
    warnings = warnings.union(warn(in_play.where("lost"), "grade_conflict", F.concat_ws(":", "station_key", "mapped", "grade_raw")))
    warnings = warnings.union(warn(in_play.where("inside AND has_regular = 0 AND NOT refused").dropDuplicates(own), "no_regular", F.col("source_station_id")))
    early = parsed.where("gate IN ('not_open', 'no_hours') AND inside AND mapped = 'regular'").dropDuplicates(own)
    warnings = warnings.union(warn(early, "priced_before_open", F.col("source_station_id")))
    warnings = warnings.union(warn(holdable.where("_seq > 1 OR _bad = 1").dropDuplicates(own), "held_rows_invalid", F.col("source_station_id")))

    labels = published.groupBy(*own, "country", "brand", "captured_at_utc").agg(F.first(F.struct(*STATION_COLUMNS)).alias("s"), join_labels(F.array_sort(F.collect_set("grade_raw"))).alias("grades_seen"))
    made = {"first_seen_utc": at, "last_seen_utc": at, "status": F.lit("active"), "superseded_by": F.lit(None).cast("string")}
    listed = labels.select([made[c].alias(c) if c in made else F.col(f"s.{c}").alias(c) if c in STATION_COLUMNS else F.col(c) for c in STATION.names])
    return Normalized(published.select(ROW.names), listed, drops.select(*DROPS.names, *said_of), warnings, held.select(HELD.names))
