"""Two-level quantile summaries, change flags and the nested latest document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import HISTORY, SUMMARIES, SUMMARY
from .constants import CORE_GRADES, MOVE_EPSILON
from .validate import duplicate_probe

PRICE_FIELDS = ("grade_raw", "price_raw", "price", "price_unit", "currency", "price_local_per_litre", "price_usd_per_litre", "price_usd_per_gallon", "n_captures")
STATION_FIELDS = ("station_key", "country", "brand", "name", "name_local", "address", "city", "region", "postcode", "lat", "lon", "timezone")


def quartiles(df: DataFrame, keys: list[str], station: str, values: dict[str, str]) -> DataFrame:
    """Distinct stations (n_stations), non-null values (n_NAME) and exact quartiles (NAME: median, p25, p75) of each group.

    Quantiles interpolate linearly. One shuffle on the group and the station: distinct stations and sorted values come
    from the same rows.
    """
    q = lambda c: F.percentile(F.col(c), F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)))
    return df.groupBy(*keys).agg(F.size(F.collect_set(station)).cast("int").alias("n_stations"), *[F.count(c).cast("int").alias(f"n_{k}") for k, c in values.items()], *[q(c).alias(k) for k, c in values.items()])


def summary_daily(deduped: DataFrame, check: bool = False) -> DataFrame:
    """Exact quartiles per day, chain and grade, for whole countries and for their regions.

    Quantiles interpolate linearly; dollar figures leave out the rows without a rate; rows without a
    region enter the country level alone. Chains are never pooled.
    """
    values = {"local": "price_local_per_litre", "usd": "price_usd_per_litre"}
    levels = F.array_compact(F.array(F.struct(F.lit("country").alias("level"), F.lit(None).cast("string").alias("region")), F.when(F.col("region").isNotNull(), F.struct(F.lit("region").alias("level"), F.col("region").alias("region")))))
    rows = deduped.select("capture_date", "country", "brand", "grade", "station_key", *values.values(), F.explode(levels).alias("l")).select("*", "l.*").drop("l")
    found = quartiles(rows, ["capture_date", "country", "brand", "level", "region", "grade"], "station_key", values)
    names = {f"{stat}_{kind}_per_litre": F.col(kind)[i] for kind in values for i, stat in enumerate(("median", "p25", "p75"))}
    out = found.withColumnRenamed("n_usd", "n_stations_usd").withColumns(names).select(SUMMARY.names)
    if check and (found := duplicate_probe(out, SUMMARIES.key).limit(5).collect()):
        raise ValueError(f"summary isn't unique: {found}")
    return out


def change_flags(deduped: DataFrame, epsilon: float = MOVE_EPSILON) -> DataFrame:
    """``changed`` against the station's previous day with this grade, ``moved_intraday`` within the day.

    Null where there is nothing to compare; a gap in days is still one comparison.
    """
    before = F.lag("price_local_per_litre").over(Window.partitionBy("station_key", "grade").orderBy("capture_date"))
    intraday = F.abs(F.col("price_max") - F.col("price_min")) > epsilon if {"price_min", "price_max"} <= {*deduped.columns} else F.lit(None).cast("boolean")
    return deduped.withColumn("changed", F.abs(F.col("price_local_per_litre") - before) > epsilon).withColumn("moved_intraday", intraday)


def history(deduped: DataFrame) -> DataFrame:
    return change_flags(deduped).select(HISTORY.names)


def latest_nested(latest: DataFrame, stations: DataFrame) -> DataFrame:
    """One row per station with coordinates: its fields, and its prices as maps by grade and by label.

    Two rows of one core grade at a station are an error of the input and raise when the row is computed.
    """
    fields = [c for c in PRICE_FIELDS if c in latest.columns]
    core = F.col("grade").isin(*CORE_GRADES)
    price = F.struct(*fields)
    located = latest.where("lat IS NOT NULL AND lon IS NOT NULL")
    rest = [c for c in (*STATION_FIELDS, "captured_at_utc") if c in latest.columns and c != "station_key"]
    grouped = located.groupBy("station_key").agg(
        F.min_by(F.struct(*rest), F.col("grade_raw")).alias("_own"),
        F.array_sort(F.collect_list(F.when(core, F.struct(F.col("grade").alias("k"), price.alias("v"))))).alias("_grades"),
        F.array_sort(F.collect_list(F.when(~core | F.col("grade").isNull(), F.struct(F.col("grade_raw").alias("k"), price.alias("v"))))).alias("_other"),
    )
    names = F.transform("_grades", lambda x: x["k"])
    unique = F.when(F.size("_grades") == F.size(F.array_distinct(names)), F.map_from_entries("_grades")).otherwise(F.raise_error(F.concat(F.lit("more than one row of a core grade for "), "station_key")))
    info = stations.select("station_key", "status", "first_seen_utc")
    return grouped.join(info, "station_key", "left").select("station_key", *[F.col(f"_own.{c}").alias(c) for c in rest], "status", "first_seen_utc", unique.alias("grades"), F.map_from_entries("_other").alias("other"))
