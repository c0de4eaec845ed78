"""The station dimension: incremental upsert, full rebuild, relabelling of absent stations, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import capture_time, feed_id, join_labels, older_than, union_labels
from ..schemas import STATION

METADATA = ("source_station_id", "alt_id", "name", "name_local", "address", "city", "region", "postcode", "lat", "lon", "timezone")


def absent_status(last_seen, at, closed_after_days) -> Column:
    """``closed`` once strictly more than the threshold has passed, else ``missing``; unknowns are ``missing``."""
    days = F.nullif(closed_after_days, F.lit(0)) if isinstance(closed_after_days, Column) else F.lit(closed_after_days)
    return F.when(older_than(last_seen, at, days), "closed").otherwise("missing")


def apply_links(stations: DataFrame, links: DataFrame) -> DataFrame:
    """``superseded_by`` from the links alone: stations without a link lose any older value."""
    to = links.select(F.col("old_station_key").alias("station_key"), F.col("new_station_key").alias("_to"))  # a hand-kept list
    return stations.drop("superseded_by").join(to, "station_key", "left").withColumn("superseded_by", F.col("_to")).select(STATION.names)


def station_seen(captures: DataFrame) -> DataFrame:
    """First and last time and the sorted labels of each station."""
    return captures.groupBy("station_key").agg(F.min("captured_at_utc").alias("first_seen_utc"), F.max("captured_at_utc").alias("last_seen_utc"), join_labels(F.array_sort(F.collect_set("grade_raw"))).alias("grades_seen"))


def upsert(previous: DataFrame, incoming: DataFrame, feeds: DataFrame, links: DataFrame, capture_id: str, unreached: DataFrame | None = None, thresholds: dict[str, int] | None = None) -> DataFrame:
    """``previous`` with one capture's stations merged in; no station ever leaves.

    ``feeds`` has a row for each known feed: feed, newest (greatest merged capture id or null), status of
    this capture and disabled. A capture newer than its feed's newest overwrites the metadata, nulls
    included, and sets ``active``; an older one widens the seen times and labels alone. Absent stations are
    relabelled where this capture is newer and its feed succeeded, except the ``unreached`` (feed,
    source_station_id), or where the feed is disabled.
    """
    spark = previous.sparkSession
    days = F.create_map(*[F.lit(x) for kv in (thresholds or {}).items() for x in kv])[F.col("country")] if thresholds else F.lit(None).cast("int")
    old = previous.select("station_key", F.struct(*previous.columns).alias("o"))
    new = incoming.select("station_key", F.struct(*incoming.columns).alias("n"))
    both = old.join(new, "station_key", "full").withColumn("feed", F.coalesce(feed_id("n.country", "n.brand"), feed_id("o.country", "o.brand")))
    both = both.join(F.broadcast(feeds.select("feed", "newest", "status", "disabled")), "feed", "left").withColumnRenamed("status", "_feed_status")
    newer = F.lit(capture_id) > F.coalesce("newest", F.lit(""))
    o, n, met = F.col("o"), F.col("n"), F.col("o").isNotNull() & F.col("n").isNotNull()
    take = n.isNotNull() & (o.isNull() | newer)
    if unreached is None:
        unreached = spark.createDataFrame([], "feed string, source_station_id string")
    skipped = unreached.select(F.col("feed").alias("_f"), F.col("source_station_id").alias("_s"), F.lit(True).alias("_skipped")).distinct()
    both = both.join(skipped, (F.col("feed") == F.col("_f")) & (o["source_station_id"] == F.col("_s")), "left")
    succeeded = F.coalesce(F.col("_feed_status").isin("ok", "degraded"), F.lit(False))
    judged = n.isNull() & newer & ((succeeded & F.col("_skipped").isNull()) | (~succeeded & F.coalesce("disabled", F.lit(False))))
    out = {c: F.when(take, n[c]).otherwise(o[c]) for c in METADATA}
    out |= {c: F.coalesce(o[c], n[c]) for c in ("station_key", "country", "brand")}
    out["first_seen_utc"] = F.least(o["first_seen_utc"], n["first_seen_utc"])
    out["last_seen_utc"] = F.greatest(o["last_seen_utc"], n["last_seen_utc"])
    out["grades_seen"] = F.when(met, union_labels(o["grades_seen"], n["grades_seen"])).otherwise(F.coalesce(o["grades_seen"], n["grades_seen"]))
    out["status"] = F.when(o.isNull(), n["status"]).when(met & newer, "active").when(judged, F.lit("judged")).otherwise(o["status"])
    merged = both.select(*[out[c].alias(c) for c in STATION.names if c != "superseded_by"], F.lit(None).cast("string").alias("superseded_by"))
    merged = merged.withColumn("status", F.when(F.col("status") == "judged", absent_status("last_seen_utc", capture_time(F.lit(capture_id)), days)).otherwise(F.col("status")))
    return apply_links(merged, links)


def rebuild(captures: DataFrame, existing: DataFrame, links: DataFrame, feeds: DataFrame | None = None, unreached: DataFrame | None = None, thresholds: dict[str, int] | None = None) -> DataFrame:
    """The dimension recomputed from all captures: seen times and labels anew, everything else kept.

    Stations that ``existing`` lacks come from their newest row, ``active`` if that is in their country's
    newest capture, else ``missing``. Of those not active and not listed at the newest instant, the ones
    whose feed ``feeds`` (feed, status, disabled) lets be judged are relabelled; without ``feeds``, all.
    """
    # one pass over the captures: seen times, labels and the newest row
    row = F.struct(*[c for c in captures.columns if c != "station_key"])
    found = captures.groupBy("station_key").agg(F.min("captured_at_utc").alias("first_seen_utc"), F.max("captured_at_utc").alias("last_seen_utc"), join_labels(F.array_sort(F.collect_set("grade_raw"))).alias("grades_seen"), F.max_by(row, F.struct("captured_at_utc", "capture_id")).alias("r"))
    seen = found.drop("r")
    kept = existing.drop("first_seen_utc", "last_seen_utc", "grades_seen").join(existing.select("station_key", *[F.col(c).alias(f"_{c}") for c in ("first_seen_utc", "last_seen_utc", "grades_seen")]), "station_key").join(seen, "station_key", "left")
    kept = kept.select([F.coalesce(c, f"_{c}").alias(c) if c in ("first_seen_utc", "last_seen_utc", "grades_seen") else F.col(c) for c in STATION.names])
    country = captures.groupBy("country").agg(F.max("capture_id").alias("_newest"))
    fresh = found.join(existing.select("station_key"), "station_key", "left_anti").withColumn("country", F.col("r.country")).join(F.broadcast(country), "country", "left")
    own = {"station_key", "country", "first_seen_utc", "last_seen_utc", "grades_seen"}
    extra = {"alt_id": F.lit(None).cast("string"), "superseded_by": F.lit(None).cast("string"), "status": F.when(F.col("r.capture_id") == F.col("_newest"), "active").otherwise("missing")}
    fresh = fresh.select([extra[c].alias(c) if c in extra else F.col(c) if c in own else F.col(f"r.{c}").alias(c) for c in STATION.names])
    return apply_links(_restate(kept.unionByName(fresh), captures, feeds, unreached, thresholds, found), links)


def _restate(stations: DataFrame, captures: DataFrame, feeds, unreached, thresholds, found: DataFrame) -> DataFrame:
    spark = stations.sparkSession
    last = found.select("station_key", F.col("last_seen_utc").alias("_last"))
    at = captures.agg(F.max("captured_at_utc").alias("_at"))  # one row
    out = stations.join(last, "station_key", "left").join(F.broadcast(at), how="left").withColumn("_feed", feed_id("country", "brand"))
    days = F.create_map(*[F.lit(x) for kv in (thresholds or {}).items() for x in kv])[F.col("country")] if thresholds else F.lit(None).cast("int")
    judged = F.lit(True)
    if feeds is not None:
        if unreached is None:
            unreached = spark.createDataFrame([], "feed string, source_station_id string")
        out = out.join(F.broadcast(feeds.select(F.col("feed").alias("_feed"), F.col("status").alias("_fs"), F.col("disabled").alias("_off"))), "_feed", "left")
        out = out.join(unreached.select(F.col("feed").alias("_feed"), "source_station_id", F.lit(True).alias("_skipped")).distinct(), ["_feed", "source_station_id"], "left")
        good = F.coalesce(F.col("_fs").isin("ok", "degraded"), F.lit(False))
        judged = (good & F.col("_skipped").isNull()) | (~good & F.coalesce("_off", F.lit(False)))
    listed = F.coalesce(F.col("_last") == F.col("_at"), F.lit(False))
    change = ~listed & (F.col("status") != "active") & F.col("_at").isNotNull() & judged
    return out.withColumn("status", F.when(change, absent_status("last_seen_utc", "_at", days)).otherwise(F.col("status"))).select(STATION.names)


def seen_within(stations: DataFrame, day, days: int) -> DataFrame:
    """Stations last seen no more than ``days`` before ``day``."""
    return stations.where(F.to_date("last_seen_utc") >= F.date_sub(F.lit(day).cast("date") if not isinstance(day, Column) else day, days))


def merge_metadata(base: DataFrame, sources: list[tuple[DataFrame, Column | None]], fields, key: str = "source_station_id") -> DataFrame:
    """For each field the first non-null value over the sources in order; a source may have a condition."""
    out = base
    for i, (frame, condition) in enumerate(sources):
        out = out.join(frame.select(key, F.struct(*fields).alias(f"_s{i}"), (condition if condition is not None else F.lit(True)).alias(f"_c{i}")), key, "left")
    picks = [F.coalesce(*[F.when(F.col(f"_c{i}"), F.col(f"_s{i}.{f}")) for i in range(len(sources))]).alias(f) for f in fields]
    return out.select(*base.columns, *picks)


def newest_by_feed(statuses: DataFrame) -> DataFrame:
    """Greatest capture id of each feed whose status was ok or degraded."""
    return statuses.where(F.col("status").isin("ok", "degraded")).groupBy("feed").agg(F.max("capture_id").alias("newest"))


def expected_rows(recorded: DataFrame) -> DataFrame:
    """Rows that the greatest capture id recorded for each day."""
    return recorded.where("rows IS NOT NULL").groupBy("day").agg(F.max_by("rows", "capture_id").alias("rows"))


def first_of_each(df: DataFrame, key, order) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")
