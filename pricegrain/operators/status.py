"""Feed health: fingerprints, drop counts, verdicts, streaks and the roll-up to countries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import capture_time, feed_country, feed_id, older_than
from .constants import FLOORS, OUT_OF_BOUNDS_SHARE, RECENT_ERRORS, STALE_AFTER_DAYS, STALE_AFTER_DEFAULT, STATUS_RANK

#: Sources of fallback prices, and the warnings that degrade a feed.
FALLBACK_SOURCES = ("costco-ca-lookup-us", "costco-ca-gasprices")
DEGRADING = ("metadata_from_cache", "previous_state_unavailable", "fallback_used", "unknown_grade", "budget_exhausted", "sweep_abandoned")


def fingerprint(rows: DataFrame, keys: list[str], parts=("station_key", "grade_raw", "price_raw")) -> DataFrame:
    """SHA-256 of each group's sorted tuples, tab-separated and newline-ended.

    Tuples are sorted before they become lines: a line order would differ where a key is another's prefix.
    """
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*parts))), lambda t: F.concat(*[x for i, p in enumerate(parts) for x in ((F.lit("\t"), t[p]) if i else (t[p],))], F.lit("\n")))
    return rows.groupBy(*keys).agg(F.concat(F.lit("sha256:"), F.sha2(F.array_join(lines, ""), 256)).alias("price_fingerprint"))


def drop_counts(drops: DataFrame, *keys: str) -> DataFrame:
    return drops.groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n"))


def held_reasons(held: DataFrame) -> DataFrame:
    """Station and reason of everything recorded without being published."""
    return held.select("source_station_id", "hold_reason").distinct().orderBy("source_station_id", "hold_reason")


def error_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("http_status", "code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "http_status", "code")


def duration(responses: DataFrame, *keys: str) -> DataFrame:
    """Seconds from the first request leaving to the last response arriving, to one decimal."""
    end = F.unix_micros("received_at_utc")
    span = (F.max(end) - F.min(end - F.col("elapsed_ms") * 1000)) / 1e6
    return responses.groupBy(*keys).agg(F.round(span, 1).alias("duration_s"))


def evaluate(feeds: DataFrame, rows: DataFrame, drops: DataFrame, warnings: DataFrame, previous: DataFrame, capture_id: str, now: str) -> DataFrame:
    """The status row of every feed.

    feeds: feed, ran. rows: price rows. drops: feed, reason. warnings: feed, code. previous: feed,
    price_fingerprint, unchanged_since_capture_id, consecutive_failures, last_success_capture_id,
    recent_errors (array of capture ids). A feed that didn't run is ``skipped`` and carries its state; one
    without rows ``failed``; one short of its floor, on a fallback, warned, out of bounds or stale
    ``degraded``.
    """
    keyed = rows.withColumn("feed", feed_id("country", "brand"))
    counted = keyed.groupBy("feed").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("station_key").alias("stations"), F.max(F.col("source").isin(*FALLBACK_SOURCES)).alias("fallback"))
    out = feeds.join(counted, "feed", "left").join(fingerprint(keyed, ["feed"]).withColumnRenamed("price_fingerprint", "fresh"), "feed", "left")
    out = out.join(drops.where("reason = 'out_of_bounds'").groupBy("feed").agg(F.count(F.lit(1)).alias("outside")), "feed", "left")
    out = out.join(warnings.groupBy("feed").agg(F.max(F.col("code").isin(*DEGRADING)).alias("warned")), "feed", "left").join(previous, "feed", "left").na.fill(0, ["rows", "stations", "outside"])
    own, floors = feed_country("feed"), F.create_map(*[F.lit(x) for kv in FLOORS.items() for x in kv])
    days = F.coalesce(F.create_map(*[F.lit(x) for kv in STALE_AFTER_DAYS.items() for x in kv])[own], F.lit(STALE_AFTER_DEFAULT))
    same = (F.col("price_fingerprint") == F.col("fresh")) & F.col("unchanged_since_capture_id").isNotNull()
    since = F.when(same, F.col("unchanged_since_capture_id")).otherwise(F.lit(capture_id))
    stale = F.coalesce(older_than(capture_time(since), F.lit(now).cast("timestamp"), days), F.lit(False))
    short = F.col("stations") < F.coalesce(floors[F.col("feed")], floors[own], F.lit(0))
    share = F.col("outside") / (F.col("rows") + F.col("outside")) > OUT_OF_BOUNDS_SHARE
    degraded = short | F.coalesce("fallback", F.lit(False)) | F.coalesce("warned", F.lit(False)) | share | stale
    status = F.when(~F.col("ran"), "skipped").when(F.col("rows") == 0, "failed").when(degraded, "degraded").otherwise("ok")
    out = out.withColumn("_status", status).withColumn("_good", F.col("ran") & (F.col("rows") > 0)).withColumn("_since", since)
    failures = F.coalesce(F.col("consecutive_failures"), F.lit(0))
    recent = F.coalesce("recent_errors", F.array().cast("array<string>"))
    return out.select(
        "feed",
        F.col("_status").alias("status"),
        "rows",
        "stations",
        F.when(F.col("_good"), F.col("fresh")).otherwise(F.col("price_fingerprint")).alias("price_fingerprint"),
        F.when(F.col("_good"), F.col("_since")).otherwise(F.col("unchanged_since_capture_id")).alias("unchanged_since_capture_id"),
        F.when(F.col("_good"), 0).when(F.col("ran"), failures + 1).otherwise(failures).alias("consecutive_failures"),
        F.when(F.col("_good"), F.lit(capture_id)).otherwise(F.col("last_success_capture_id")).alias("last_success_capture_id"),
        F.when(F.col("_status") == "failed", F.slice(F.concat(F.array(F.lit(capture_id)), recent), 1, RECENT_ERRORS)).otherwise(recent).alias("recent_errors"),
    )


def rollup(statuses: DataFrame) -> DataFrame:
    """One row per country: worst status, summed counts, sorted feeds, newest success."""
    ranks = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    names = F.create_map(*[F.lit(x) for k, v in STATUS_RANK.items() for x in (v, k)])
    worst = F.min(F.coalesce(ranks[F.col("status")], F.lit(3)))
    return statuses.groupBy(feed_country("feed").alias("country")).agg(
        names[worst].alias("status"), F.sum("rows").alias("rows"), F.sum("stations").alias("stations"), F.array_sort(F.collect_list("feed")).alias("feeds"), F.max("last_success_capture_id").alias("last_success_capture_id")
    )


def all_failed(statuses: DataFrame) -> bool:
    return not statuses.where(F.col("status").isin("ok", "degraded")).limit(1).count()


def unchanged_runs(history: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``history`` with the run number of equal consecutive values and the run's first order value."""
    own = Window.partitionBy(*group).orderBy(*order)
    before = F.lag(value).over(own)
    new = F.when(F.row_number().over(own) == 1, 1).otherwise((~F.col(value).eqNullSafe(before)).cast("int"))
    out = history.withColumn("_new", new).withColumn("run", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("unchanged_since", F.first(order[0]).over(Window.partitionBy(*group, "run").orderBy(*order))).drop("_new")


def failure_streaks(statuses: DataFrame) -> DataFrame:
    """``statuses`` (feed, capture_id, status) with consecutive failures: reset by a success, carried by a skip."""
    own = Window.partitionBy("feed").orderBy("capture_id")
    marked = statuses.withColumn("_run", F.count_if(F.col("status").isin("ok", "degraded")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.count_if(F.col("status") == "failed").over(Window.partitionBy("feed", "_run").orderBy("capture_id").rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("consecutive_failures", streak).drop("_run")
