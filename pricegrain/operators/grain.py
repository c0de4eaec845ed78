"""Daily grain, ordered deduplication, latest snapshots and idempotent replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CAPTURE_ORDER

DAY_KEY = ("capture_date", "station_key", "grade_raw")


def daily_grain(captures: DataFrame, key=DAY_KEY, order=CAPTURE_ORDER, price: str = "price") -> DataFrame:
    """The newest row of each key with the number of captures and the day's lowest and highest price.

    One shuffle: the newest row is an aggregate like the others, so partial results meet on the key and
    no join follows.
    """
    rest = [c for c in captures.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    out = captures.groupBy(*key).agg(newest.alias("_row"), F.count_distinct("capture_id").alias("n_captures"), F.min(price).alias("price_min"), F.max(price).alias("price_max"))
    return out.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in captures.columns], "n_captures", "price_min", "price_max")


def keep_first(df: DataFrame, key, order: list[Column]) -> DataFrame:
    """The first row of each key in an order that must be total for the result to be defined."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def dedupe_daily(daily: DataFrame, priorities: DataFrame) -> DataFrame:
    """One row per (capture_date, station_key, grade) without ``other``: later capture, then higher priority.

    ``priorities`` has country, brand, grade_raw and priority; labels it lacks have priority 0. Rows that
    tie in both are ordered by their label.
    """
    known = priorities.select("country", "brand", "grade_raw", F.col("priority").alias("_priority"))  # a row for each label of a chain
    ranked = daily.where(F.col("grade") != "other").join(F.broadcast(known), ["country", "brand", "grade_raw"], "left")
    key = ["capture_date", "station_key", "grade"]
    rest = F.struct(*[c for c in daily.columns if c not in key])
    # greatest of (time, priority, label in reverse): labels are compared by their bytes, turned over
    order = F.struct("captured_at_utc", F.coalesce("_priority", F.lit(0)), _turned(F.col("grade_raw")))
    found = ranked.groupBy(*key).agg(F.max_by(rest, order).alias("_row"))
    return found.select([F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in daily.columns])


def _turned(text: Column) -> Column:
    """A text whose order is the reverse of the given one's: the complement of every byte, then an end above all."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def latest_rows(captures: DataFrame) -> DataFrame:
    """Every row of each station's newest capture; of equal labels the one with the greatest capture id."""
    newest = F.max("captured_at_utc").over(Window.partitionBy("station_key"))
    rows = captures.withColumn("_newest", newest).where("captured_at_utc = _newest").drop("_newest")
    return keep_first(rows, ["station_key", "grade_raw"], [F.desc("capture_id")])


def update_latest(previous: DataFrame, incoming: DataFrame) -> DataFrame:
    """``previous`` with the rows of each station replaced where ``incoming`` is strictly newer.

    Both sides meet once on the station: a window marks each station's newest instant on each side.
    """
    both = previous.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    own = Window.partitionBy("station_key")
    marked = both.withColumn("_in", F.max(F.when(F.col("_new"), F.col("captured_at_utc"))).over(own)).withColumn("_old", F.max(F.when(~F.col("_new"), F.col("captured_at_utc"))).over(own))
    wins = F.col("_in").isNotNull() & (F.col("_old").isNull() | (F.col("_in") > F.col("_old")))
    return marked.where(F.col("_new") == F.coalesce(wins, F.lit(False))).select(previous.columns)


def replace_partition(stored: DataFrame, incoming: DataFrame, column: str) -> DataFrame:
    """``stored`` without the values of ``column`` that ``incoming`` holds, and ``incoming``.

    Replaying the same input changes nothing. Rows whose ``column`` is null stay.
    """
    return stored.join(incoming.select(column).distinct(), column, "left_anti").select(stored.columns).unionByName(incoming.select(stored.columns))


def lost_values(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that a rewrite would lose; it must be empty."""
    return before.select(column).distinct().join(after.select(column).distinct(), column, "left_anti")


def coverage(captures: DataFrame, feeds: list[str] | None = None) -> DataFrame:
    """Distinct captures per day, one column for each feed, 0 where there is none."""
    seen = captures.select("capture_date", F.concat("country", F.lit("-"), "brand").alias("feed"), "capture_id").distinct()
    feeds = feeds if feeds is not None else sorted(r["feed"] for r in seen.select("feed").distinct().collect() if r["feed"] is not None)
    return seen.groupBy("capture_date").pivot("feed", feeds).agg(F.count(F.lit(1))).na.fill(0).orderBy("capture_date")


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
