"""Id sets: candidates, rosters, batches, plausible reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import numeric_first
from .constants import ID_BATCH, LOOK_AHEAD

PRE_OPEN = (3.999, 5.999)  # fixed values: regular and premium of a warehouse that doesn't sell yet


def candidate_ids(known: DataFrame, excluded: DataFrame, ahead: int = LOOK_AHEAD) -> DataFrame:
    """Ids from 1 to the greatest known plus ``ahead`` that aren't excluded. Both inputs have a long ``id``."""
    spark = known.sparkSession
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return spark.range(1, top + ahead + 1).join(excluded.select("id").distinct(), "id", "left_anti")


def roster(*lists: DataFrame) -> DataFrame:
    """Distinct ids of several lists of ``source_station_id``, numbers first and by value."""
    out = lists[0].select("source_station_id")
    for x in lists[1:]:
        out = out.union(x.select("source_station_id"))
    return out.distinct().orderBy(*numeric_first("source_station_id"))


def minus(a: DataFrame, *others: DataFrame, key: str = "source_station_id") -> DataFrame:
    for b in others:
        a = a.join(b.select(key).distinct(), key, "left_anti")
    return a


def batches(ids: DataFrame, key: str, size: int = ID_BATCH, group: list[str] | None = None) -> DataFrame:
    """Ids joined by commas in batches of ``size``, in order, within each ``group``.

    The order is total within a group, so one task numbers it; a request list holds thousands, not
    millions. A group keeps the numbering apart for larger inputs.
    """
    group = group or []
    order = Window.partitionBy(*group).orderBy(key) if group else Window.partitionBy(F.lit(0)).orderBy(key)
    numbered = ids.withColumn("batch", F.floor((F.row_number().over(order) - 1) / size))
    return numbered.groupBy(*group, "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("ids"), F.count(F.lit(1)).alias("n_ids"))


def reportable(prices: DataFrame, low: float, high: float) -> DataFrame:
    """Rows (regular, premium) that a discovery may report: a regular price in bounds that isn't the placeholder."""
    placeholder = (F.col("regular") == PRE_OPEN[0]) & (F.col("premium") == PRE_OPEN[1])
    return prices.where(F.col("regular").between(low, high) & ~F.coalesce(placeholder, F.lit(False)))


def ecom_state(ids: DataFrame, index: DataFrame | None, country: str = "US") -> DataFrame:
    """``ids`` with what the locator (id, country, has_gas) says of each."""
    if index is None:
        return ids.withColumn("ecom_state", F.lit("unavailable"))
    own = index.select(F.col("id").alias("source_station_id"), F.col("country").alias("_country"), "has_gas")
    state = F.when(F.col("has_gas").isNull(), "absent").when((F.col("_country") == country) & F.col("has_gas"), "gas").otherwise("no_gas")
    return ids.join(own, "source_station_id", "left").withColumn("ecom_state", state).drop("_country", "has_gas")
