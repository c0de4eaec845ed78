"""Structured Streaming forms of the batch plans; each micro-batch runs the same operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schemas import ROW


def rows_stream(spark: SparkSession, folder: str, schema: StructType = ROW, files_per_trigger: int = 100) -> DataFrame:
    """Capture rows as Parquet files arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def merge_stream(rows: DataFrame, merge: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch by ``merge``, which must replace by key: a replayed batch then changes nothing."""

    def each(batch: DataFrame, _: int) -> None:
        if batch.limit(1).count():
            merge(batch)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_prices(rows: DataFrame, window: str = "6 hours", late: str = "1 day", time: str = "captured_at_utc") -> DataFrame:
    """Lowest, highest and number of prices per station, label and window; captures later than ``late`` are dropped."""
    return rows.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), "station_key", "grade_raw").agg(F.min("price").alias("price_min"), F.max("price").alias("price_max"), F.count(F.lit(1)).alias("n_readings")).select(F.col("w.start").alias("from_utc"), "station_key", "grade_raw", "price_min", "price_max", "n_readings")
