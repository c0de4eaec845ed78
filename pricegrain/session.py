"""Session settings that the engine's semantics and plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC everywhere; adaptive plans coalesce small partitions and split skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(master: str | None = None, app: str = "pricegrain", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()
