"""Typed readers. Text files are read as text and cast under a declared schema; nothing is inferred."""

from __future__ import annotations

import io
import tarfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, StringType, StructField, StructType, TimestampType

from ..operators.validate import SchemaError
from ..schemas import FX, HELD, ROW, STATION, empty


def _as_text(spark: SparkSession, path, columns: list[str], mode: str = "FAILFAST") -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", mode).option("multiLine", True).option("escape", '"').csv(path)


def _typed(c: str, kind: DataType, strict: bool) -> Column:
    """Text to a type: ISO dates, ``Z`` or plain date-time instants, numbers. Strict text that doesn't fit raises."""
    text = F.nullif(F.col(f"`{c}`"), F.lit(""))
    if isinstance(kind, StringType):
        return text.alias(c)
    if isinstance(kind, DateType):
        value = F.try_to_date(text, "yyyy-MM-dd")
    elif isinstance(kind, TimestampType):
        value = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), F.try_to_timestamp(F.regexp_replace(text, r"(Z|\+0000)$", "")))
    elif isinstance(kind, BooleanType):
        value = text.try_cast("boolean")
    else:
        value = text.try_cast(kind)
    if strict:
        value = F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"{c}: "), text)).cast(kind)).otherwise(value)
    return value.alias(c)


def header(spark: SparkSession, path) -> list[str]:
    """Column names of a CSV file; none for a blank one."""
    first = spark.read.text(path).limit(1).collect()
    if not first or not first[0][0].strip():
        return []
    return next(__import__("csv").reader([first[0][0].lstrip("﻿")]))


def read_csv(spark: SparkSession, path, schema: StructType, strict: bool = True) -> DataFrame:
    """CSV (gzip by its suffix) under ``schema``: extra columns are ignored, missing ones raise."""
    names = header(spark, path)
    if missing := [c for c in schema.names if c not in names]:
        raise SchemaError(f"missing columns: {missing}")
    return _as_text(spark, path, names).select([_typed(f.name, f.dataType, strict) for f in schema])


def read_exact_csv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """CSV whose header must be the schema in order; a blank or header-only file is empty."""
    names = header(spark, path)
    if not names:
        return empty(spark, schema)
    if names != schema.names:
        raise SchemaError(f"header {names} instead of {schema.names}")
    return read_csv(spark, path, schema)


def read_loose_csv(spark: SparkSession, path, numeric: dict[str, str]) -> DataFrame:
    """CSV with any columns, as text; the ``numeric`` ones present are cast, bad values null."""
    names = header(spark, path)
    return _as_text(spark, path, names).select([F.col(f"`{c}`").try_cast(numeric[c]).alias(c) if c in numeric else F.col(f"`{c}`") for c in names])


def read_optional_csv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """A file that may be absent or malformed: then an empty table of the schema."""
    try:
        out = read_csv(spark, path, schema)
        out.limit(1).collect()
        return out
    except Exception:  # noqa: BLE001  absent, unreadable and malformed files all mean that there is no state
        return empty(spark, schema)


def read_rows(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, ROW)


def read_held(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, HELD)


def read_previous_state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, bool]:
    """Stations and rates of the last publication, and whether both could be read."""
    found, complete = [], True
    for name, schema in (("stations.csv", STATION), ("fx.csv", FX)):
        try:
            df = read_csv(spark, f"{folder}/{name}", schema)
            df.limit(1).collect()
        except Exception:  # noqa: BLE001
            df, complete = empty(spark, schema), False
        found.append(df)
    return found[0], found[1], complete


def read_parquet(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_daily(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of several daily files in one scan, each with its ``day`` from the file's name."""
    if not paths:
        return empty(spark, ROW).withColumn("day", F.lit(None).cast("date"))
    names = header(spark, paths[0])
    rows = _as_text(spark, paths, names).withColumn("_file", F.input_file_name())
    day = F.to_date(F.regexp_extract("_file", r"(\d{4}-\d{2}-\d{2})\.csv(?:\.gz)?$", 1))
    return rows.select(*[_typed(f.name, f.dataType, True) for f in ROW], day.alias("day"))


def read_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Stored raw responses: each ``*.body`` with the fields of its ``*.meta.json``, joined on the path stem."""
    stem = lambda c, suffix: F.regexp_replace(c, suffix, "")
    read = lambda glob: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    kind = "key string, url string, status int, headers map<string,string>, received_at_utc string, elapsed_ms bigint, error string"
    meta = read("*.meta.json").select(stem("path", r"\.meta\.json$").alias("stem"), F.from_json(F.decode("content", "utf-8"), kind).alias("m"))
    body = read("*.body").select(stem("path", r"\.body$").alias("stem"), F.col("content").alias("body"))
    out = meta.join(body, "stem", "left").select("m.*", "body").withColumn("received_at_utc", F.try_to_timestamp("received_at_utc"))
    return out.withColumn("feed", F.substring_index("key", "/", 1)).orderBy("key")


BUNDLE_MEMBERS = ("meta.json", "rows.csv", "stations.csv", "fx.json", "status.json")


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Members of tar.gz bundles: bundle, member, content, sha256 of the bundle, valid.

    A bundle that can't be opened or lacks a required member comes back as one row with ``valid`` false.
    """
    kind = "bundle string, member string, content binary, sha256 string, valid boolean"

    def run(batches):
        for batch in batches:
            for name, raw, digest in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), batch.column("sha256").to_pylist()):
                try:
                    with tarfile.open(fileobj=io.BytesIO(raw), mode="r:gz") as tar:
                        found = [(m.name.removeprefix("./"), tar.extractfile(m).read()) for m in tar if m.isfile()]
                    good = {*BUNDLE_MEMBERS} <= {m for m, _ in found}
                except (tarfile.TarError, OSError, EOFError):
                    found, good = [], False
                rows = found if good else [(None, None)]
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([m for m, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary()), pa.array([digest] * n, pa.string()), pa.array([good] * n)], names=["bundle", "member", "content", "sha256", "valid"])

    files = spark.read.format("binaryFile").load(path).select("path", "content", F.sha2("content", 256).alias("sha256"))
    return files.mapInArrow(run, kind)
