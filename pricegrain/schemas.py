"""Schemas, keys, orders and required columns of every stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_KINDS: dict[str, DataType] = {"string": StringType(), "date": DateType(), "timestamp": TimestampType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType(), "boolean": BooleanType()}


def table_of(columns: str) -> StructType:
    """Schema of ``name type`` pairs; unlike DDL parsing it needs no session."""
    return StructType([StructField(name, _KINDS[kind]) for name, kind in (c.split() for c in columns.split(","))])


ROW = table_of(
    "capture_id string, capture_date date, captured_at_utc timestamp, local_date date, country string, brand string,"
    " station_key string, source_station_id string, source string, name string, name_local string, address string,"
    " city string, region string, postcode string, lat double, lon double, timezone string, grade_raw string,"
    " grade string, price_raw string, price double, price_unit string, currency string, price_local_per_litre double,"
    " fx_usd_per_unit double, fx_rate_date date, fx_source string, fx_fetched_at_utc timestamp,"
    " price_usd_per_litre double, price_usd_per_gallon double"
)
HELD = StructType([*ROW.fields, *table_of("hold_reason string").fields])
DAILY = StructType([*ROW.fields, *table_of("n_captures bigint, price_min double, price_max double").fields])
STATION = table_of(
    "station_key string, country string, brand string, source_station_id string, alt_id string, name string,"
    " name_local string, address string, city string, region string, postcode string, lat double, lon double,"
    " timezone string, grades_seen string, first_seen_utc timestamp, last_seen_utc timestamp, status string,"
    " superseded_by string"
)
FX = table_of(
    "capture_id string, currency string, units_per_usd double, fx_usd_per_unit double, fx_rate_date date,"
    " fx_source string, fx_fetched_at_utc timestamp"
)
SUMMARY = table_of(
    "capture_date date, country string, brand string, level string, region string, grade string, n_stations int,"
    " n_stations_usd int, median_local_per_litre double, p25_local_per_litre double, p75_local_per_litre double,"
    " median_usd_per_litre double, p25_usd_per_litre double, p75_usd_per_litre double"
)
HISTORY = table_of(
    "capture_date date, station_key string, brand string, grade string, price_local_per_litre double,"
    " price_usd_per_litre double, currency string, n_captures bigint, changed boolean, moved_intraday boolean"
)
DROPS = table_of("source_station_id string, reason string, detail string")
POLLED = table_of("source_station_id string, id_origin string, ecom_state string")
GRADES = table_of("brand string, country string, grade_raw string, grade string, priority bigint, label string, spec string, spec_source string, spec_source_url string")
WATCH = table_of("feed string, source_station_id string, detected string, status string, publish_from string, note string")
EXTRA_IDS = table_of("brand string, source_station_id string, name string, city string, region string, postcode string, lat double, lon double, timezone string, note string")
LINKS = table_of("old_station_key string, new_station_key string, effective_date string, note string")


@dataclass(frozen=True)
class Table:
    schema: StructType
    key: tuple[str, ...]
    order: tuple[str, ...]
    required: tuple[str, ...]
    rounded: tuple[str, ...] = ()
    significant: tuple[str, ...] = ()


_PRICES = ("price_local_per_litre", "price_usd_per_litre", "price_usd_per_gallon")
_NULLABLE = {"name_local", "address", "city", "region", "postcode", "lat", "lon", "fx_usd_per_unit", "fx_rate_date", "fx_source", "fx_fetched_at_utc", "price_usd_per_litre", "price_usd_per_gallon"}
_NEEDED = tuple(c for c in ROW.names if c not in _NULLABLE)

ROWS = Table(ROW, ("capture_id", "station_key", "grade_raw"), ("capture_id", "station_key", "grade_raw"), _NEEDED, _PRICES, ("fx_usd_per_unit",))
HELD_ROWS = Table(HELD, ROWS.key, ROWS.order, (*_NEEDED, "hold_reason"), _PRICES, ("fx_usd_per_unit",))
DAILY_ROWS = Table(DAILY, ("capture_date", "station_key", "grade_raw"), ("capture_date", "station_key", "grade_raw"), ("capture_date", "station_key", "grade_raw"), _PRICES, ("fx_usd_per_unit",))
STATIONS = Table(STATION, ("station_key",), ("station_key",), ("station_key", "country", "brand", "status"))
RATES = Table(FX, ("capture_id", "currency"), ("capture_id", "currency"), tuple(FX.names), (), ("units_per_usd", "fx_usd_per_unit"))
SUMMARIES = Table(SUMMARY, ("capture_date", "country", "brand", "level", "region", "grade"), ("country", "brand", "level", "region", "grade", "capture_date"), ())
HISTORIES = Table(HISTORY, ("capture_date", "station_key", "grade"), ("station_key", "grade", "capture_date"), ())
CAPTURE_ORDER = ("captured_at_utc", "capture_id")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
