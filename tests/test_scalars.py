"""Scalar functions on literal values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pricegrain.functions import scalars as S
from pricegrain.operators.stations import absent_status


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f("x")).first()[0]


def many(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(f("x")).collect()]


def test_parse_price(spark):
    good = {"4.299": 4.299, "$4.299": 4.299, " 28.9 ": 28.9, "NT$ 28.9": 28.9, ".959": 0.959, "1,234.5": 1234.5, "¥165": 165.0, "£1.2": 1.2, "€2": 2.0, "1\u00a0234": 1234.0, "\u3000159.9\u3000": 159.9, "-1": -1.0, "1e2": 100.0}
    assert many(spark, list(good), S.parse_price) == list(good.values())
    assert many(spark, ["", " ", "abc", "1 234", "1.5d", "inf", "NaN", "--1", "1.2.3", "$", None, "1e999"], S.parse_price) == [None] * 12


def test_clean_and_labels(spark):
    assert many(spark, [" a ", "\u3000埼玉県\u3000", " ", "", None], S.clean) == ["a", "埼玉県", None, None, None]
    assert one(spark, "b||a|b", lambda x: S.join_labels(S.split_labels(x))) == "a|b"
    assert one(spark, "b|a", lambda x: S.union_labels(x, F.lit("c|a"))) == "a|b|c"
    assert one(spark, None, lambda x: S.union_labels(x, F.lit("z"))) == "z"


def test_feed_parts(spark):
    assert one(spark, "US-SAMS", S.feed_country) == "US"
    assert one(spark, "US-SAMS-X", S.feed_brand) == "SAMS-X"
    assert many(spark, ["MX-JAL", "JAL", None], lambda x: S.strip_prefix(x, "MX-")) == ["JAL", "JAL", None]
    assert many(spark, ["AU_0123", "x", None], S.trailing_number) == ["0123", None, None]


def test_numeric_first(spark):
    ids = spark.createDataFrame([(x,) for x in ("b", "10", "9", "a", "007")], "x string")
    assert [r[0] for r in ids.orderBy(*S.numeric_first("x")).collect()] == ["007", "9", "10", "a", "b"]


def test_regions(spark):
    au = spark.createDataFrame([("Lake Haven NSW", None, None), ("Perth", "1 Rd, Perth WA 6000", None), ("Town", "x", "2605"), ("Town", "x", "0810"), ("Town", "x", "3000"), ("Town", "x", "12")], "t string, f string, p string")
    assert [r[0] for r in au.select(S.au_region("t", "f", "p")).collect()] == ["NSW", "WA", "ACT", "NT", "VIC", None]
    assert many(spark, ["Lake Haven NSW", "NSW", "Perth", None], S.au_city) == ["Lake Haven", None, "Perth", None]
    jp = ["福岡県糟屋郡久山町大字", "福岡県小郡市上岩田", "石川県野々市市柳町", "東京都千代田区", "x"]
    assert many(spark, jp, S.jp_region) == ["福岡県", "福岡県", "石川県", "東京都", None]
    assert many(spark, jp, S.jp_city) == ["久山町", "小郡市", "野々市市", "千代田区", None]
    assert many(spark, ["114 臺北市內湖區", "24891新北市", "臺北市"], S.tw_region) == ["臺北市", "新北市", None]


def test_dates(spark):
    assert many(spark, ["Aug 23, 1995", "SEP 1 2020", "september 12, 1995", "Feb. 30, 2001", "23 Aug 1995", None], S.open_date) == [date(1995, 8, 23), date(2020, 9, 1), date(1995, 9, 12), None, None, None]
    assert many(spark, ["2026-11-21T1913Z", "2026-11-21", "2026-13-01T0000Z", None], S.capture_time) == [datetime(2026, 11, 21, 19, 13), None, None, None]
    assert one(spark, datetime(2026, 11, 21, 19, 13, 59), S.capture_id, "timestamp") == "2026-11-21T1913Z"
    assert many(spark, ["2026-01-02T03:04:05Z", "2026-01-02", "x"], S.iso_date) == [date(2026, 1, 2), date(2026, 1, 2), None]
    late = spark.createDataFrame([(datetime(2024, 1, 1, 3), "Asia/Tokyo"), (datetime(2024, 1, 1, 3), "America/Denver")], "t timestamp, z string")
    assert [r[0] for r in late.select(S.local_date("t", "z")).collect()] == [date(2024, 1, 1), date(2023, 12, 31)]


def test_numbers(spark):
    assert one(spark, 1 / 154.24, S.significant, "double") == 0.00648340249
    assert many(spark, [2.0, 0.0, -1.0, float("inf"), float("nan"), None], S.reciprocal, "double") == [0.5, None, None, None, None, None]
    assert one(spark, 4.3, S.fixed3, "double") == "4.300"


def test_units(spark):
    rows = spark.createDataFrame([(3.785411784, "USD/gal"), (150.0, "GBp/L"), (1.5, "CAD/L")], "p double, u string")
    assert [tuple(r) for r in rows.select(S.local_per_litre("p", "u"), S.currency_of("u")).collect()] == [(1.0, "USD"), (1.5, "GBP"), (1.5, "CAD")]
    gallon = rows.withColumn("l", S.local_per_litre("p", "u"))
    assert [r[0] for r in gallon.select(S.usd_per_gallon("p", "u", "l")).collect()] == [3.785411784, pytest.approx(1.5 * 3.785411784), pytest.approx(1.5 * 3.785411784)]


def test_absent_status_is_strict(spark):
    rows = spark.createDataFrame([(datetime(2026, 1, 1),), (datetime(2025, 12, 31, 23, 59, 59),), (None,)], "t timestamp")
    at = F.lit(datetime(2026, 2, 15))
    assert [r[0] for r in rows.select(absent_status("t", at, 45)).collect()] == ["missing", "closed", "missing"]
    assert rows.select(absent_status("t", at, None)).first()[0] == "missing"
