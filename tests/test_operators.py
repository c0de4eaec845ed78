"""Relational operators on small literal tables."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricegrain.operators import fx, grain, normalize, sets, stations, status, summary, validate
from pricegrain.schemas import DAILY, FX, LINKS, ROW, ROWS, STATION, STATIONS, empty

D, T = date(2026, 9, 15), datetime(2026, 9, 15, 12)


def rows_of(spark, records, schema=ROW):
    base = {"capture_id": "2026-09-15T1200Z", "capture_date": D, "captured_at_utc": T, "local_date": D, "country": "US", "brand": "COSTCO", "station_key": "US-COSTCO-1", "source_station_id": "1", "source": "s", "name": "n", "timezone": "UTC", "grade_raw": "regular", "grade": "regular", "price_raw": "3.0", "price": 3.0, "price_unit": "USD/gal", "currency": "USD", "price_local_per_litre": 0.8}
    return spark.createDataFrame([tuple((base | r).get(f.name) for f in schema) for r in records], schema)


def stations_of(spark, records):
    base = {"country": "US", "brand": "COSTCO", "status": "active"}
    return spark.createDataFrame([tuple((base | r).get(f.name) for f in STATION) for r in records], STATION)


def test_daily_grain_takes_the_newest_row_and_the_day_range(spark):
    rows = rows_of(spark, [{"price": 3.0}, {"price": 2.5, "capture_id": "b", "captured_at_utc": datetime(2026, 9, 15, 18)}, {"price": 4.0, "capture_id": "c", "captured_at_utc": datetime(2026, 9, 15, 18)}])
    out = grain.daily_grain(rows)
    assert out.schema.names == DAILY.names
    r = out.first()
    assert (r["price"], r["capture_id"], r["n_captures"], r["price_min"], r["price_max"]) == (4.0, "c", 3, 2.5, 4.0)
    assert grain.daily_grain(empty(spark, ROW)).count() == 0


def test_daily_grain_shuffles_once(spark):
    plan = grain.daily_grain(rows_of(spark, [{}]).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 0


def test_dedupe_prefers_later_then_priority(spark):
    rows = grain.daily_grain(rows_of(spark, [{"grade_raw": "E10"}, {"grade_raw": "U91"}, {"grade_raw": "x", "grade": "other"}, {"grade_raw": "D", "grade": "diesel"}, {"grade_raw": "D2", "grade": "diesel", "captured_at_utc": datetime(2026, 9, 15, 18)}]))
    priorities = spark.createDataFrame([("US", "COSTCO", "U91", 2), ("US", "COSTCO", "E10", 1), ("US", "COSTCO", "D", 9)], "country string, brand string, grade_raw string, priority bigint")
    assert sorted(r["grade_raw"] for r in grain.dedupe_daily(rows, priorities).collect()) == ["D2", "U91"]


def test_latest_full_and_incremental_agree(spark):
    rows = rows_of(spark, [{"station_key": f"US-COSTCO-{s}", "grade_raw": g, "capture_id": f"2026-09-{d:02d}T1200Z", "captured_at_utc": datetime(2026, 9, d, 12), "price": d + s / 10.0} for s in range(4) for d in (1, 2, 3) for g in "ab" if (s + d) % 3])
    full = grain.latest_rows(rows)
    step = empty(spark, ROW)
    for d in (2, 1, 3):
        step = grain.update_latest(step, rows.where(F.dayofmonth("captured_at_utc") == d))
    key = ["station_key", "grade_raw", "capture_id", "price"]
    assert sorted(map(tuple, full.select(key).collect())) == sorted(map(tuple, step.select(key).collect()))


def test_latest_tie_keeps_the_old(spark):
    old, new = rows_of(spark, [{"price": 1.0}]), rows_of(spark, [{"price": 2.0}])
    assert [r["price"] for r in grain.update_latest(old, new).collect()] == [1.0]


def test_replace_partition_is_idempotent(spark):
    a, b = rows_of(spark, [{"capture_id": "a"}, {"capture_id": "b"}]), rows_of(spark, [{"capture_id": "b", "price": 9.0}])
    once = grain.replace_partition(a, b, "capture_id")
    twice = grain.replace_partition(once, b, "capture_id")
    assert sorted(r["price"] for r in twice.collect()) == [3.0, 9.0]
    assert grain.lost_values(a, b, "capture_id").collect()[0][0] == "a"


def test_coverage_counts_distinct_captures(spark):
    rows = rows_of(spark, [{}, {"grade_raw": "x"}, {"capture_id": "b"}, {"brand": "SAMS", "capture_date": date(2026, 9, 16)}])
    out = {r["capture_date"]: r.asDict() for r in grain.coverage(rows).collect()}
    assert out[D]["US-COSTCO"] == 2 and out[D]["US-SAMS"] == 0 and out[date(2026, 9, 16)]["US-SAMS"] == 1


def test_summary_levels_and_missing_rates(spark):
    rows = rows_of(spark, [{"station_key": f"s{i}", "region": "R" if i < 2 else None, "price_local_per_litre": float(i), "price_usd_per_litre": float(i) if i != 3 else None} for i in range(4)])
    out = {(r["level"], r["region"]): r for r in summary.summary_daily(rows, check=True).collect()}
    country, region = out["country", None], out["region", "R"]
    assert (country["n_stations"], country["n_stations_usd"], country["median_local_per_litre"], country["p25_local_per_litre"], country["median_usd_per_litre"]) == (4, 3, 1.5, 0.75, 1.0)
    assert (region["n_stations"], region["median_local_per_litre"]) == (2, 0.5)


def test_change_flags(spark):
    days = [(15, 1.0, 1.0, 1.0), (16, 1.00004, 1.0, 1.2), (19, 1.5, 1.5, 1.5), (20, None, None, None)]
    rows = rows_of(spark, [{"capture_date": date(2026, 9, d), "price_local_per_litre": p, "price_min": a, "price_max": b, "n_captures": 1} for d, p, a, b in days], DAILY)
    out = summary.history(rows).collect()
    assert [r["changed"] for r in out] == [None, False, True, None]
    assert [r["moved_intraday"] for r in out] == [False, True, False, None]


def test_latest_nested(spark):
    rows = rows_of(spark, [{"lat": 1.0, "lon": 2.0}, {"lat": 1.0, "lon": 2.0, "grade_raw": "Mid", "grade": "other"}, {"station_key": "nowhere"}])
    r = summary.latest_nested(rows, stations_of(spark, [{"station_key": "US-COSTCO-1"}])).collect()
    assert len(r) == 1 and set(r[0]["grades"]) == {"regular"} and set(r[0]["other"]) == {"Mid"} and r[0]["status"] == "active"
    twice = rows_of(spark, [{"lat": 1.0, "lon": 2.0}, {"lat": 1.0, "lon": 2.0, "grade_raw": "again"}])
    with pytest.raises(Exception, match="more than one row"):
        summary.latest_nested(twice, stations_of(spark, [])).collect()


def feeds_of(spark, *rows):
    return spark.createDataFrame(rows, "feed string, newest string, status string, disabled boolean")


def test_upsert_overwrites_relabels_and_keeps(spark):
    old = stations_of(spark, [{"station_key": k, "source_station_id": k[-1], "name": "old", "grades_seen": "a", "first_seen_utc": datetime(2026, 6, 1), "last_seen_utc": datetime(2026, 7, 1)} for k in ("US-COSTCO-1", "US-COSTCO-2", "US-COSTCO-3")] + [{"station_key": "US-SAMS-4", "brand": "SAMS", "source_station_id": "4", "last_seen_utc": T}])
    new = stations_of(spark, [{"station_key": "US-COSTCO-1", "source_station_id": "1", "grades_seen": "b|a", "first_seen_utc": T, "last_seen_utc": T}, {"station_key": "US-COSTCO-9", "source_station_id": "9"}])
    links = spark.createDataFrame([("US-COSTCO-2", "US-COSTCO-9", None, None)], LINKS)
    feeds = feeds_of(spark, ("US-COSTCO", "2026-09-01T0000Z", "ok", False), ("US-SAMS", None, None, False))
    missed = spark.createDataFrame([("US-COSTCO", "3")], "feed string, source_station_id string")
    out = {r["station_key"]: r for r in stations.upsert(old, new, feeds, links, "2026-09-15T1200Z", missed, {"US": 45}).collect()}
    assert len(out) == 5
    assert out["US-COSTCO-1"]["name"] is None and out["US-COSTCO-1"]["grades_seen"] == "a|b" and out["US-COSTCO-1"]["first_seen_utc"] == datetime(2026, 6, 1)
    assert (out["US-COSTCO-2"]["status"], out["US-COSTCO-2"]["superseded_by"]) == ("closed", "US-COSTCO-9")
    assert out["US-COSTCO-3"]["status"] == "active" and out["US-SAMS-4"]["status"] == "active"
    late = {r["station_key"]: r for r in stations.upsert(old, new, feeds, links, "2026-08-01T0000Z", missed, {"US": 45}).collect()}
    assert late["US-COSTCO-1"]["name"] == "old" and late["US-COSTCO-2"]["status"] == "active"


def test_upsert_relabels_disabled_feeds(spark):
    old = stations_of(spark, [{"station_key": "US-SAMS-4", "brand": "SAMS", "source_station_id": "4", "last_seen_utc": T}])
    out = stations.upsert(old, empty(spark, STATION), feeds_of(spark, ("US-SAMS", None, None, True)), empty(spark, LINKS), "2026-09-16T0000Z", None, {"US": 45})
    assert out.first()["status"] == "missing"


def test_rebuild_adds_and_relabels(spark):
    rows = rows_of(spark, [{"station_key": "US-COSTCO-1"}, {"station_key": "US-COSTCO-2", "source_station_id": "2", "capture_id": "2026-07-01T0000Z", "captured_at_utc": datetime(2026, 7, 1)}])
    existing = stations_of(spark, [{"station_key": "US-COSTCO-3", "status": "missing", "last_seen_utc": datetime(2026, 1, 1)}])
    out = {r["station_key"]: r for r in stations.rebuild(rows, existing, empty(spark, LINKS), thresholds={"US": 45}).collect()}
    assert {k: r["status"] for k, r in out.items()} == {"US-COSTCO-1": "active", "US-COSTCO-2": "closed", "US-COSTCO-3": "closed"}
    assert out["US-COSTCO-1"]["grades_seen"] == "regular"


def test_merge_metadata_takes_the_first_value_of_each_field(spark):
    ids = spark.createDataFrame([("1",), ("2",)], "source_station_id string")
    a = spark.createDataFrame([("1", None, "A"), ("2", "x", "y")], "source_station_id string, name string, city string")
    b = spark.createDataFrame([("1", "B", "b")], "source_station_id string, name string, city string")
    out = {r[0]: tuple(r)[1:] for r in stations.merge_metadata(ids, [(a, F.col("source_station_id") == "1"), (b, None)], ["name", "city"]).collect()}
    assert out == {"1": ("B", "A"), "2": (None, None)}


def rate(currency, units, day, source="x", capture="c1"):
    return (capture, currency, units, 1 / units, day, source, T)


def test_carry_forward_judges_only_the_newest(spark):
    rates = spark.createDataFrame([rate("CAD", 1.3, date(2026, 9, 14), capture="c1"), rate("CAD", 1.4, date(2026, 9, 1), capture="c2"), rate("MXN", 18.0, date(2026, 9, 10)), rate("MXN", 1.0, D, "carried:x", "c9")], FX)
    out = {r["currency"]: r for r in fx.carry_forward(rates, D).collect()}
    assert set(out) == {"MXN"} and out["MXN"]["fx_source"] == "carried:x" and out["MXN"]["units_per_usd"] == 18.0


def test_fx_priority_upsert_and_status(spark):
    a = spark.createDataFrame([rate("CAD", 1.3, D, "frankfurter")], FX)
    b = spark.createDataFrame([rate("CAD", 1.4, D, "fawaz"), rate("AUD", 1.5, D, "fawaz")], FX)
    best = fx.by_priority([a, b])
    assert {r["currency"]: r["units_per_usd"] for r in best.collect()} == {"CAD": 1.3, "AUD": 1.5}
    assert fx.status(best).first()[0] == "fallback" and fx.status(best.limit(0)).first()[0] == "none"
    again = fx.upsert(fx.upsert(empty(spark, FX), a), a)
    assert [tuple(r)[:4] for r in again.collect()] == [("c1", "CAD", 1.3, 0.7692307692)]


def test_missing_rate_keeps_local_price(spark):
    rows = spark.createDataFrame([(150.0, "GBp/L", D, T), (3.0, "USD/gal", D, T)], "price double, price_unit string, capture_date date, captured_at_utc timestamp")
    out = {r["currency"]: r for r in fx.apply(rows, empty(spark, FX)).collect()}
    assert out["GBP"]["price_local_per_litre"] == 1.5 and out["GBP"]["price_usd_per_gallon"] is None
    assert out["USD"]["price_usd_per_gallon"] == 3.0 and out["USD"]["fx_source"] == "identity"


def raw(spark, records):
    kinds = StructType.fromDDL(normalize.RAW_STATION)
    base = {"country": "US", "brand": "COSTCO", "id_origin": "seen", "ecom_state": "gas", "name": "n", "timezone": "America/Denver", "prices": [("regular", "3.10"), ("premium", "3.90")]}
    return spark.createDataFrame([tuple((base | r).get(f.name) for f in kinds) for r in records], kinds)


@pytest.fixture(scope="module")
def dims(spark):
    return normalize.Dimensions(
        spark.createDataFrame([("US", "COSTCO", g, m, p) for g, m, p in (("regular", "regular", 2), ("unleaded", "regular", 1), ("premium", "premium", 1))], "country string, brand string, grade_raw string, grade string, priority bigint"),
        spark.createDataFrame([("US", None, "USD/gal"), ("US", "PR", "USD/L")], "country string, region string, unit string"),
        spark.createDataFrame([("USD/gal", None, 2.0, 11.0), ("USD/L", None, 0.5, 2.5)], "unit string, grade_raw string, low double, high double"),
        spark.createDataFrame([("US-COSTCO", "on", None, "on", "2026-09-01", None), ("US-COSTCO", "soon", None, "on", "2026-10-01", None)], "feed string, source_station_id string, detected string, status string, publish_from string, note string"),
    )


def run(spark, dims, records):
    return normalize.normalize(raw(spark, records), empty(spark, FX), dims, "2026-09-15T1200Z", "2026-09-15", "2026-09-15 12:00:00", "src")


def test_normalize_publishes_holds_and_drops(spark, dims):
    out = run(spark, dims, [
        {"source_station_id": "1"}, {"source_station_id": "2", "ecom_state": "no_gas"}, {"source_station_id": "3", "opening_date": date(2026, 10, 1)}, {"source_station_id": "4", "prices": []},
        {"source_station_id": "5", "timezone": "Nowhere/Land"}, {"source_station_id": "6", "id_origin": "watch"}, {"source_station_id": "on", "id_origin": "watch", "has_hours": False},
        {"source_station_id": "7", "id_origin": "extra", "has_hours": False}, {"source_station_id": "8", "ecom_state": "absent", "prices": [("premium", "4.0")]}, {"source_station_id": "9", "prices": [("premium", "4.0")]},
        {"source_station_id": "10", "region": "PR", "prices": [("regular", "1.097")]}, {"source_station_id": "11", "has_hours": False, "name": None},
    ])
    assert sorted({r["source_station_id"] for r in out.rows.collect()}) == ["1", "10", "7", "9", "on"]
    assert {(r["source_station_id"], r["reason"]) for r in out.drops.collect()} == {("2", "no_gas_service"), ("3", "not_open"), ("4", "no_price"), ("5", "no_timezone"), ("6", "watch"), ("8", "no_regular"), ("11", "no_hours")}
    assert {(r["source_station_id"], r["hold_reason"]) for r in out.held.collect()} == {("2", "no_gas_service"), ("3", "not_open"), ("6", "watch")}
    assert {(r["code"], r["detail"]) for r in out.warnings.collect()} == {("priced_before_open", "3"), ("priced_before_open", "11"), ("no_regular", "9"), ("held_rows_invalid", "11")}
    assert {r["station_key"] for r in out.stations.collect()} == {f"US-COSTCO-{s}" for s in ("1", "10", "7", "9", "on")}
    one = out.rows.where("source_station_id = '1' AND grade = 'regular'").first()
    assert (one["price"], one["price_usd_per_gallon"], one["local_date"], one["currency"]) == (3.1, 3.1, D, "USD")
    validate.validate(out.rows, ROWS)
    validate.validate(out.stations, STATIONS)


def test_normalize_conflict_comes_before_bounds(spark, dims):
    out = run(spark, dims, [{"source_station_id": "1", "prices": [("unleaded", "3.2"), ("regular", "99"), ("Mystery", "3.3"), ("premium", "n/a")]}])
    assert {(r["grade_raw"], r["grade"]) for r in out.rows.collect()} == {("unleaded", "other"), ("Mystery", "other")}
    assert {(r["reason"], r["detail"]) for r in out.drops.collect()} == {("out_of_bounds", "regular=99 USD/gal"), ("unparseable_price", "premium=n/a")}
    assert {(r["code"], r["detail"]) for r in out.warnings.collect()} == {("unknown_grade", "Mystery"), ("grade_conflict", "US-COSTCO-1:regular:unleaded"), ("no_regular", "1")}


def test_conflict_tie_goes_to_the_earliest(spark):
    rows = spark.createDataFrame([("s", "regular", 1, 0, "a"), ("s", "regular", 1, 1, "b")], "s string, grade string, priority int, pos int, grade_raw string")
    assert {r["grade_raw"]: r["grade"] for r in normalize.resolve_conflicts(rows, ["s"]).collect()} == {"a": "regular", "b": "other"}


def test_validation_messages(spark):
    good = rows_of(spark, [{}])
    assert validate.validate(good, ROWS) is good
    with pytest.raises(validate.SchemaError, match="missing"):
        validate.validate(good.drop("price"), ROWS)
    with pytest.raises(validate.SchemaError, match="unexpected"):
        validate.validate(good.withColumn("x", F.lit(1)), ROWS)
    with pytest.raises(validate.SchemaError, match="wrong types"):
        validate.validate(good.withColumn("price", F.lit("x")), ROWS)
    with pytest.raises(validate.SchemaError, match="nulls"):
        validate.validate(rows_of(spark, [{"name": None}]), ROWS)
    with pytest.raises(validate.SchemaError, match="duplicate"):
        validate.validate(good.union(good), ROWS)
    assert validate.cast_to(good.withColumn("price", F.lit("x")), ROW).first()["price"] is None


def test_fingerprint_sorts_tuples_not_lines(spark):
    import hashlib

    rows = spark.createDataFrame([("k", "ab", "x", "1"), ("k", "a", "y", "2"), ("k", "a!", "z", "3")], "g string, station_key string, grade_raw string, price_raw string")
    want = "".join(f"{a}\t{b}\t{c}\n" for a, b, c in sorted([("ab", "x", "1"), ("a", "y", "2"), ("a!", "z", "3")]))
    assert status.fingerprint(rows, ["g"]).first()["price_fingerprint"] == "sha256:" + hashlib.sha256(want.encode()).hexdigest()


def test_evaluate_feed_states(spark):
    rows = rows_of(spark, [{"country": "TW", "station_key": f"TW-COSTCO-{i}", "source_station_id": str(i)} for i in range(3)])
    feeds = spark.createDataFrame([("TW-COSTCO", True), ("MX-COSTCO", True), ("GB-COSTCO", False)], "feed string, ran boolean")
    none = lambda ddl: spark.createDataFrame([], ddl)
    previous = spark.createDataFrame([("MX-COSTCO", "p", "2026-09-01T0000Z", 2, "2026-09-01T0000Z", ["a", "b", "c"]), ("GB-COSTCO", "q", "u", 1, "l", None)], "feed string, price_fingerprint string, unchanged_since_capture_id string, consecutive_failures int, last_success_capture_id string, recent_errors array<string>")
    args = (feeds, rows, none("feed string, reason string"), none("feed string, code string"), previous, "2026-09-15T1200Z", "2026-09-15 12:05:00")
    out = {r["feed"]: r for r in status.evaluate(*args).collect()}
    assert (out["TW-COSTCO"]["status"], out["TW-COSTCO"]["consecutive_failures"], out["TW-COSTCO"]["unchanged_since_capture_id"]) == ("ok", 0, "2026-09-15T1200Z")
    assert (out["MX-COSTCO"]["status"], out["MX-COSTCO"]["consecutive_failures"], out["MX-COSTCO"]["recent_errors"]) == ("failed", 3, ["2026-09-15T1200Z", "a", "b"])
    assert (out["GB-COSTCO"]["status"], out["GB-COSTCO"]["consecutive_failures"], out["GB-COSTCO"]["price_fingerprint"]) == ("skipped", 1, "q")
    warned = status.evaluate(*args[:3], spark.createDataFrame([("TW-COSTCO", "unknown_grade")], "feed string, code string"), *args[4:])
    assert {r["feed"]: r["status"] for r in warned.collect()}["TW-COSTCO"] == "degraded"
    roll = {r["country"]: r for r in status.rollup(status.evaluate(*args)).collect()}
    assert roll["TW"]["rows"] == 3 and roll["GB"]["status"] == "skipped" and not status.all_failed(status.evaluate(*args))


def test_sets(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id long")
    assert [r["id"] for r in sets.candidate_ids(ids(3), ids(2, 4), 2).orderBy("id").collect()] == [1, 3, 5]
    prices = spark.createDataFrame([(1, 3.5, 4.0), (2, 3.999, 5.999), (3, None, 4.0), (4, 1.097, None), (5, 3.999, None)], "id int, regular double, premium double")
    assert [r["id"] for r in sets.reportable(prices, 2.0, 11.0).collect()] == [1, 5]
    b = sets.batches(ids(*range(25)), "id").orderBy("batch").collect()
    assert [r["n_ids"] for r in b] == [10, 10, 5] and b[0]["ids"] == "0,1,2,3,4,5,6,7,8,9"


def test_below_regular(spark):
    rows = spark.createDataFrame([("a", "UNLEAD", 3.0), ("a", "PREMIUM", 2.9), ("a", "DIESEL", 3.0), ("b", "PREMIUM", 1.0)], "s string, grade_raw string, price double")
    assert {(r["s"], r["grade_raw"]) for r in normalize.below_regular(rows, ["s"]).where("below").collect()} == {("a", "PREMIUM")}


def test_runs_and_streaks(spark):
    rows = spark.createDataFrame([("f", "c1", "x"), ("f", "c2", "x"), ("f", "c3", "y"), ("f", "c4", "x")], "feed string, capture_id string, fp string")
    assert [r["unchanged_since"] for r in status.unchanged_runs(rows, ["feed"], ["capture_id"], "fp").orderBy("capture_id").collect()] == ["c1", "c1", "c3", "c4"]
    st = spark.createDataFrame([("f", "1", "failed"), ("f", "2", "skipped"), ("f", "3", "failed"), ("f", "4", "ok"), ("f", "5", "failed")], "feed string, capture_id string, status string")
    assert [r["consecutive_failures"] for r in status.failure_streaks(st).orderBy("capture_id").collect()] == [1, 1, 2, 0, 1]


def test_json_roundtrip_of_statuses(spark):
    from pricegrain.plans.history import status_json

    df = spark.createDataFrame([("US-COSTCO", "ok", ["a"])], "feed string, status string, recent array<string>")
    assert json.loads(status_json(df)) == {"US-COSTCO": {"status": "ok", "recent": ["a"]}}
