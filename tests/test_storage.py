"""Readers, writers, the asset store, the history, site data, alerts, discovery and streams."""

import gzip
import json
import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_operators import rows_of, stations_of

from pricegrain.operators import grain
from pricegrain.operators.validate import SchemaError
from pricegrain.plans import alerts, discover, site
from pricegrain.plans.history import Capture, History, StorageError
from pricegrain.schemas import GRADES, ROW, ROWS, STATION, STATIONS
from pricegrain.sources import readers, writers
from pricegrain.streaming import merge as streams


def sample(spark):
    return rows_of(spark, [{"lat": 1.5, "price_local_per_litre": 0.123456, "fx_usd_per_unit": 1 / 154.24, "fx_fetched_at_utc": datetime(2026, 9, 15, 1)}, {"grade_raw": 'a "b", c', "name": "é　x", "station_key": "US-COSTCO-0"}])


def test_rows_round_trip_and_bytes_repeat(spark, tmp_path):
    path = tmp_path / "rows.csv.gz"
    assert writers.write_rows(sample(spark), path) == 2
    first = path.read_bytes()
    writers.write_rows(sample(spark).orderBy(F.desc("station_key")), path)
    assert path.read_bytes() == first and first[4:8] == b"\0\0\0\0"
    back = readers.read_rows(spark, str(path)).collect()
    assert [r["station_key"] for r in back] == ["US-COSTCO-0", "US-COSTCO-1"]
    assert back[0]["grade_raw"] == 'a "b", c' and back[0]["name"] == "é　x" and back[0]["city"] is None
    assert back[1]["price_local_per_litre"] == 0.1235 and back[1]["fx_usd_per_unit"] == 0.00648340249 and back[1]["captured_at_utc"] == datetime(2026, 9, 15, 12)


def test_reader_strictness(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("station_key,extra,lat\nA,1,2.5\nB,,x\n")
    kinds = type(STATION)([STATION["station_key"], STATION["lat"]])
    with pytest.raises(Exception, match="lat"):
        readers.read_csv(spark, str(path), kinds).collect()
    assert [tuple(r) for r in readers.read_csv(spark, str(path), kinds, strict=False).collect()] == [("A", 2.5), ("B", None)]
    with pytest.raises(SchemaError, match="missing"):
        readers.read_csv(spark, str(path), STATION)
    with pytest.raises(SchemaError, match="header"):
        readers.read_exact_csv(spark, str(path), kinds)
    blank = tmp_path / "blank.csv"
    blank.write_text("")
    assert readers.read_exact_csv(spark, str(blank), kinds).count() == 0
    assert readers.read_optional_csv(spark, str(tmp_path / "none.csv"), kinds).schema == kinds
    assert readers.read_loose_csv(spark, str(path), {"lat": "double"}).dtypes == [("station_key", "string"), ("extra", "string"), ("lat", "double")]
    s, f, complete = readers.read_previous_state(spark, str(tmp_path))
    assert s.count() == f.count() == 0 and not complete


def test_both_instant_texts_are_read(spark, tmp_path):
    kinds = type(STATION)([STATION["station_key"], STATION["first_seen_utc"]])
    path = tmp_path / "t.csv"
    path.write_text("station_key,first_seen_utc\nA,2026-09-15T12:00:00Z\nB,2026-09-15T12:00:00.000000+0000\n")
    assert [r[1] for r in readers.read_csv(spark, str(path), kinds).collect()] == [datetime(2026, 9, 15, 12)] * 2


def test_daily_files_in_one_scan(spark, tmp_path):
    for day in ("2026-09-15", "2026-09-16"):
        writers.write_rows(sample(spark).withColumn("capture_date", F.lit(day).cast("date")), tmp_path / f"x-{day}.csv.gz")
    out = readers.read_daily(spark, [str(tmp_path / f"x-{d}.csv.gz") for d in ("2026-09-15", "2026-09-16")])
    assert {r["day"]: r["count"] for r in out.groupBy("day").count().collect()} == {date(2026, 9, 15): 2, date(2026, 9, 16): 2}
    assert readers.read_daily(spark, []).count() == 0


def test_bundles_and_responses(spark, tmp_path):
    members = dict.fromkeys(readers.BUNDLE_MEMBERS, b"x")
    digest = writers.write_bundle(tmp_path / "good.tar.gz", members)
    writers.write_bundle(tmp_path / "short.tar.gz", {"meta.json": b"x"})
    (tmp_path / "bad.tar.gz").write_bytes(gzip.compress(b"no tar"))
    out = readers.read_bundles(spark, f"{tmp_path}/*.tar.gz").collect()
    assert {r["member"] for r in out if r["valid"]} == set(members) and {r["sha256"] for r in out if r["valid"]} == {digest}
    assert sorted(r["bundle"].rsplit("/", 1)[1] for r in out if not r["valid"]) == ["bad.tar.gz", "short.tar.gz"]
    raw = tmp_path / "raw" / "US-COSTCO"
    raw.mkdir(parents=True)
    (raw / "a.body").write_bytes(b"\x00\xff")
    (raw / "a.meta.json").write_text(json.dumps({"key": "US-COSTCO/a", "url": "u", "status": 200, "headers": {"h": "v"}, "received_at_utc": "2026-09-15T12:00:00Z"}))
    r = readers.read_responses(spark, f"{tmp_path}/raw").first()
    assert (r["feed"], r["status"], bytes(r["body"]), r["headers"]) == ("US-COSTCO", 200, b"\x00\xff", {"h": "v"})


def test_asset_store_recovers(tmp_path):
    store = writers.AssetStore(tmp_path / "store")
    for i, text in enumerate(("one", "two")):
        (tmp_path / "f").write_text(text)
        store.replace("t", "a.txt", tmp_path / "f", f"tok{i}")
    assert store.read("t", "a.txt") == b"two" and store.list_assets("t") == ["a.txt"]
    store.path("t", "a.txt").rename(store.path("t", "a.txt.old-x"))
    store.path("t", "a.txt.next-x").write_text("three")
    assert store.read("t", "a.txt") == b"two"
    assert store.recover("t") == ["a.txt"] and store.read("t", "a.txt") == b"two" and store.list_assets("t") == ["a.txt"]
    with pytest.raises(FileExistsError):
        store.put_if_absent("t", "a.txt", _file(tmp_path, "x"))
    assert store.put_if_absent("t", "b.txt", _file(tmp_path, "x")) == store.put_if_absent("t", "b.txt", _file(tmp_path, "x"))


def _file(folder, text):
    (folder / "tmp").write_text(text)
    return folder / "tmp"


def test_watch_list_keeps_its_bytes(tmp_path):
    path = tmp_path / "watch.csv"
    path.write_text("feed,source_station_id,detected,status,publish_from,note\nUS-COSTCO,1,d,on,x,\r\n")
    assert writers.append_watch(path, [{"feed": "US-COSTCO", "source_station_id": "1"}, {"feed": "US-COSTCO", "source_station_id": "2", "note": "n"}], ["feed", "source_station_id", "detected", "status", "publish_from", "note"], "2026-09-15") == 1
    assert path.read_bytes().endswith(b"x,\r\nUS-COSTCO,2,2026-09-15,hold,,n\n")


def capture(spark, hour, ids=(1, 2), price=3.0, day=15, status="ok"):
    cid, at = f"2026-09-{day:02d}T{hour:02d}00Z", datetime(2026, 9, day, hour)
    rows = rows_of(spark, [{"capture_id": cid, "capture_date": date(2026, 9, day), "captured_at_utc": at, "station_key": f"US-COSTCO-{i}", "source_station_id": str(i), "price": price + i} for i in ids])
    known = stations_of(spark, [{"station_key": f"US-COSTCO-{i}", "source_station_id": str(i), "first_seen_utc": at, "last_seen_utc": at, "grades_seen": "regular"} for i in ids])
    return Capture(cid, rows, known, None, {"US-COSTCO": {"status": status}})


def test_history_merges_idempotently_and_closes(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"), thresholds={"US": 45})
    h.merge(capture(spark, 6))
    h.merge(capture(spark, 12, ids=(1,), price=4.0))
    before = sorted(map(tuple, h.captures().select("capture_id", "station_key", "price").collect()))
    h.merge(capture(spark, 12, ids=(1,), price=4.0))
    assert sorted(map(tuple, h.captures().select("capture_id", "station_key", "price").collect())) == before and len(before) == 3
    latest = lambda: sorted(map(tuple, h.table("latest", ROW).select("station_key", "price").collect()))
    status = lambda: {r["station_key"]: r["status"] for r in h.table("stations", STATION).collect()}
    assert latest() == [("US-COSTCO-1", 5.0), ("US-COSTCO-2", 5.0)] and status() == {"US-COSTCO-1": "active", "US-COSTCO-2": "missing"}
    h.merge(capture(spark, 0, ids=(2, 3)))  # late: it widens seen times and adds a station
    assert status() == {"US-COSTCO-1": "active", "US-COSTCO-2": "missing", "US-COSTCO-3": "active"}
    step = (latest(), h.table("latest", ROW).count())
    h.rebuild_current()
    assert (latest(), h.table("latest", ROW).count()) == step
    assert h.close_month("2026-09") == [] and h.manifest("2026-09")["closed"]
    assert spark.read.parquet(f"{tmp_path}/h/months/month=2026-09").count() == 3
    h.merge(capture(spark, 18))
    assert not h.manifest("2026-09")["closed"] and not h.close_year("2026")
    h.captures().where("capture_id <> '2026-09-15T0600Z'").write.mode("overwrite").partitionBy("capture_date").parquet(f"{tmp_path}/other")
    spark.read.schema(ROW).parquet(f"{tmp_path}/other").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture_date").parquet(f"{tmp_path}/h/captures")
    assert h.close_month("2026-09") == ["day 2026-09-15, capture 2026-09-15T0600Z: 0 rows stored, 2 recorded"]
    with pytest.raises(StorageError, match="manifest records 2"):
        h.merge(capture(spark, 21))


def test_a_crash_between_any_two_steps_is_mended_by_merging_again(spark, tmp_path, monkeypatch):
    """Current tables are versions: what isn't written as a whole doesn't count, and a retry converges."""
    whole, h = History(spark, str(tmp_path / "whole")), History(spark, str(tmp_path / "h"))
    for x in (whole, h):
        x.merge(capture(spark, 6))
    whole.merge(capture(spark, 12, ids=(1, 3), price=4.0))
    tables = (("latest", ROW), ("stations", STATION))
    shown = lambda x: [sorted(map(repr, x.table(n, schema).collect())) for n, schema in tables] + [x.merged()]
    swap = History._swap

    class Crash(Exception):
        pass

    for step in ("latest", "stations", "coverage", "commit"):
        def stop(self, df, name, order, step=step):
            if name == step:
                df.write.mode("overwrite").parquet(f"{self.root}/{name}/v99")  # cut short: the folder isn't marked
                os.remove(f"{self.root}/{name}/v99/_SUCCESS")
                raise Crash
            swap(self, df, name, order)

        def no_commit(self, *a):
            raise Crash

        with monkeypatch.context() as m:
            m.setattr(History, *(("_commit", no_commit) if step == "commit" else ("_swap", stop)))
            with pytest.raises(Crash):
                h.merge(capture(spark, 12, ids=(1, 3), price=4.0))
        assert h.merged() == {"2026-09-15T0600Z"} and h.table("stations", STATION).count() >= 2
    h.merge(capture(spark, 12, ids=(1, 3), price=4.0))
    assert shown(h) == shown(whole)
    assert len(h.versions("stations")) <= 2


def test_site_outputs(spark, tmp_path):
    rows = rows_of(spark, [{"lat": 1.0, "lon": 2.0, "price_local_per_litre": 0.8}])
    grades = spark.createDataFrame([], GRADES)
    site.build(spark, grain.daily_grain(rows), rows, stations_of(spark, [{"station_key": "US-COSTCO-1"}]), grades, str(tmp_path / "site"), "2026-09-15T12:00:00Z")
    latest = json.loads((tmp_path / "site" / "latest.json").read_text())
    assert latest[0]["grades"]["regular"]["price"] == 3.0 and json.loads((tmp_path / "site" / "meta.json").read_text())["last_date"] == "2026-09-15"
    assert spark.read.parquet(str(tmp_path / "site" / "summary_daily")).count() == 1
    with pytest.raises(ValueError, match="sort columns"):
        writers.write_parquet(rows, str(tmp_path / "x"), ["nope"])


def test_alerts(spark):
    st = spark.createDataFrame([("A", "failed", 3, None), ("B", "failed", 2, None), ("C", "ok", 0, "c"), ("D", "skipped", 9, None)], "feed string, status string, consecutive_failures int, last_success_capture_id string")
    issues = alerts.Issues()
    issues.open["Capture failing: C"] = ""
    issues.apply(alerts.feed_actions(st).orderBy("title").collect())
    assert issues.log == [("open", "Capture failing: A"), ("close", "Capture failing: C")]
    warned = spark.createDataFrame([("A", "unknown_grade", " E85 "), ("A", "unknown_grade", "E85"), ("D", "unknown_grade", "x")], "feed string, code string, detail string")
    assert [r["title"] for r in alerts.grade_actions(warned, st).collect()] == ["Unknown grade: A E85"]
    assert [a[0] for a in alerts.run_actions(alerts.Run("success", 0, [], "failure", ["r"], 401))] == ["close", "open", "open"]


def test_discovery(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id long")
    assert [r["id"] for r in discover.candidates([ids(1), ids(3)], ids(2), ids(4), 2).orderBy("id").collect()] == [1, 3, 5]
    prices = spark.createDataFrame([(1, 3.5, 4.0), (2, 3.5, None), (3, 1.0, None)], "id long, regular double, premium double")
    found = discover.reports(prices, ids(1), ids())
    assert [w["source_station_id"] for w in discover.to_watch(found, "US-COSTCO")] == ["2"] and "| 2 | 3.5 |" in discover.issue_body(found)
    assert "and 1 more" in discover.issue_body(found, 3)
    b = spark.createDataFrame([("c1", "a1", "US-COSTCO", "ok"), ("c2", None, "US-COSTCO", "ok"), ("c3", "a3", "US-COSTCO", "failed")], "capture_id string, asset string, feed string, status string")
    assert tuple(discover.select_bundle(b).first()) == ("c1", "a1")


def test_streams(spark, tmp_path):
    rows = sample(spark)
    rows.write.parquet(f"{tmp_path}/in")
    merged = []
    q = streams.merge_stream(streams.rows_stream(spark, f"{tmp_path}/in"), lambda b: merged.append(b.count()), f"{tmp_path}/ck")
    q.awaitTermination(60)
    assert sum(merged) == 2
    out = streams.windowed_prices(streams.rows_stream(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    out.awaitTermination(60)
    assert spark.table("w").count() == 2


def test_cli_publishes(spark, tmp_path):
    from pricegrain import cli

    c = capture(spark, 6)
    folder = tmp_path / "capture"
    folder.mkdir()
    writers.write_csv(c.rows, folder / "rows.csv", ROWS)
    writers.write_csv(c.stations, folder / "stations.csv", STATIONS)
    (folder / "status.json").write_text(json.dumps({"capture_id": c.capture_id, "feeds": c.feeds}))
    assert cli.main(["--root", str(tmp_path / "h"), "publish", str(folder)]) == 0
    assert cli.main(["--root", str(tmp_path / "h"), "close-periods", "--through", "2026-09"]) == 0
    assert History(spark, str(tmp_path / "h")).manifest("2026-09")["closed"]


def test_entry_works_without_the_training_operators(monkeypatch):
    """The registry imports and keeps its own queries when the other subpackage is gone."""
    import importlib

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("pricegrain.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert "daily_grain" in entry.queries() and "pipeline" not in entry.queries() and set(entry.queries()) == set(entry.oracle_sql())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
