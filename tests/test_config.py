"""Configuration files, their faults, and a capture from stored responses."""

import json

import pytest
from test_feeds import responses, store

from pricegrain import config
from pricegrain.plans import capture
from pricegrain.plans.history import History
from pricegrain.schemas import FX, ROW, STATION

COUNTRIES = """
[countries.AU]
url = "https://host.example/stores"
price_unit = "AUD/L"
floor = 1
stale_after_days = 3
closed_after_days = 45
[countries.AU.bounds."AUD/L"]
min = 1.2
max = 3.4
[countries.AU.bounds."AUD/L".grades.LPG]
min = 0.5
max = 2.0
[countries.AU.timezones]
"*" = "Australia/Sydney"
WA = "Australia/Perth"
"""
GRADES = "brand,country,grade_raw,grade,priority,label,spec,spec_source,spec_source_url\nCOSTCO,AU,E10,regular,1,E10,,,\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "countries.toml").write_text(COUNTRIES)
    (tmp_path / "grades.csv").write_text(GRADES)
    return tmp_path


def test_load_and_views(spark, folder):
    cfg = config.load(folder)
    assert cfg.thresholds() == {"AU": 45} and "floor" not in cfg.fetch_view()["countries"]["AU"] and "url" not in cfg.interpretation_view()["countries"]["AU"]
    dims = cfg.dimensions(spark)
    assert sorted((r["grade_raw"] or "", r["low"]) for r in dims.bounds.collect()) == [("", 1.2), ("LPG", 0.5)]
    assert dims.watch.count() == 0 and cfg.extras(spark).count() == 0 and cfg.zones(spark).count() == 2


@pytest.mark.parametrize(
    "name, old, new, fault",
    [
        ("countries.toml", "AUD/L", "AUD/m", "unknown unit"),
        ("countries.toml", "max = 3.4", "max = 1.0", "are empty"),
        ("countries.toml", "floor = 1", "floor = 0", "floor must"),
        ("countries.toml", "floor = 1", "floor = 1\nbatch_size = 11", "batch_size"),
        ("countries.toml", "Australia/Perth", "Nowhere/Land", "unknown zone"),
        ("countries.toml", "[countries.AU]", "[countries.AU", "countries.toml"),
        ("grades.csv", "regular", "super", "unknown grade"),
        ("grades.csv", ",AU,", ",XX,", "unknown country"),
        ("grades.csv", "priority", "rank", "no column priority"),
        ("watch.csv", None, "feed,source_station_id,detected,status,publish_from,note\nAU-COSTCO,1,2026-01-01,on,,\n", "publish_from"),
        ("watch.csv", None, "feed,source_station_id,detected,status,publish_from,note\nZZ-COSTCO,1,2026-01-01,hold,,\n", "configured country"),
        ("station_links.csv", None, "old_station_key,new_station_key\na,b\na,c\n", "listed twice"),
    ],
)
def test_faults(folder, name, old, new, fault):
    path = folder / name
    path.write_text(path.read_text().replace(old, new) if old else new)
    with pytest.raises(config.ConfigError, match=fault):
        config.load(folder)


def test_capture_from_stored_responses(spark, folder, tmp_path):
    cfg = config.load(folder)
    page = json.dumps({"pagination": {"currentPage": 0, "totalPages": 1}, "stores": [store(), store(name="B", warehouseCode="AU_9", gasTypes=[{"name": "E10", "price": "9.99"}])]})
    rates = json.dumps([{"date": "2026-09-14", "base": "USD", "quote": "AUD", "rate": 1.5}])
    stored = responses(spark, ("AU-COSTCO/0", 200, None, page), ("fx/frankfurter", 200, None, rates)).selectExpr("*", "substring_index(key, '/', 1) AS feed")
    done = capture.run(spark, stored, cfg, "2026-09-15T1200Z", "2026-09-15 12:00:00", selected=["AU-COSTCO"])
    rows = done.capture.rows.collect()
    assert [(r["station_key"], r["grade"], r["timezone"], r["price_usd_per_litre"]) for r in rows] == [("AU-COSTCO-107", "regular", "Australia/Sydney", pytest.approx(1.599 / 1.5))]
    judged = {r["feed"]: r["status"] for r in done.statuses.collect()}
    assert judged["AU-COSTCO"] == "degraded" and judged["GB-COSTCO"] == "skipped"
    h = History(spark, str(tmp_path / "h"))
    h.merge(done.capture)
    assert h.table("latest", ROW).count() == 1 and h.table("stations", STATION).first()["status"] == "active" and h.table("fx", FX).count() == 1


US_CA = """
[countries.US]
url = "https://host.example/us"
price_unit = "USD/gal"
floor = 1
stale_after_days = 3
closed_after_days = 45
[countries.US.bounds."USD/gal"]
min = 2.0
max = 11.0
[countries.US.timezones]
"*" = "America/Denver"
[countries.CA]
url = "https://host.example/ca"
price_unit = "CAD/L"
floor = 1
stale_after_days = 3
closed_after_days = 45
[countries.CA.bounds."CAD/L"]
min = 1.0
max = 3.5
[countries.CA.timezones]
"*" = "America/Toronto"
"""


def test_all_feeds_are_captured_from_stored_responses(spark, folder):
    """Sources and drops belong to their feed, also where two feeds share an id; normalization's warnings count."""
    (folder / "countries.toml").write_text(COUNTRIES + US_CA)
    (folder / "grades.csv").write_text(GRADES + "COSTCO,US,regular,regular,1,R,,,\nSAMS,US,UNLEAD,regular,1,R,,,\nCOSTCO,CA,regular,regular,1,R,,,\n")
    cfg = config.load(folder)
    place = {"salesLocationId": "7", "name": [{"value": "Seven"}], "address": {"countryName": "US", "territory": "CO"}, "services": [{"code": "gas"}], "timeZone": "America/Denver"}
    looked_up = [False, {"stlocID": 9, "locationName": "Nine", "state": "ON", "latitude": 1.0, "longitude": 2.0, "gasStationHours": [{}], "gasPrices": {"regular": "1.5", "Mystery": "1.6"}}]
    club = {"props": {"pageProps": {"initialTempoData": {"contentLayout": {"modules": [{"configs": {"storeFuelPrices": {"storeName": "S", "prices": [{"type": "fuel", "name": "UNLEAD", "gradeId": 11, "price": 99.0}]}}}]}}, "initialNodeDetail": {"data": {"nodeDetail": {"name": "n", "timeZone": {"id": "America/Denver"}}}}}}}
    page = json.dumps({"pagination": {"currentPage": 0, "totalPages": 1}, "stores": [store()]})
    stored = responses(
        spark,
        ("US-COSTCO/02-gasprices-001", 200, None, '{"7":{"regular":"3.1"}}'), ("US-COSTCO/02-gasprices-002", 500, None, "x"), ("US-COSTCO/02-gasprices-003", None, "deadline_exceeded", None),
        ("CA-COSTCO/01-lookup", 200, None, json.dumps(looked_up)), ("US-SAMS/02-7", 200, None, f'<script id="__NEXT_DATA__">{json.dumps(club)}</script>'),
        ("AU-COSTCO/0", 200, None, page), ("shared/ecom-api", 200, None, json.dumps({"salesLocations": [place]})),
        ("fx/frankfurter", 200, None, json.dumps([{"date": "2026-09-14", "base": "USD", "quote": q, "rate": 1.5} for q in ("AUD", "CAD")])),
    ).selectExpr("*", "substring_index(key, '/', 1) AS feed")
    ids = lambda **more: spark.createDataFrame([{"source_station_id": "7", "id_origin": "seen", **more}])
    done = capture.run(spark, stored, cfg, "2026-09-15T1200Z", "2026-09-15 12:00:00", {"US-COSTCO": ids(ecom_state="gas"), "US-SAMS": ids()}, selected=["US-COSTCO", "CA-COSTCO", "US-SAMS", "AU-COSTCO"])
    rows = {(r["station_key"], r["grade_raw"]): r for r in done.capture.rows.collect()}
    assert {k: r["source"] for k, r in rows.items()} == {("US-COSTCO-7", "regular"): "costco-us-gasprices", ("CA-COSTCO-9", "regular"): "costco-ca-lookup", ("CA-COSTCO-9", "Mystery"): "costco-ca-lookup", ("AU-COSTCO-107", "E10"): "costco-occ"}
    assert rows["US-COSTCO-7", "regular"]["name"] == "Seven" and rows["CA-COSTCO-9", "regular"]["timezone"] == "America/Toronto"
    assert {(r["feed"], r["reason"]) for r in done.normalized.drops.collect()} == {("US-SAMS", "out_of_bounds")}
    judged = {r["feed"]: r["status"] for r in done.statuses.collect()}
    assert judged["US-SAMS"] == "failed" and judged["CA-COSTCO"] == "degraded" and judged["GB-COSTCO"] == "skipped" and len(judged) == 8
    said = {f: {w["code"] for w in b["warnings"]} for f, b in done.capture.feeds.items()}
    assert said["CA-COSTCO"] == {"unknown_grade"} and said["US-COSTCO"] == {"deadline_exceeded"}
