"""Feed parsers on bodies built here."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pricegrain.sources import feeds as P

T = datetime(2026, 9, 15, 12)


def responses(spark, *rows):
    return spark.createDataFrame([(k, f"https://host.example/{k}", status, error, None if body is None else bytearray(body if isinstance(body, bytes) else body.encode()), T) for k, status, error, body in rows], "key string, url string, status int, error string, body binary, received_at_utc timestamp")


def test_price_batches(spark):
    r = responses(
        spark,
        ("US/p1", 200, None, '﻿\r\n{"1":{"regular":"3.1","oid":{"$oid":"z"},"WarehouseId":"1","premium":3.9,"flag":true},"2":{}}'),
        ("US/p2", 200, None, '{"errorMessage":"no"}'),
        ("US/p3", 503, None, None),
        ("US/p4", 200, None, '{"1":{"regular":"9"},"3":{"regular":".959"}}'),
        ("US/p5", 200, None, "<html>"),
    )
    prices, failed = P.price_batches(r)
    assert {x["source_station_id"]: x["grades"] for x in prices.collect()} == {"1": {"regular": "3.1", "premium": "3.9"}, "3": {"regular": ".959"}}
    assert sorted(x["key"] for x in failed.collect()) == ["US/p2", "US/p3", "US/p5"]
    assert P.needs_lookup(5, 3, False, True, True) and not P.needs_lookup(4, 2, False, True, False) and P.needs_lookup(4, 0, False, False, False)


def test_lookup_body_starts_with_false(spark):
    w = {"stlocID": 12, "locationName": " Lake ", "address1": "1 St", "city": "C", "state": "WA", "zipCode": "98", "latitude": 47.5, "longitude": -122.3, "openDate": "Sep 12, 1995", "gasStationHours": ["6-9"], "gasPrices": {"warehouseid": "12", "regular": "4.299", "premium": 4.5}}
    found = P.lookup(responses(spark, ("CA/lookup", 200, None, "\r\n" + json.dumps([False, w, {"x": 1}])))).collect()
    assert len(found) == 1
    r = found[0]
    assert (r["source_station_id"], r["name"], r["opening_date"], r["has_hours"]) == ("12", "Lake", date(1995, 9, 12), True)
    assert {(p["grade_raw"], p["price_raw"]) for p in r["prices"]} == {("regular", "4.299"), ("premium", "4.5")}


def test_locator_shapes(spark):
    loc = {"salesLocationId": "7", "name": [{"value": "A", "localeCode": "en"}], "subType": {"code": "x"}, "address": {"line1": "l", "city": "c", "territory": "t", "postalCode": "p", "countryName": "US", "latitude": 1.5, "longitude": 2.5}, "timeZone": "America/Denver", "openingDate": "2020-01-01", "services": [{"code": "gas"}, {"code": " gas ", "openingDate": "2021-02-03T00:00"}]}
    old = {"warehouseId": 8, "subType": {"code": P.STANDALONE_GAS}, "address": {"countryName": "CA"}}
    a = P.locator(responses(spark, ("s", 200, None, json.dumps({"salesLocations": [loc]})))).collect()
    b = P.locator(responses(spark, ("s", 200, None, json.dumps({"warehouses": [old]})))).collect()
    assert (a[0]["id"], a[0]["opening_date"], a[0]["has_gas"], a[0]["lat"]) == ("7", date(2021, 2, 3), True, 1.5)
    assert (b[0]["id"], b[0]["country"], b[0]["name"], b[0]["has_gas"]) == ("8", "CA", "8", True)


def store(**more):
    return {"name": "Lake Haven", "displayName": "Lake Haven ", "warehouseCode": "AU_107", "gasTypes": [{"name": "E10", "price": "$1.599"}, {"name": "", "price": "1"}], "geoPoint": {"latitude": -33.0, "longitude": 151.0}, "address": {"line1": "1 Rd", "postalCode": "2263 ", "town": "Lake Haven NSW", "formattedAddress": "1 Rd, Lake Haven"}} | more


def test_occ_pages(spark):
    page = lambda i, stores: json.dumps({"pagination": {"currentPage": i, "totalPages": 3}, "stores": stores})
    r = responses(spark, ("AU-COSTCO/0", 200, None, page(0, [store(), store(gasTypes=[])])), ("AU-COSTCO/1", 200, None, page(1, [store(name="X", warehouseCode=None)])), ("AU-COSTCO/2", 500, None, None))
    out = P.occ_stations(r, "AU")
    got = {x["source_station_id"]: x for x in out.stations.collect()}
    assert set(got) == {"107", "X"}
    assert (got["107"]["region"], got["107"]["city"], got["107"]["postcode"], got["107"]["alt_id"]) == ("NSW", "Lake Haven", "2263", "Lake Haven")
    assert [tuple(p) for p in got["107"]["prices"]] == [("E10", "$1.599")]
    assert {(w["code"], w["detail"]) for w in out.warnings.collect()} == {("missing_warehouse_code", "Lake Haven"), ("deadline_exceeded", "stopped after page 2 of 3")}
    assert [(e["code"], e["http_status"]) for e in out.errors.collect()] == [("http_error", 500)]


def test_occ_jp(spark):
    s = store(address={"line1": "811-2501", "line2": "　福岡県糟屋郡久山町大字"}, warehouseCode="JP_1")
    r = P.occ_stations(responses(spark, ("JP-COSTCO/0", 200, None, json.dumps({"pagination": {"currentPage": 0, "totalPages": 1}, "stores": [s]}))), "JP").stations.first()
    assert (r["source_station_id"], r["region"], r["city"], r["postcode"], r["name_local"]) == ("Lake Haven", "福岡県", "久山町", "811-2501", "Lake Haven")


def page(prices, node=None, name="Club"):
    data = {"props": {"pageProps": {"initialTempoData": {"contentLayout": {"modules": [{"configs": {}}, {"configs": {"storeFuelPrices": {"storeName": name, "prices": prices}}}]}}, "initialNodeDetail": {"data": {"nodeDetail": node or {"name": "Club 1", "timeZone": {"id": "America/Chicago"}, "operationalHours": [{"closed": True}], "services": [{"name": P.FUEL_SERVICE, "operationalHours": [{"closed": False}]}]}}}}}}
    return f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps(data)}</script></html>'


def test_sams(spark):
    fuel = lambda n, g, p: {"type": "fuel", "name": n, "gradeId": g, "price": p}
    r = responses(
        spark,
        ("US-SAMS/1", 200, None, page([fuel("UNLEAD", 11, 2.899), fuel("UNLEAD", 14, 3.1), fuel("PREMIUM", 16, 2.5), fuel("DIESEL", 21, 3.7), {"type": "x", "name": "y", "price": 1}])),
        ("US-SAMS/2", 307, None, None),
        ("US-SAMS/3", 200, None, page([], name=P.INVALID_STORE)),
        ("US-SAMS/4", None, "deadline_exceeded", None),
        ("US-SAMS/5", 500, None, None),
    )
    roster = spark.createDataFrame([(str(i), "sitemap") for i in range(1, 7)], "source_station_id string, id_origin string")
    out = P.sams_stations(r, roster)
    s = out.stations.collect()
    assert len(s) == 1 and [tuple(p) for p in s[0]["prices"]] == [("UNLEAD", "2.899"), ("DIESEL", "3.700")] and s[0]["has_hours"] is True
    assert {(w["code"], w["detail"]) for w in out.warnings.collect()} == {("mislabeled_grade", "1:UNLEAD=3.100"), ("below_regular", "1:PREMIUM=2.500"), ("not_reached", "4"), ("not_reached", "6")}
    assert [e["http_status"] for e in out.errors.collect()] == [500]


def test_rates(spark):
    a = P.frankfurter(responses(spark, ("fx/a", 200, None, json.dumps([{"date": "2026-09-14", "base": "USD", "quote": "CAD", "rate": 1.38}, {"date": "2026-09-14", "base": "USD", "quote": "BAD", "rate": -1}])))).collect()
    b = P.dated_rates(responses(spark, ("fx/b", 200, None, json.dumps({"date": "2026-09-14", "usd": {"cad": 1.37}})), ("fx/c", 200, None, json.dumps({"date": "2026-09-15", "usd": {"cad": 1.39}})))).collect()
    assert [(r["currency"], r["units_per_usd"], r["fx_rate_date"]) for r in a] == [("CAD", 1.38, date(2026, 9, 14))]
    assert [(r["currency"], r["units_per_usd"]) for r in b] == [("CAD", 1.39)]


def test_us_and_ca_stations(spark):
    polled = spark.createDataFrame([("1", "ecom", "gas"), ("2", "seen", "absent")], "source_station_id string, id_origin string, ecom_state string")
    prices, _ = P.price_batches(responses(spark, ("p", 200, None, '{"1":{"regular":"3.1"},"2":{"regular":"3.2"}}')))
    places = P.locator(responses(spark, ("s", 200, None, json.dumps({"salesLocations": [{"salesLocationId": "1", "name": [{"value": "One"}], "address": {"countryName": "US"}, "services": [{"code": "gas"}], "timeZone": "UTC"}]}))))
    kept = "source_station_id string, alt_id string, name string, name_local string, address string, city string, region string, postcode string, lat double, lon double, timezone string"
    cached = spark.createDataFrame([("2", None, "Two", None, None, None, None, None, 1.0, 2.0, "America/Denver")], kept)
    out = {r["source_station_id"]: r for r in P.us_stations(polled, prices, places, spark.createDataFrame([], kept), cached).collect()}
    assert (out["1"]["name"], out["2"]["name"], out["2"]["timezone"]) == ("One", "Two", "America/Denver")
    back = P.ca_fallback(prices, cached)
    assert [r["source_station_id"] for r in back.stations.collect()] == ["2"]
    assert {r["code"] for r in back.warnings.collect()} == {"no_metadata", "fallback_used", "metadata_from_cache"}


@pytest.mark.parametrize("entry, open_", [("{}", None), ('{"open24Hours":true}', True), ('{"operationalHours":[{"closed":true}]}', False), ('{"operationalHours":[{}]}', True)])
def test_open_some_day(spark, entry, open_):
    df = spark.createDataFrame([(entry,)], "t string").select(F.from_json("t", f"struct<{P._HOURS}>").alias("e"))
    assert df.select(P.open_some_day(F.col("e"))).first()[0] is open_
