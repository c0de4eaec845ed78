"""Feed parsers as table functions: raw response bodies to raw stations, warnings and errors.

Bodies arrive as a DataFrame (key, url, status, error, body, received_at_utc). Each parser is one plan of
JSON functions; nothing is parsed row by row in Python. Content types are never consulted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

NON_GRADE_KEYS = ("warehouseid", "oid")
#: The label that goes with each fuel gradeId; others are taken at their name.
GRADE_NAMES = {11: "UNLEAD", 13: "MID CLR", 14: "MIDGRAD", 16: "PREMIUM", 21: "DIESEL"}
FUEL_SERVICE, INVALID_STORE, STANDALONE_GAS = "GAS_SAMS", "INVALID STORE", "standaloneGas"
REDIRECTS = (301, 302, 303, 307, 308)


@dataclass
class Parsed:
    stations: DataFrame
    warnings: DataFrame
    errors: DataFrame | None = None
    extra: dict = field(default_factory=dict)


def body_text(body="body") -> Column:
    """The body as text without a byte-order mark and white space around it."""
    return F.regexp_replace(F.decode(F.col(body), "utf-8"), "^[\ufeff\\s]+|\\s+$", "")


def answered() -> Column:
    return F.col("error").isNull() & (F.col("status") == 200)


def grade_map(text: Column) -> Column:
    """Label to price text of a JSON object; row identifiers, booleans, nulls and nested values are left out."""
    usable = lambda k, v: ~F.lower(k).isin(*NON_GRADE_KEYS) & v.isNotNull() & ~v.isin("true", "false") & ~v.startswith("{") & ~v.startswith("[")
    return F.map_filter(F.from_json(text, "map<string,string>"), usable)


def price_array(grades: Column) -> Column:
    return F.transform(F.map_entries(grades), lambda e: F.struct(e["key"].alias("grade_raw"), e["value"].alias("price_raw")))


def price_batches(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prices of a batch service: (source_station_id, grades) with the first non-empty answer of each id, and
    (key) of the batches that failed. A failed batch isn't an answer without prices."""
    outer = F.from_json(body_text(), "map<string,string>")
    text = body_text()
    good = F.coalesce(answered() & text.startswith("{") & outer.isNotNull() & ~F.map_contains_key(outer, F.lit("errorMessage")), F.lit(False))
    marked = responses.withColumn("_ok", good).withColumn("_map", outer)
    found = marked.where("_ok").select("key", F.explode("_map").alias("source_station_id", "_text")).where(F.col("_text").startswith("{"))
    found = found.withColumn("grades", grade_map(F.col("_text"))).where(F.size("grades") > 0)
    first = F.row_number().over(Window.partitionBy("source_station_id").orderBy("key"))
    return found.withColumn("_n", first).where("_n = 1").select("source_station_id", "grades"), marked.where("NOT _ok").select("key")


LOOKUP = (
    "struct<stlocID:string,locationName:string,displayName:string,address1:string,city:string,state:string,zipCode:string,country:string,"
    "latitude:double,longitude:double,openDate:string,gasStationHours:array<string>,gasPrices:string>"
)


def lookup(responses: DataFrame) -> DataFrame:
    """Warehouses of a lookup body: an array whose first element is ``false`` and not an object."""
    each = F.explode(F.from_json(body_text(), "array<string>"))
    rows = responses.where(answered()).select("key", each.alias("_text")).where(F.col("_text").startswith("{"))
    w = F.from_json("_text", LOOKUP)
    out = rows.select("key", w.alias("w")).where("w.stlocID IS NOT NULL").select("key", "w.*")
    return out.select(
        F.col("stlocID").alias("source_station_id"),
        S.clean("locationName").alias("name"),
        S.clean("address1").alias("address"),
        S.clean("city").alias("city"),
        S.clean("state").alias("region"),
        S.clean("zipCode").alias("postcode"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        S.open_date("openDate").alias("opening_date"),
        F.when(F.col("gasStationHours").isNotNull(), F.size("gasStationHours") > 0).alias("has_hours"),
        price_array(grade_map(F.col("gasPrices"))).alias("prices"),
    )


_SERVICES = "array<struct<code:string,openingDate:string>>"
_LOCATION = (
    "struct<salesLocationId:string,warehouseId:string,name:array<struct<value:string,localeCode:string>>,subType:struct<code:string>,"
    "address:struct<line1:string,city:string,territory:string,postalCode:string,countryName:string,latitude:double,longitude:double>,"
    f"timeZone:string,openingDate:string,services:{_SERVICES}>"
)


def sells_gas(services: Column, sub_type: Column) -> Column:
    """A gas service, or a standalone gas station, which lists none."""
    return F.coalesce(F.exists(services, lambda s: F.trim(s["code"]) == "gas"), F.lit(False)) | F.coalesce(F.trim(sub_type) == STANDALONE_GAS, F.lit(False))


def fuel_opening_date(services: Column, own: Column) -> Column:
    """The date of the first dated gas service, else the location's."""
    dates = F.transform(F.filter(services, lambda s: F.trim(s["code"]) == "gas"), lambda s: S.iso_date(s["openingDate"]))
    return F.coalesce(F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0)), S.iso_date(own))


def locator(responses: DataFrame) -> DataFrame:
    """Locations of a locator body in either of its two shapes."""
    shape = f"struct<salesLocations:array<{_LOCATION}>,warehouses:array<{_LOCATION}>>"
    body = F.from_json(body_text(), shape)
    rows = responses.where(answered()).select(F.explode(F.coalesce(body["salesLocations"], body["warehouses"])).alias("l"))
    out = rows.select("l.*").withColumn("id", S.clean(F.coalesce("salesLocationId", "warehouseId"))).where("id IS NOT NULL")
    return out.select(
        "id",
        F.coalesce(S.clean("address.countryName"), F.lit("")).alias("country"),
        F.coalesce(S.clean(F.get("name", F.lit(0))["value"]), F.when(F.coalesce(F.size("name"), F.lit(0)) < 1, F.col("id"))).alias("name"),
        S.clean("address.line1").alias("address"),
        S.clean("address.city").alias("city"),
        S.clean("address.territory").alias("region"),
        S.clean("address.postalCode").alias("postcode"),
        F.col("address.latitude").alias("lat"),
        F.col("address.longitude").alias("lon"),
        S.clean("timeZone").alias("timezone"),
        fuel_opening_date(F.col("services"), F.col("openingDate")).alias("opening_date"),
        sells_gas(F.col("services"), F.col("subType.code")).alias("has_gas"),
    )


def needs_lookup(batches: int, failed: int, cut_short: bool, has_locator: bool, has_cache: bool) -> bool:
    """Whether prices come from the lookup: over half the batches failed, attempts cut short, or no metadata at all."""
    return failed * 2 > batches or cut_short or not (has_locator or has_cache)


def us_stations(polled: DataFrame, prices: DataFrame, places: DataFrame | None, extras: DataFrame, previous: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Raw US stations: polled ids with prices and the first metadata found along the fixed chain.

    The chain is: locator where it sells gas, described extra, locator without gas in the same country,
    previous station, lookup. ``polled`` has source_station_id, id_origin and ecom_state.
    """
    from ..operators.stations import merge_metadata

    fields = ("name", "address", "city", "region", "postcode", "lat", "lon", "timezone", "opening_date")
    own = lambda df, key: df.select(F.col(key).alias("source_station_id"), *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in fields], *[c for c in ("country", "has_gas") if c in df.columns])
    chain: list[tuple[DataFrame, Column]] = []
    if places is not None:
        known = own(places, "id")
        chain.append((known, (F.col("has_gas")) & (F.col("country") == "US")))
    chain.append((own(extras, "source_station_id"), F.lit(True)))
    if places is not None:
        chain.append((known, ~F.col("has_gas") & (F.col("country") == "US")))
    chain.append((own(previous, "source_station_id"), F.lit(True)))
    if found is not None:
        chain.append((own(found, "source_station_id"), F.lit(True)))
    out = merge_metadata(polled.select("source_station_id", "id_origin", "ecom_state"), chain, fields).join(prices, "source_station_id", "left")
    out = out.join(extras.select("source_station_id", F.lit(True).alias("_extra")).distinct(), "source_station_id", "left")
    posted = F.when(F.size("grades") > 0, price_array(F.col("grades")))
    if found is not None:
        out = out.join(found.select("source_station_id", F.col("prices").alias("_prices"), F.coalesce("has_hours", F.lit(False)).alias("_hours")), "source_station_id", "left")
        looked_up = posted.isNull() & (F.coalesce(F.size("_prices"), F.lit(0)) > 0)
        out = out.withColumns({"prices": F.coalesce(posted, "_prices"), "id_origin": F.when(looked_up, "lookup").otherwise(F.col("id_origin")), "has_hours": F.when(looked_up & F.col("_extra").isNull(), F.col("_hours"))})
    else:
        out = out.withColumns({"prices": posted, "has_hours": F.lit(None).cast("boolean")})
    out = out.withColumns({"opening_date": F.when(F.col("_extra").isNull(), F.col("opening_date")), "name": F.coalesce("name", "source_station_id")})
    return _raw(out.withColumn("country", F.lit("US")).withColumn("brand", F.lit("COSTCO")))


def failed(responses: DataFrame, code: str, usable: Column | None = None) -> DataFrame:
    """Errors (code, host, http_status, detail) of the responses that aren't usable."""
    good = answered() if usable is None else usable
    return responses.where(~F.coalesce(good, F.lit(False))).select(F.lit(code).alias("code"), F.parse_url("url", F.lit("HOST")).alias("host"), F.col("status").alias("http_status"), F.coalesce("error", "key").alias("detail"))


def us_feed(responses: DataFrame, polled: DataFrame, places: DataFrame | None, extras: DataFrame, previous: DataFrame) -> Parsed:
    """The whole US feed from its stored responses: batches, the lookup behind them, and what to warn of.

    Without a locator and without previous stations, the lookup's own stations are taken as well.
    """
    said = lambda df, code, detail="source_station_id": df.select(F.lit(code).alias("code"), F.col(detail).alias("detail"))
    late = F.coalesce(F.col("error") == "deadline_exceeded", F.lit(False))
    asked = responses.where(~late)
    batches, looked = asked.where(F.col("key").contains("gasprices")), asked.where(F.col("key").contains("lookup"))
    prices, bad = price_batches(batches)
    found = lookup(looked).dropDuplicates(["source_station_id"])
    errors = failed(batches.join(bad, "key", "left_semi"), "price_batch_failed", F.lit(False)).union(failed(looked, "lookup_failed"))
    cached = previous.limit(1)
    if places is None and not cached.count():
        more = found.join(polled, "source_station_id", "left_anti").where(F.size("prices") > 0)
        polled = polled.select("source_station_id", "id_origin", "ecom_state").union(more.select("source_station_id", F.lit("lookup"), F.lit("unavailable")))
    out = us_stations(polled, prices, places, extras, previous, found)
    warnings = said(responses.where(late), "deadline_exceeded", "key")
    if places is None:
        warnings = warnings.union(cached.select(F.lit("metadata_from_cache"), F.lit("US")))
    warnings = warnings.union(said(out.where("ecom_state = 'absent' AND size(prices) > 0"), "not_in_ecom_api"))
    return Parsed(out, warnings, errors)


def ca_feed(responses: DataFrame, places: DataFrame | None, cached: DataFrame) -> Parsed:
    """The whole Canadian feed: the lookup's stations or, where batches were asked for instead, cached ones."""
    batches, looked = responses.where(F.col("key").contains("gasprices")), responses.where(F.col("key").contains("lookup"))
    errors = lambda df: failed(df, "").withColumn("code", F.when(F.col("http_status").isNull(), "request_failed").otherwise("http_error"))
    if batches.limit(1).count():
        out = ca_fallback(price_batches(batches)[0], cached)
        return Parsed(out.stations, out.warnings, errors(batches))
    none = responses.sparkSession.createDataFrame([], "code string, detail string")
    return Parsed(ca_stations(lookup(looked), places, cached), none, errors(looked))


def ca_stations(found: DataFrame, places: DataFrame | None, cached: DataFrame) -> DataFrame:
    """Raw Canadian stations of the lookup, coordinates, zone and opening date preferring the locator."""
    base = found.withColumn("id_origin", F.lit("lookup"))
    if places is not None:
        base = base.join(places.select(F.col("id").alias("source_station_id"), *[F.col(c).alias(f"_{c}") for c in ("lat", "lon", "timezone", "opening_date")]), "source_station_id", "left")
    else:
        base = base.withColumns({f"_{c}": F.lit(None) for c in ("lat", "lon", "timezone", "opening_date")})
    old = cached.select("source_station_id", *[F.col(c).alias(f"o_{c}") for c in ("lat", "lon", "timezone")])
    base = base.join(old, "source_station_id", "left")
    out = base.withColumns({c: F.coalesce(f"_{c}", c, f"o_{c}") for c in ("lat", "lon")} | {"timezone": F.coalesce("_timezone", "o_timezone"), "opening_date": F.coalesce("_opening_date", "opening_date")})
    return _raw(out.withColumn("country", F.lit("CA")).withColumn("brand", F.lit("COSTCO")))


def ca_fallback(prices: DataFrame, cached: DataFrame) -> Parsed:
    """Canadian prices from the batch service with cached metadata; ids without metadata are warned of."""
    fields = ("alt_id", "name", "name_local", "address", "city", "region", "postcode", "lat", "lon", "timezone")
    joined = prices.join(cached.select("source_station_id", *fields, F.lit(True).alias("_known")), "source_station_id", "left")
    rows = joined.where("_known").withColumn("prices", price_array(F.col("grades"))).withColumn("id_origin", F.lit("cache")).withColumn("country", F.lit("CA")).withColumn("brand", F.lit("COSTCO"))
    warnings = joined.where("_known IS NULL").select(F.lit("no_metadata").alias("code"), F.col("source_station_id").alias("detail"))
    used = rows.limit(1).select(F.explode(F.array(F.lit("fallback_used"), F.lit("metadata_from_cache"))).alias("code"), F.lit("").alias("detail"))
    return Parsed(_raw(rows.drop("grades", "_known")), warnings.union(used))


_STORE = (
    "struct<name:string,displayName:string,warehouseCode:string,gasTypes:array<struct<name:string,price:string>>,"
    "geoPoint:struct<latitude:double,longitude:double>,address:struct<line1:string,line2:string,postalCode:string,town:string,"
    "formattedAddress:string,region:struct<isocode:string>>>"
)
NUMERIC_ID_COUNTRIES = ("AU", "MX", "TW")


def occ_stations(responses: DataFrame, country: str) -> Parsed:
    """Raw stations of a paged store list: stores that list fuel, keyed by number or by name as the country does."""
    shape = f"struct<pagination:struct<currentPage:int,totalPages:int>,stores:array<{_STORE}>>"
    parsed = responses.withColumn("_p", F.from_json(body_text(), shape)).withColumn("_ok", F.coalesce(answered() & (F.col("_p.pagination").isNotNull() | F.col("_p.stores").isNotNull()), F.lit(False)))
    s = parsed.where("_ok").select(F.explode("_p.stores").alias("s")).where(F.coalesce(F.size("s.gasTypes"), F.lit(0)) > 0).select("s.*")
    t = {k: S.clean(c) for k, c in {"own": "name", "shown": "displayName", "code": "warehouseCode", "line1": "address.line1", "line2": "address.line2", "town": "address.town", "postal": "address.postalCode", "formatted": "address.formattedAddress", "iso": "address.region.isocode"}.items()}
    rows = s.select("gasTypes", "geoPoint", *[c.alias(f"_{k}") for k, c in t.items()])
    c = F.col
    number = S.trailing_number("_code")
    numeric = country in NUMERIC_ID_COUNTRIES
    street = F.coalesce("_formatted", "_line1")
    place = {
        "JP": (S.jp_city("_line2"), S.jp_region("_line2"), c("_line1"), c("_line2")),
        "TW": (F.lit(None).cast("string"), S.tw_region("_formatted"), c("_postal"), street),
        "AU": (S.au_city("_town"), S.au_region("_town", "_formatted", "_postal"), c("_postal"), street),
        "GB": (c("_shown"), F.lit(None).cast("string"), c("_postal"), street),
        "MX": (c("_town"), S.strip_prefix("_iso", "MX-"), c("_postal"), street),
    }[country]
    entries = F.filter(F.transform("gasTypes", lambda g: F.struct(S.clean(g["name"]).alias("grade_raw"), S.clean(g["price"]).alias("price_raw"))), lambda g: g["grade_raw"].isNotNull() & g["price_raw"].isNotNull())
    out = rows.withColumn("source_station_id", F.coalesce(number, "_own") if numeric else c("_own")).withColumn("alt_id", c("_own") if numeric else c("_code"))
    out = out.withColumn("_no_number", number.isNull())
    warnings = out.where("source_station_id IS NULL").select(F.lit("missing_station_id").alias("code"), F.coalesce("_shown", "_code", F.lit("")).alias("detail"))
    if numeric:
        warnings = warnings.union(out.where("_no_number").select(F.lit("missing_warehouse_code").alias("code"), F.coalesce("_shown", "_own", F.lit("")).alias("detail")))
    last = parsed.where("_ok").agg(F.max_by("_p.pagination", "key").alias("p")).where("p.currentPage + 1 < p.totalPages")
    warnings = warnings.union(last.select(F.lit("deadline_exceeded").alias("code"), F.concat(F.lit("stopped after page "), (F.col("p.currentPage") + 1).cast("string"), F.lit(" of "), F.col("p.totalPages").cast("string")).alias("detail")))
    stations = out.where("source_station_id IS NOT NULL").select(
        "source_station_id", "alt_id", F.lit("occ").alias("id_origin"), F.coalesce("_own", "_shown", "source_station_id").alias("name"),
        (c("_shown") if country in ("JP", "TW") else F.lit(None).cast("string")).alias("name_local"),
        place[3].alias("address"), place[0].alias("city"), place[1].alias("region"), place[2].alias("postcode"),
        c("geoPoint.latitude").alias("lat"), c("geoPoint.longitude").alias("lon"), entries.alias("prices"),
    )
    errors = parsed.where("NOT _ok").select(F.when(c("status").isNull(), "request_failed").otherwise("http_error").alias("code"), F.parse_url("url", F.lit("HOST")).alias("host"), F.col("status").alias("http_status"), F.coalesce("error", F.concat("key", F.lit(": unparseable body"))).alias("detail"))
    return Parsed(_raw(stations.withColumn("country", F.lit(country)).withColumn("brand", F.lit("COSTCO"))), warnings, errors)


def next_data(html) -> Column:
    """The JSON that a page embeds for its scripts."""
    return F.nullif(F.regexp_extract(S.col(html), r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), F.lit(""))


_DAY = "struct<closed:boolean>"
_HOURS = f"open24Hours:boolean,operationalHours:array<{_DAY}>"


def open_some_day(entry: Column) -> Column:
    """Whether a club or service lists an open day; null when it lists no hours."""
    listed = F.exists(entry["operationalHours"], lambda d: ~F.coalesce(d["closed"], F.lit(False)))
    return F.when(entry["open24Hours"], True).when(entry["operationalHours"].isNotNull(), listed)


def sams_stations(responses: DataFrame, roster: DataFrame) -> Parsed:
    """Raw stations of fuel-centre pages: prices checked against their gradeId and the club's regular price.

    Redirects and unknown clubs have no fuel. ``roster`` has source_station_id and id_origin; ids without a
    response were not reached.
    """
    module = "struct<configs:struct<storeFuelPrices:struct<storeName:string,prices:array<struct<type:string,name:string,gradeId:int,price:double>>>>>"
    node = f"struct<name:string,displayName:string,timeZone:struct<id:string>,address:struct<addressLineOne:string,city:string,state:string,postalCode:string>,geoPoint:struct<latitude:double,longitude:double>,{_HOURS},services:array<struct<name:string,{_HOURS}>>>"
    shape = f"struct<props:struct<pageProps:struct<initialTempoData:struct<contentLayout:struct<modules:array<{module}>>>,initialNodeDetail:struct<data:struct<nodeDetail:{node}>>>>>"
    pages = responses.withColumn("source_station_id", F.regexp_extract("key", r"(\d+)$", 1)).withColumn("_page", F.from_json(next_data(F.decode("body", "utf-8")), shape)["props"]["pageProps"])
    fuel = F.get(F.filter(F.transform("_page.initialTempoData.contentLayout.modules", lambda m: m["configs"]["storeFuelPrices"]), lambda x: x.isNotNull()), F.lit(0))
    pages = pages.withColumn("_fuel", fuel).withColumn("_node", F.col("_page.initialNodeDetail.data.nodeDetail"))
    usable = answered() & F.col("_fuel").isNotNull() & ~F.coalesce(F.col("_fuel.storeName") == INVALID_STORE, F.lit(False))
    entries = pages.where(usable).select("source_station_id", F.posexplode("_fuel.prices").alias("pos", "e")).where("e.type = 'fuel' AND e.name IS NOT NULL AND e.price > 0")
    names = F.create_map(*[F.lit(x) for kv in GRADE_NAMES.items() for x in kv])
    entries = entries.select("source_station_id", "pos", F.col("e.name").alias("grade_raw"), F.col("e.price").alias("price"), S.fixed3("e.price").alias("price_raw"), F.coalesce(names[F.col("e.gradeId")] != F.col("e.name"), F.lit(False)).alias("mislabeled"))
    regular = F.max(F.when(~F.col("mislabeled") & (F.col("grade_raw") == "UNLEAD"), F.col("price"))).over(Window.partitionBy("source_station_id"))
    entries = entries.withColumn("below", F.coalesce(F.col("price") < regular, F.lit(False)) & ~F.col("mislabeled"))
    good = entries.where("NOT mislabeled AND NOT below").groupBy("source_station_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "grade_raw", "price_raw"))), lambda p: F.struct(p["grade_raw"].alias("grade_raw"), p["price_raw"].alias("price_raw"))).alias("prices"))
    service = F.get(F.filter("_node.services", lambda s: s["name"] == FUEL_SERVICE), F.lit(0))
    verdicts = F.filter(F.array(open_some_day(F.col("_node")), open_some_day(service)), lambda v: v.isNotNull())
    base = pages.where(usable).withColumn("has_hours", F.when(F.size(verdicts) > 0, F.exists(verdicts, lambda v: v))).join(good, "source_station_id", "left").join(roster.select("source_station_id", "id_origin"), "source_station_id", "left")
    n = F.col("_node")
    stations = base.select("source_station_id", "id_origin", F.coalesce(n["displayName"], n["name"]).alias("name"), n["address"]["addressLineOne"].alias("address"), n["address"]["city"].alias("city"), n["address"]["state"].alias("region"), n["address"]["postalCode"].alias("postcode"), n["geoPoint"]["latitude"].alias("lat"), n["geoPoint"]["longitude"].alias("lon"), n["timeZone"]["id"].alias("timezone"), "has_hours", "prices")
    said = lambda df, code: df.select(F.lit(code).alias("code"), F.concat("source_station_id", F.lit(":"), "grade_raw", F.lit("="), "price_raw").alias("detail"))
    warnings = said(entries.where("mislabeled"), "mislabeled_grade").union(said(entries.where("below"), "below_regular"))
    warnings = warnings.union(stations.where("prices IS NULL").select(F.lit("no_current_price").alias("code"), F.col("source_station_id").alias("detail")))
    asked = pages.where(F.coalesce(~F.col("error").isin("deadline_exceeded", "host_abandoned"), F.lit(True)))
    missing = roster.join(asked.select("source_station_id"), "source_station_id", "left_anti")
    warnings = warnings.union(missing.select(F.lit("not_reached").alias("code"), F.col("source_station_id").alias("detail")))
    failed = asked.where(~answered() & ~F.coalesce(F.col("status").isin(*REDIRECTS), F.lit(False)))
    errors = failed.select(F.coalesce("error", F.lit("http_error")).alias("code"), F.parse_url("url", F.lit("HOST")).alias("host"), F.col("status").alias("http_status"), F.col("key").alias("detail"))
    return Parsed(_raw(stations.withColumn("country", F.lit("US")).withColumn("brand", F.lit("SAMS"))), warnings, errors)


def frankfurter(responses: DataFrame) -> DataFrame:
    """Primary rates: an array of (date, base, quote, rate)."""
    rows = responses.where(answered()).select("received_at_utc", F.explode(F.from_json(body_text(), "array<struct<date:string,base:string,quote:string,rate:double>>")).alias("r"))
    return rows.where(S.positive("r.rate").isNotNull()).select(F.upper("r.quote").alias("currency"), F.col("r.rate").alias("units_per_usd"), S.reciprocal("r.rate").alias("fx_usd_per_unit"), S.iso_date("r.date").alias("fx_rate_date"), F.lit("frankfurter").alias("fx_source"), F.col("received_at_utc").alias("fx_fetched_at_utc"))


def dated_rates(responses: DataFrame) -> DataFrame:
    """Fallback rates: a date and a map of lower-case currencies."""
    body = F.from_json(body_text(), "struct<date:string,usd:map<string,double>>")
    rows = responses.where(answered()).select("received_at_utc", body.alias("b")).select("received_at_utc", "b.date", F.explode("b.usd").alias("c", "rate"))
    newest = rows.where(S.positive("rate").isNotNull()).groupBy(F.upper("c").alias("currency")).agg(F.max_by(F.struct("rate", "date", "received_at_utc"), "date").alias("r"))
    return newest.select("currency", F.col("r.rate").alias("units_per_usd"), S.reciprocal("r.rate").alias("fx_usd_per_unit"), S.iso_date("r.date").alias("fx_rate_date"), F.lit("fawaz").alias("fx_source"), F.col("r.received_at_utc").alias("fx_fetched_at_utc"))


def _raw(df: DataFrame) -> DataFrame:
    """The columns of a raw station; those a feed lacks are null."""
    from pyspark.sql.types import StructType

    from ..operators.normalize import RAW_STATION

    return df.select([(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(RAW_STATION)])


#: Parsers of the feeds that need nothing but their responses (and their roster); ``us_feed`` and ``ca_feed`` need more.
PARSERS = {f"{c}-COSTCO": (lambda responses, c=c: occ_stations(responses, c)) for c in ("AU", "GB", "JP", "MX", "TW")} | {"US-SAMS": sams_stations}


def feeds_for(countries: list[str] | None = None) -> list[str]:
    every = [*PARSERS, "US-COSTCO", "CA-COSTCO"]
    return sorted(f for f in every if countries is None or f.split("-")[0] in countries)
