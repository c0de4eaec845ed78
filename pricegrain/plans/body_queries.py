"""Registered queries on response bodies: the tables are written as the JSON and HTML that feeds send, and parsed.

Every SQL takes the same facts from the tables directly, so that a parser must give back what went into the bodies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import fx, grain, sets, stations, status
from ..schemas import FX
from ..sources import feeds
from .queries import CAP, captures, inline, query, read

AT = "2024-03-01 06:00:00"


def responses(df: DataFrame, key: Column, body: Column, code: Column | None = None, error: Column | None = None) -> DataFrame:
    """Rows as stored responses; the body leaves with a byte-order mark, which parsers must pass over."""
    return df.select(key.alias("key"), F.lit("https://feeds.example/x").alias("url"), (code if code is not None else F.lit(200)).alias("status"), (error if error is not None else F.lit(None).cast("string")).alias("error"), F.encode(F.concat(F.lit("\ufeff"), body), "utf-8").alias("body"), F.lit(AT).cast("timestamp").alias("received_at_utc"))


def joined(items: Column, order: Column) -> Column:
    """The items of a group as the inside of a JSON list or object, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("x")))), lambda s: s["x"]), ",")


def quoted(c) -> Column:
    return F.concat(F.lit('"'), S.col(c).cast("string"), F.lit('"'))


def price_responses(spark, sf_dir) -> DataFrame:
    """Ten customers a batch; every seventh batch is an error object, every sixth customer has no price."""
    c = read(spark, sf_dir, "customer")
    own = F.when(F.col("c_custkey") % 6 == 0, "{}").otherwise(F.format_string('{"warehouseid":"%d","regular":"%.2f","premium":null,"OID":"1","diesel":"%.3f"}', F.col("c_custkey"), F.col("c_acctbal"), F.col("c_acctbal")))
    batch = F.floor(F.col("c_custkey") / 10)
    made = c.groupBy(batch.alias("batch")).agg(joined(F.concat(quoted("c_custkey"), F.lit(":"), own), F.col("c_custkey")).alias("inside"))
    body = F.when(F.col("batch") % 7 == 3, '{"errorMessage":"no"}').otherwise(F.concat(F.lit("{"), F.col("inside"), F.lit("}")))
    return responses(made, F.format_string("prices-%08d", "batch"), body)


_PRICED = "c_custkey % 6 <> 0 AND (c_custkey // 10) % 7 <> 3"


@query(f"""SELECT c_custkey::varchar AS source_station_id, unnest(['diesel', 'regular']) AS grade_raw, unnest([printf('%.3f', c_acctbal), printf('%.2f', c_acctbal)]) AS price_raw FROM customer WHERE {_PRICED}""")
def body_price_batches(spark, sf_dir):
    found, _ = feeds.price_batches(price_responses(spark, sf_dir))
    return found.select("source_station_id", F.explode("grades").alias("grade_raw", "price_raw"))


@query("SELECT DISTINCT printf('prices-%08d', c_custkey // 10) AS key FROM customer WHERE (c_custkey // 10) % 7 = 3")
def body_failed_batches(spark, sf_dir):
    return feeds.price_batches(price_responses(spark, sf_dir))[1]


def lookup_responses(spark, sf_dir) -> DataFrame:
    """Suppliers of a nation in one lookup body, after the ``false`` that it starts with."""
    s, k = read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (k % 4000).cast("int"))
    shown = F.when(k % 3 == 0, F.upper(F.date_format(day, "MMM dd, yyyy"))).when(k % 3 == 1, F.date_format(day, "MMMM d yyyy")).otherwise(F.date_format(day, "MMM. dd, yyyy"))
    own = F.concat(
        F.lit('{"stlocID":'), k.cast("string"), F.lit(',"locationName":"  '), F.col("s_name"), F.lit(' ","address1":"","city":"C'), (k % 9).cast("string"), F.lit('","state":"S'), F.col("s_nationkey").cast("string"),
        F.lit('","latitude":'), (k % 90).cast("string"), F.lit('.5,"longitude":-1.25,"openDate":"'), shown, F.lit('"'),
        F.when(k % 4 == 0, "").when(k % 4 == 1, ',"gasStationHours":[]').otherwise(',"gasStationHours":[{"a":1}]'),
        F.lit(',"gasPrices":{"regular":"'), F.format_string("%.2f", "s_acctbal"), F.lit('","nested":{"a":"b"},"flag":true}}'),
    )
    made = s.groupBy("s_nationkey").agg(joined(own, k).alias("inside"))
    return responses(made, F.concat(F.lit("lookup-"), F.col("s_nationkey").cast("string")), F.concat(F.lit("[false,"), F.col("inside"), F.lit("]")))


@query("""SELECT s_suppkey::varchar AS source_station_id, s_name AS name, NULL::varchar AS address, 'C' || s_suppkey % 9 AS city, 'S' || s_nationkey AS region, (s_suppkey % 90)::double + 0.5 AS lat,
  DATE '1995-01-01' + (s_suppkey % 4000)::int AS opening_date, CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_suppkey % 4 > 1 END AS has_hours, 'regular=' || printf('%.2f', s_acctbal) AS prices FROM supplier""")
def body_lookup(spark, sf_dir):
    out = feeds.lookup(lookup_responses(spark, sf_dir))
    return out.select("source_station_id", "name", "address", "city", "region", "lat", "opening_date", "has_hours", F.array_join(F.transform("prices", lambda p: F.concat(p["grade_raw"], F.lit("="), p["price_raw"])), ",").alias("prices"))


def locator_responses(spark, sf_dir) -> DataFrame:
    """Customers of a nation in one locator body, in either of its two shapes."""
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    dated = F.when(k % 4 == 0, '{"code":" gas ","openingDate":"2001-02-03T00:00:00"}').when(k % 4 == 1, '{"code":"gas"},{"code":"tyres","openingDate":"2000-01-01"}').otherwise('{"code":"tyres"}')
    own = F.concat(
        F.when(F.col("c_nationkey") % 2 == 0, '{"salesLocationId":"').otherwise('{"warehouseId":"'), k.cast("string"), F.lit('","name":['), F.when(k % 5 != 0, F.concat(F.lit('{"value":"'), F.col("c_name"), F.lit('"}'))).otherwise(""),
        F.lit('],"subType":{"code":"'), F.when(k % 10 == 3, "standaloneGas").otherwise("x"), F.lit('"},"address":{"city":" T'), (k % 7).cast("string"), F.lit('","territory":"R'), (k % 3).cast("string"), F.lit('","countryName":"'),
        F.when(k % 3 == 0, "CA").otherwise("US"), F.lit('","latitude":1.5},"timeZone":"America/Denver","openingDate":"1999-12-31T08:00:00","services":['), dated, F.lit("]}"),
    )
    made = c.groupBy("c_nationkey").agg(joined(own, k).alias("inside"))
    shape = F.when(F.col("c_nationkey") % 2 == 0, "salesLocations").otherwise("warehouses")
    return responses(made, F.concat(F.lit("locator-"), F.col("c_nationkey").cast("string")), F.concat(F.lit('{"'), shape, F.lit('":['), F.col("inside"), F.lit("]}")))


#: What the locator bodies say of a customer.
_PLACES = """places AS (SELECT c_custkey::varchar AS id, CASE WHEN c_custkey % 3 = 0 THEN 'CA' ELSE 'US' END AS country, CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE c_custkey::varchar END AS name, 'T' || c_custkey % 7 AS city, 'R' || c_custkey % 3 AS region,
  CASE WHEN c_custkey % 4 = 0 THEN DATE '2001-02-03' ELSE DATE '1999-12-31' END AS opening_date, c_custkey % 4 < 2 OR c_custkey % 10 = 3 AS has_gas FROM customer)"""


@query(f"WITH {_PLACES} SELECT * FROM places")
def body_locator(spark, sf_dir):
    return feeds.locator(locator_responses(spark, sf_dir)).select("id", "country", "name", "city", "region", "opening_date", "has_gas")


@query(f"""WITH {_PLACES}, polled AS (SELECT c_custkey AS k, c_custkey::varchar AS id FROM customer),
  prev AS (SELECT c_custkey::varchar AS id, 'old ' || c_custkey AS name, 'old' AS city FROM customer WHERE c_custkey % 2 = 0),
  extra AS (SELECT c_custkey::varchar AS id, 'extra ' || c_custkey AS name FROM customer WHERE c_custkey % 11 = 0)
  SELECT p.id AS source_station_id, CASE WHEN k % 11 = 0 THEN 'extra' ELSE 'seen' END AS id_origin,
    coalesce(CASE WHEN l.country = 'US' AND l.has_gas THEN l.name END, extra.name, CASE WHEN l.country = 'US' AND NOT l.has_gas THEN l.name END, prev.name, p.id) AS name,
    coalesce(CASE WHEN l.country = 'US' THEN l.city END, prev.city) AS city, CASE WHEN l.country = 'US' AND k % 11 <> 0 THEN l.opening_date END AS opening_date, CASE WHEN k % 6 <> 0 AND (k // 10) % 7 <> 3 THEN 2 END::int AS n_prices
  FROM polled p LEFT JOIN places l USING (id) LEFT JOIN prev USING (id) LEFT JOIN extra USING (id)""")
def body_us_stations(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("source_station_id", F.col("c_custkey").cast("string"))
    polled = c.select("source_station_id", F.when(F.col("c_custkey") % 11 == 0, "extra").otherwise("seen").alias("id_origin"), F.lit("gas").alias("ecom_state"))
    previous = c.where("c_custkey % 2 = 0").select("source_station_id", F.concat(F.lit("old "), "source_station_id").alias("name"), F.lit("old").alias("city"))
    extras = c.where("c_custkey % 11 = 0").select("source_station_id", F.concat(F.lit("extra "), "source_station_id").alias("name"))
    out = feeds.us_stations(polled, feeds.price_batches(price_responses(spark, sf_dir))[0], feeds.locator(locator_responses(spark, sf_dir)), extras, previous)
    return out.select("source_station_id", "id_origin", "name", "city", "opening_date", F.when(F.col("prices").isNotNull(), F.size("prices")).alias("n_prices"))


@query("""SELECT s_suppkey::varchar AS source_station_id, CASE WHEN s_suppkey % 2 = 0 THEN 48.5 ELSE (s_suppkey % 90)::double + 0.5 END AS lat, CASE WHEN s_suppkey % 2 = 0 THEN 'America/Toronto' WHEN s_suppkey % 3 = 0 THEN 'America/Halifax' END AS timezone,
  CASE WHEN s_suppkey % 4 = 0 THEN DATE '2020-05-05' ELSE DATE '1995-01-01' + (s_suppkey % 4000)::int END AS opening_date FROM supplier""")
def body_ca_stations(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").withColumn("id", F.col("s_suppkey").cast("string"))
    places = s.where("s_suppkey % 2 = 0").select("id", F.lit(48.5).alias("lat"), F.lit(-80.0).alias("lon"), F.lit("America/Toronto").alias("timezone"), F.when(F.col("s_suppkey") % 4 == 0, F.lit("2020-05-05").cast("date")).alias("opening_date"))
    cached = s.where("s_suppkey % 3 = 0").select(F.col("id").alias("source_station_id"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.lit("America/Halifax").alias("timezone"))
    return feeds.ca_stations(feeds.lookup(lookup_responses(spark, sf_dir)), places, cached).select("source_station_id", "lat", "timezone", "opening_date")


@query(f"""SELECT 'station' AS kind, c_custkey::varchar AS said FROM customer WHERE {_PRICED} AND c_custkey % 3 = 0
  UNION ALL SELECT 'no_metadata', c_custkey::varchar FROM customer WHERE {_PRICED} AND c_custkey % 3 <> 0 UNION ALL SELECT 'fallback_used', '' UNION ALL SELECT 'metadata_from_cache', ''""")
def body_ca_fallback(spark, sf_dir):
    fields = ("alt_id", "name", "name_local", "address", "city", "region", "postcode", "timezone")
    cached = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("source_station_id"), *[F.lit("x").alias(c) for c in fields], F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"))
    out = feeds.ca_fallback(feeds.price_batches(price_responses(spark, sf_dir))[0], cached)
    return out.stations.select(F.lit("station").alias("kind"), F.col("source_station_id").alias("said")).union(out.warnings)


#: What a store list says of a supplier, by country: town and lines of its address.
_AU_TOWN = ("Crossroads NSW", "North  Lakes", "perth wa")
_JP_LINE = ("東京都港区赤坂", "北海道札幌市中央区", "千葉県千葉市美浜区")
_TW_LINE = ("114 台北市內湖區舊宗路", "80652高雄市前鎮區")


def store_responses(spark, sf_dir, country: str) -> DataFrame:
    """Suppliers as stores of a paged list, twenty a page; every fifth sells no fuel."""
    s, k = read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    pick = lambda texts: F.element_at(F.array(*map(F.lit, texts)), (k % len(texts) + 1).cast("int"))
    address = {
        "AU": F.concat(F.lit('"town":"'), pick(_AU_TOWN), F.lit('","formattedAddress":"1 Road","postalCode":"'), F.format_string("%04d", 2000 + k % 6000), F.lit('"')),
        "JP": F.concat(F.lit('"line1":"L","line2":"'), pick(_JP_LINE), F.lit('"')),
        "TW": F.concat(F.lit('"postalCode":"9","formattedAddress":"'), pick(_TW_LINE), F.lit('"')),
        "GB": F.lit('"line1":"1 Street","postalCode":"AB1"'),
        "MX": F.lit('"town":" Leon ","region":{"isocode":"MX-GUA"}'),
    }[country]
    fuel = F.when(k % 5 == 0, "").otherwise(F.format_string('{"name":" E10 ","price":"%.2f"},{"name":"","price":"1"}', F.col("s_acctbal")))
    code = F.when(k % 7 == 0, F.lit("none")).otherwise(F.concat(F.lit("W_"), k.cast("string")))
    own = F.concat(F.lit('{"name":"'), F.col("s_name"), F.lit('","displayName":"D'), k.cast("string"), F.lit('","warehouseCode":"'), code, F.lit('","gasTypes":['), fuel, F.lit('],"geoPoint":{"latitude":1.5,"longitude":2.5},"address":{'), address, F.lit("}}"))
    page = F.floor((k - 1) / 20)
    made = s.groupBy(page.alias("page")).agg(joined(own, k).alias("inside")).withColumn("pages", F.lit(s.agg(F.max(page)).first()[0] + 1))
    body = F.concat(F.lit('{"pagination":{"currentPage":'), F.col("page").cast("string"), F.lit(',"totalPages":'), F.col("pages").cast("string"), F.lit('},"stores":['), F.col("inside"), F.lit("]}"))
    return responses(made, F.format_string("stores-%06d", "page"), body)


_NUMBERED = "CASE WHEN country IN ('AU', 'MX', 'TW') AND k % 7 <> 0 THEN k::varchar ELSE s_name END"


@query(f"""WITH s AS (SELECT s_suppkey AS k, * FROM supplier WHERE s_suppkey % 5 <> 0), c AS (SELECT *, unnest(['AU', 'GB', 'JP', 'MX', 'TW']) AS country FROM s),
  t AS (SELECT *, (2000 + k % 6000)::int AS post, k % 3 AS m FROM c)
  SELECT country, {_NUMBERED} AS source_station_id, CASE country WHEN 'AU' THEN CASE m WHEN 0 THEN 'Crossroads' WHEN 1 THEN 'North Lakes' ELSE 'perth' END WHEN 'JP' THEN CASE m WHEN 0 THEN '港区' WHEN 1 THEN '札幌市' ELSE '千葉市' END WHEN 'GB' THEN 'D' || k WHEN 'MX' THEN 'Leon' END AS city,
    CASE country WHEN 'AU' THEN CASE m WHEN 0 THEN 'NSW' WHEN 2 THEN 'WA' ELSE CASE WHEN post BETWEEN 2600 AND 2618 OR post BETWEEN 2900 AND 2920 THEN 'ACT' ELSE CASE post // 1000 WHEN 2 THEN 'NSW' WHEN 3 THEN 'VIC' WHEN 4 THEN 'QLD' WHEN 5 THEN 'SA' WHEN 6 THEN 'WA' WHEN 7 THEN 'TAS' END END END
      WHEN 'JP' THEN CASE m WHEN 0 THEN '東京都' WHEN 1 THEN '北海道' ELSE '千葉県' END WHEN 'TW' THEN CASE k % 2 WHEN 0 THEN '台北市' ELSE '高雄市' END WHEN 'MX' THEN 'GUA' END AS region,
    'E10=' || printf('%.2f', s_acctbal) AS prices FROM t""")
def body_store_lists(spark, sf_dir):
    out = None
    for country in ("AU", "GB", "JP", "MX", "TW"):
        found = feeds.PARSERS[f"{country}-COSTCO"](store_responses(spark, sf_dir, country)).stations
        out = found if out is None else out.unionByName(found)
    return out.select("country", "source_station_id", "city", "region", F.array_join(F.transform("prices", lambda p: F.concat(p["grade_raw"], F.lit("="), p["price_raw"])), ",").alias("prices"))


@query("SELECT 'missing_warehouse_code' AS code, 'D' || s_suppkey AS detail FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 = 0")
def body_store_warnings(spark, sf_dir):
    return feeds.occ_stations(store_responses(spark, sf_dir, "MX"), "MX").warnings


def club_responses(spark, sf_dir) -> DataFrame:
    """Suppliers as pages of fuel centres: a label may contradict its grade id, a price lie below the regular one; some pages redirect, fail or were not asked for."""
    s, k = read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    regular = 2 + (k % 50) / 100
    entry = lambda name, grade, price: F.concat(F.lit(f'{{"type":"fuel","name":"{name}","gradeId":'), grade, F.lit(',"price":'), F.format_string("%.3f", price), F.lit("}"))
    entries = F.concat(entry("UNLEAD", F.lit("11"), regular), F.lit(","), entry("PREMIUM", F.when(k % 4 == 0, "21").otherwise("16"), F.when(k % 6 == 1, regular - 0.5).otherwise(regular + 0.5)), F.lit(',{"type":"car","name":"X","price":1}'))
    hours = F.when(k % 5 == 0, ',"operationalHours":[{"closed":true},{"closed":true}]').when(k % 5 == 1, ',"operationalHours":[{"closed":true},{}]').when(k % 5 == 2, ',"open24Hours":true').otherwise("")
    name = F.when(k % 9 == 0, "INVALID STORE").otherwise("S")
    data = F.concat(F.lit('{"props":{"pageProps":{"initialTempoData":{"contentLayout":{"modules":[{"configs":{}},{"configs":{"storeFuelPrices":{"storeName":"'), name, F.lit('","prices":['), entries, F.lit(']}}}]}},"initialNodeDetail":{"data":{"nodeDetail":{"displayName":"'), F.col("s_name"), F.lit('","timeZone":{"id":"America/Chicago"}'), hours, F.lit("}}}}}}"))
    body = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script></html>"))
    code = F.when(k % 8 == 3, 302).when(k % 8 == 5, 500).otherwise(200)
    return responses(s.where("s_suppkey % 10 <> 7"), F.concat(F.lit("club-"), k.cast("string")), body, code)


_CLUBS = """clubs AS (SELECT s_suppkey AS k, *, 2 + (s_suppkey % 50) / 100.0 AS regular, s_suppkey % 10 <> 7 AND s_suppkey % 8 NOT IN (3, 5) AND s_suppkey % 9 <> 0 AS usable FROM supplier)"""


@query(f"""WITH {_CLUBS} SELECT k::varchar AS source_station_id, s_name AS name, CASE k % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true END AS has_hours, 'UNLEAD=' || printf('%.3f', regular) || CASE WHEN k % 4 <> 0 AND k % 6 <> 1 THEN ',PREMIUM=' || printf('%.3f', regular + 0.5) ELSE '' END AS prices FROM clubs WHERE usable""")
def body_fuel_centres(spark, sf_dir):
    roster = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("source_station_id"), F.lit("seen").alias("id_origin"))
    out = feeds.sams_stations(club_responses(spark, sf_dir), roster).stations
    return out.select("source_station_id", "name", "has_hours", F.array_join(F.transform("prices", lambda p: F.concat(p["grade_raw"], F.lit("="), p["price_raw"])), ",").alias("prices"))


@query(f"""WITH {_CLUBS} SELECT 'mislabeled_grade' AS code, k || ':PREMIUM=' || printf('%.3f', CASE WHEN k % 6 = 1 THEN regular - 0.5 ELSE regular + 0.5 END) AS detail FROM clubs WHERE usable AND k % 4 = 0
  UNION ALL SELECT 'below_regular', k || ':PREMIUM=' || printf('%.3f', regular - 0.5) FROM clubs WHERE usable AND k % 4 <> 0 AND k % 6 = 1
  UNION ALL SELECT 'not_reached', k::varchar FROM clubs WHERE k % 10 = 7""")
def body_fuel_centre_warnings(spark, sf_dir):
    roster = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("source_station_id"), F.lit("seen").alias("id_origin"))
    return feeds.sams_stations(club_responses(spark, sf_dir), roster).warnings


@query(f"""WITH {_CLUBS} SELECT 500 AS http_status, 'http_error' AS code, count(*)::bigint AS n FROM clubs WHERE k % 10 <> 7 AND k % 8 = 5 HAVING count(*) > 0""")
def body_error_counts(spark, sf_dir):
    roster = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("source_station_id"), F.lit("seen").alias("id_origin"))
    return status.error_counts(feeds.sams_stations(club_responses(spark, sf_dir), roster).errors)


def rate_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Rates of both sources: nations as currencies, the region's dearest customer as the rate. The first lacks every third."""
    c = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.max("c_acctbal").alias("rate"))
    k = F.col("c_nationkey")
    first = c.where("c_nationkey % 3 <> 0").agg(joined(F.concat(F.lit('{"date":"2024-02-29","base":"USD","quote":"c'), k.cast("string"), F.lit('","rate":'), F.when(k % 5 == 0, F.lit("-1")).otherwise(F.format_string("%.2f", "rate")), F.lit("}")), k).alias("inside"))
    second = c.agg(joined(F.concat(F.lit('"c'), k.cast("string"), F.lit('":'), F.format_string("%.1f", "rate")), k).alias("inside"))
    return feeds.frankfurter(responses(first, F.lit("a"), F.concat(F.lit("["), F.col("inside"), F.lit("]")))), feeds.dated_rates(responses(second, F.lit("b"), F.concat(F.lit('{"date":"2024-02-27","usd":{'), F.col("inside"), F.lit("}}"))))


@query("""WITH c AS (SELECT c_nationkey AS k, max(c_acctbal) AS rate FROM customer GROUP BY 1), r AS (SELECT k, k % 3 <> 0 AND k % 5 <> 0 AS first, CASE WHEN k % 3 <> 0 AND k % 5 <> 0 THEN printf('%.2f', rate)::double ELSE printf('%.1f', rate)::double END AS units FROM c)
  SELECT 'C' || k AS currency, units AS units_per_usd, cast(printf('%.9e', 1.0::double / units) AS double) AS fx_usd_per_unit, CASE WHEN first THEN DATE '2024-02-29' ELSE DATE '2024-02-27' END AS fx_rate_date, CASE WHEN first THEN 'frankfurter' ELSE 'fawaz' END AS fx_source FROM r""")
def body_rates(spark, sf_dir):
    out = fx.by_priority([*rate_tables(spark, sf_dir)])
    return out.select("currency", "units_per_usd", S.significant("fx_usd_per_unit").alias("fx_usd_per_unit"), "fx_rate_date", "fx_source")


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y-%mZ') AS capture_id, o_orderpriority AS currency, o_totalprice AS u, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%mZ'), o_orderpriority ORDER BY o_orderkey DESC, o_totalprice DESC) AS n FROM orders)
  SELECT capture_id, currency, cast(printf('%.9e', u * CASE WHEN capture_id >= '1998' THEN 2 ELSE 1 END) AS double) AS units_per_usd FROM o WHERE n = 1""")
def fx_upsert(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM'Z'").alias("capture_id"), F.col("o_orderpriority").alias("currency"), F.struct("o_orderkey", "o_totalprice").alias("at"), F.col("o_totalprice").alias("units_per_usd"))
    o = o.select([F.col(c) if c in ("capture_id", "currency", "units_per_usd") else F.lit(None).cast(FX[c].dataType).alias(c) for c in FX.names] + ["at"])
    built = fx.rebuild(o, "at")
    again = built.where("capture_id >= '1998'").withColumn("units_per_usd", F.col("units_per_usd") * 2)
    return fx.upsert(built, again).select("capture_id", "currency", "units_per_usd")


@query("""SELECT c_custkey, nullif(trim(c_name || ' '), '') AS clean, NULL::varchar AS empty, printf('%.3f', c_acctbal) AS fixed, cast(printf('%.4f', c_acctbal / 3) AS double) AS rounded, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive,
  'MX-COSTCO-X' AS feed, 'MX' AS country, 'COSTCO-X' AS brand, 'QRO' AS stripped, c_custkey::varchar AS club, DATE '2020-01-01' + (c_custkey % 1000)::int AS iso_date FROM customer""")
def scalar_parts(spark, sf_dir):
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    feed = S.feed_id(F.lit("MX"), F.lit("COSTCO-X"))
    url = F.concat(F.lit("https://h/x?a=1&club="), k.cast("string"))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int"))
    return c.select(
        "c_custkey", S.clean(F.concat(F.lit("\u3000 "), F.col("c_name"), F.lit("  "))).alias("clean"), S.clean(F.lit("  ")).alias("empty"), S.fixed3("c_acctbal").alias("fixed"), F.format_string("%.4f", F.col("c_acctbal") / 3).cast("double").alias("rounded"),
        S.positive("c_acctbal").alias("positive"), feed.alias("feed"), S.feed_country(feed).alias("country"), S.feed_brand(feed).alias("brand"), S.strip_prefix(F.lit("MX-QRO"), "MX-").alias("stripped"), S.url_parameter(url, "club").alias("club"),
        S.iso_date(F.concat(day.cast("string"), F.lit("T10:00:00Z"))).alias("iso_date"),
    )


@query(f"WITH {CAP} SELECT capture_id, capture_date, count(*)::bigint AS n_rows FROM rows_ GROUP BY 1, 2")
def capture_counts(spark, sf_dir):
    return grain.counts_by(captures(spark, sf_dir), "capture_id", "capture_date")


@query(f"WITH {CAP} SELECT country || '-' || brand AS feed, max(capture_id) AS newest FROM rows_ WHERE user_id % 4 <> 1 OR price < 20 GROUP BY 1")
def newest_captures(spark, sf_dir):
    c = captures(spark, sf_dir).select(S.feed_id("country", "brand").alias("feed"), "capture_id", F.when((F.col("user_id") % 4 == 1) & (F.col("price") >= 20), "failed").when(F.col("user_id") % 2 == 0, "ok").otherwise("degraded").alias("status"))
    return stations.newest_by_feed(c)


@query("""SELECT event_type AS feed, round((max(epoch_us(ts)) - min(epoch_us(ts) - (user_id % 100) * 1000000)) / 1e6, 1) AS duration_s FROM events GROUP BY 1""")
def response_span(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), F.col("ts").cast("timestamp").alias("received_at_utc"), ((F.col("user_id") % 100) * 1000).alias("elapsed_ms"))
    return status.duration(e, "feed")


@query("SELECT DISTINCT user_id::varchar AS source_station_id, event_type AS hold_reason FROM events WHERE value > 50")
def held_stations(spark, sf_dir):
    return status.held_reasons(read(spark, sf_dir, "events").where("value > 50").select(F.col("user_id").cast("string").alias("source_station_id"), F.col("event_type").alias("hold_reason")))


@query("""SELECT o_orderkey, regular, premium FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 3.999 ELSE (o_totalprice % 700) / 100 END AS regular, CASE WHEN o_orderkey % 10 = 0 THEN 5.999 END AS premium FROM orders) WHERE regular BETWEEN 1.0 AND 5.0 AND NOT coalesce(regular = 3.999 AND premium = 5.999, false)""")
def reportable_prices(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    regular = F.when(F.col("o_orderkey") % 5 == 0, F.lit(3.999)).otherwise(F.col("o_totalprice") % 700 / 100)
    return sets.reportable(o.select("o_orderkey", regular.alias("regular"), F.when(F.col("o_orderkey") % 10 == 0, F.lit(5.999)).alias("premium")), 1.0, 5.0)


@query("SELECT c_custkey::varchar AS source_station_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 5 = 0) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def unreached_ids(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("source_station_id", F.col("o_custkey").cast("string"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("source_station_id"))
    return sets.minus(c, o.where("o_orderstatus = 'O' AND o_orderkey % 5 = 0"), o.where("o_totalprice > 450000"))


@query(f"""WITH {CAP}, f AS (SELECT country || '-' || brand AS feed, count(*)::bigint AS "rows", count(DISTINCT station_key)::bigint AS stations FROM rows_ WHERE country <> 'GB' GROUP BY 1),
  o AS (SELECT country || '-' || brand AS feed, count(*) AS outside FROM rows_ WHERE price > 100 GROUP BY 1), r AS (SELECT unnest(['US-COSTCO', 'CA-COSTCO', 'AU-COSTCO', 'GB-COSTCO', 'US-SAMS', 'JP-COSTCO']) AS feed)
  SELECT r.feed, CASE WHEN r.feed = 'JP-COSTCO' THEN 'skipped' WHEN coalesce("rows", 0) = 0 THEN 'failed' WHEN stations < CASE r.feed WHEN 'US-COSTCO' THEN 585 WHEN 'US-SAMS' THEN 460 WHEN 'CA-COSTCO' THEN 78 WHEN 'AU-COSTCO' THEN 14 ELSE 21 END OR r.feed = 'CA-COSTCO' OR coalesce(outside, 0) / ("rows" + coalesce(outside, 0)) > 0.05 THEN 'degraded' ELSE 'ok' END AS status,
    coalesce("rows", 0) AS "rows", coalesce(stations, 0) AS stations, CASE WHEN r.feed = 'JP-COSTCO' THEN 2 WHEN coalesce("rows", 0) = 0 THEN 3 ELSE 0 END::int AS consecutive_failures,
    CASE WHEN coalesce("rows", 0) = 0 THEN NULL ELSE '2024-02-01T0600Z' END AS last_success_capture_id FROM r LEFT JOIN f USING (feed) LEFT JOIN o USING (feed)""")
def feed_verdicts(spark, sf_dir):
    c = captures(spark, sf_dir).withColumn("source", F.lit("list"))
    names = ("US-COSTCO", "CA-COSTCO", "AU-COSTCO", "GB-COSTCO", "US-SAMS", "JP-COSTCO")
    ran = inline(spark, [(f, f != "JP-COSTCO") for f in names], "feed string, ran boolean")
    before = inline(spark, [(f, None, None, 2, None, None) for f in names], "feed string, price_fingerprint string, unchanged_since_capture_id string, consecutive_failures int, last_success_capture_id string, recent_errors array<string>")
    drops = c.where("price > 100").select(S.feed_id("country", "brand").alias("feed"), F.lit("out_of_bounds").alias("reason"))
    warned = inline(spark, [("CA-COSTCO", "unknown_grade"), ("AU-COSTCO", "no_regular")], "feed string, code string")
    out = status.evaluate(ran, c.where("country <> 'GB'"), drops, warned, before, "2024-02-01T0600Z", "2024-02-01 06:00:00")
    return out.select("feed", "status", "rows", "stations", "consecutive_failures", "last_success_capture_id")


@query("""SELECT l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 4 = 1 THEN l_orderkey % 7 <> 0 WHEN l_linenumber % 4 = 2 THEN true ELSE l_orderkey % 7 <> 0 END AS open_, l_linenumber FROM lineitem""")
def open_days(spark, sf_dir):
    li, k, n = read(spark, sf_dir, "lineitem"), F.col("l_orderkey"), F.col("l_linenumber")
    day = lambda shut: F.struct(shut.alias("closed"))
    days = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 2, F.lit(None)).otherwise(F.array(day(F.lit(True)), day(F.when(k % 7 == 0, F.lit(True)).when(k % 7 == 1, F.lit(False)))))
    entry = F.struct(F.when(n % 4 == 2, F.lit(True)).alias("open24Hours"), days.alias("operationalHours"))
    return li.select("l_orderkey", feeds.open_some_day(entry).alias("open_"), "l_linenumber")
