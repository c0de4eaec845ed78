"""Registered queries: every relational operator on the driver's tables, beside the DuckDB SQL it must equal.

``events`` plays the price feed: a user is a station, an event type a posted label, a six-hour slot a
capture. Rates, units, priorities and grades are small inline tables. Instants leave as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S
from ..operators import fx, grain, normalize, sets, stations, status, summary, validate
from ..operators.constants import LITRES_PER_US_GALLON
from ..schemas import STATION, empty
from ..sources import feeds

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}

#: Inline dimensions: label -> (grade, priority), country -> (unit, currency, units per dollar or none).
GRADE = {"purchase": ("regular", 2), "click": ("regular", 1), "view": ("premium", 1), "signup": ("diesel", 1), "error": ("other", 0)}
COUNTRY = ("US", "CA", "AU", "GB")
UNIT = {"US": "USD/gal", "CA": "CAD/L", "AU": "AUD/L", "GB": "GBp/L"}
RATE = {"CAD": 1.36, "AUD": 1.52}

_grade = " ".join(f"WHEN '{k}' THEN '{g}'" for k, (g, _) in GRADE.items())
_unit = " ".join(f"WHEN '{k}' THEN '{u}'" for k, u in UNIT.items())
#: The events as captures, in SQL; ``captures`` is the same as a DataFrame.
CAP = f"""base AS (SELECT event_id, ts, user_id, event_type AS grade_raw, value AS price, ts::date AS capture_date,
    strftime(date_trunc('hour', ts) - to_hours(hour(ts) % 6), '%Y-%m-%dT%H%MZ') AS capture_id,
    ['US', 'CA', 'AU', 'GB'][user_id % 4 + 1] AS country, CASE WHEN user_id % 8 = 0 THEN 'SAMS' ELSE 'COSTCO' END AS brand,
    CASE WHEN user_id % 5 <> 0 THEN 'R' || (user_id % 3) END AS region, CASE event_type {_grade} END AS grade FROM events),
cap AS (SELECT *, country || '-' || brand || '-' || user_id AS station_key, CASE country {_unit} END AS price_unit,
    CASE country WHEN 'US' THEN price / {LITRES_PER_US_GALLON!r}::double WHEN 'GB' THEN price / 100.0::double ELSE price END AS price_local_per_litre,
    CASE country WHEN 'US' THEN 1.0::double WHEN 'CA' THEN 1.0::double / 1.36::double WHEN 'AU' THEN 1.0::double / 1.52::double END AS rate FROM base),
rows_ AS (SELECT *, price_local_per_litre * rate AS price_usd_per_litre FROM cap)"""
#: Daily grain of the captures, and one row per station, grade and day.
DAY = f"""{CAP},
daily AS (SELECT capture_date, station_key, grade_raw, arg_max(r, (ts, event_id)) AS r, count(DISTINCT capture_id) AS n_captures, min(price) AS price_min, max(price) AS price_max
  FROM (SELECT *, rows_ AS r FROM rows_) GROUP BY 1, 2, 3),
deduped AS (SELECT * FROM (SELECT capture_date, station_key, grade_raw, r.country AS country, r.brand AS brand, r.region AS region, r.grade AS grade, r.ts AS ts,
    r.price_local_per_litre AS price_local_per_litre, r.price_usd_per_litre AS price_usd_per_litre, r.price_unit AS price_unit, n_captures, price_min, price_max,
    row_number() OVER (PARTITION BY capture_date, station_key, r.grade ORDER BY r.ts DESC, CASE grade_raw WHEN 'purchase' THEN 2 ELSE 1 END DESC, grade_raw) AS n FROM daily WHERE r.grade <> 'other') WHERE n = 1)"""


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c, to: str | None = None):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(to or c)


def texts(*cs: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in cs)


def inline(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def priorities(spark: SparkSession) -> DataFrame:
    return inline(spark, [(c, b, k, g, p) for c in COUNTRY for b in ("COSTCO", "SAMS") for k, (g, p) in GRADE.items() if g != "other"], "country string, brand string, grade_raw string, grade string, priority bigint")


def rates(spark: SparkSession) -> DataFrame:
    return inline(spark, [(c, 1.0 / u, None, "inline", None) for c, u in RATE.items()], "currency string, fx_usd_per_unit double, fx_rate_date date, fx_source string, fx_fetched_at_utc timestamp")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as price rows with rates applied."""
    e = read(spark, sf_dir, "events")
    ts, user = F.col("ts").cast("timestamp"), F.col("user_id")
    grade = F.create_map(*[F.lit(x) for k, (g, _) in GRADE.items() for x in (k, g)])
    unit = F.create_map(*[F.lit(x) for kv in UNIT.items() for x in kv])
    e = e.select(
        "event_id",
        "user_id",
        S.capture_id(F.date_trunc("hour", ts) - F.make_interval(hours=F.hour(ts) % 6)).alias("capture_id"),
        F.to_date(ts).alias("capture_date"),
        ts.alias("captured_at_utc"),
        F.element_at(F.array(*map(F.lit, COUNTRY)), (user % 4 + 1).cast("int")).alias("country"),
        F.when(user % 8 == 0, "SAMS").otherwise("COSTCO").alias("brand"),
        F.when(user % 5 != 0, F.concat(F.lit("R"), (user % 3).cast("string"))).alias("region"),
        F.col("event_type").alias("grade_raw"),
        grade[F.col("event_type")].alias("grade"),
        F.col("value").cast("string").alias("price_raw"),
        F.col("value").alias("price"),
    )
    e = e.withColumn("station_key", S.station_key("country", "brand", F.col("user_id").cast("string"))).withColumn("price_unit", unit[F.col("country")])
    return fx.apply(e, rates(spark))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.daily_grain(captures(spark, sf_dir), order=("captured_at_utc", "event_id"))


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.dedupe_daily(daily(spark, sf_dir), priorities(spark))


@query("""SELECT ts::date AS capture_date, user_id, event_type AS grade_raw, arg_max(value, (ts, event_id)) AS price, arg_max(event_id, (ts, event_id)) AS event_id,
  count(DISTINCT event_id)::bigint AS n_captures, min(value) AS price_min, max(value) AS price_max FROM events GROUP BY 1, 2, 3""")
def daily_grain(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("capture_date"), "user_id", F.col("event_type").alias("grade_raw"), F.col("value").alias("price"), "event_id", F.col("event_id").alias("capture_id"), F.col("ts").alias("captured_at_utc"))
    out = grain.daily_grain(e, key=("capture_date", "user_id", "grade_raw"))
    return out.select("capture_date", "user_id", "grade_raw", "price", "event_id", "n_captures", "price_min", "price_max")


@query(f"""WITH {CAP} SELECT capture_id, station_key, grade_raw, arg_max(price, (ts, event_id)) AS price, count(DISTINCT event_id)::bigint AS n_readings FROM rows_ GROUP BY 1, 2, 3""")
def daily_grain_by_capture_slot(spark, sf_dir):
    c = captures(spark, sf_dir)
    return c.groupBy("capture_id", "station_key", "grade_raw").agg(F.max_by("price", F.struct("captured_at_utc", "event_id")).alias("price"), F.count_distinct("event_id").alias("n_readings"))


@query(f"WITH {DAY} SELECT capture_date, station_key, grade, grade_raw, {texts('ts')}, n_captures::bigint AS n_captures, price_min, price_max FROM deduped")
def dedupe_daily(spark, sf_dir):
    d = deduped(spark, sf_dir)
    return d.select("capture_date", "station_key", "grade", "grade_raw", text("captured_at_utc", "ts"), "n_captures", "price_min", "price_max")


def _summary_sql(keys: str, region: str, level: str, where: str = "") -> str:
    stats = ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {name}_{kind}_per_litre" for c, kind in (("price_local_per_litre", "local"), ("price_usd_per_litre", "usd")) for name, q in (("median", 0.5), ("p25", 0.25), ("p75", 0.75)))
    return f"SELECT {keys}, '{level}' AS level, {region} AS region, grade, count(DISTINCT station_key)::int AS n_stations, count(price_usd_per_litre)::int AS n_stations_usd, {stats} FROM deduped {where} GROUP BY {keys}, grade{', region' if region == 'region' else ''}"


@query(f"WITH {DAY} {_summary_sql('capture_date, country, brand', 'NULL::varchar', 'country')} UNION ALL {_summary_sql('capture_date, country, brand', 'region', 'region', 'WHERE region IS NOT NULL')}")
def summary_daily(spark, sf_dir):
    out = summary.summary_daily(deduped(spark, sf_dir))
    return out.select([F.round(c, 6).alias(c) if c.endswith("_per_litre") else F.col(c) for c in out.columns])


@query("""WITH o AS (SELECT o_orderdate::date AS capture_date, n_name AS country, c_mktsegment AS brand, CASE WHEN n_nationkey % 5 <> 0 THEN r_name END AS region, o_orderpriority AS grade, c_custkey, o_totalprice AS v
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  SELECT country, region, brand, grade, count(DISTINCT c_custkey)::int AS n_stations, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.75), 6) AS p75
  FROM o GROUP BY ALL""")
def summary_country_region(spark, sf_dir):
    t = lambda name: read(spark, sf_dir, name)
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.select(F.col("n_name").alias("country"), F.when(F.col("n_nationkey") % 5 != 0, F.col("r_name")).alias("region"), F.col("c_mktsegment").alias("brand"), F.col("o_orderpriority").alias("grade"), "c_custkey", "o_totalprice")
    q = F.percentile("o_totalprice", F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)))
    out = o.groupBy("country", "region", "brand", "grade").agg(F.count_distinct("c_custkey").cast("int").alias("n_stations"), q.alias("q"))
    return out.select("country", "region", "brand", "grade", "n_stations", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("median", "p25", "p75"))])


_FLAGS = f"""{DAY}, flagged AS (SELECT *, lag(price_local_per_litre) OVER (PARTITION BY station_key, grade ORDER BY capture_date) AS before FROM deduped)"""


@query(f"WITH {_FLAGS} SELECT capture_date, station_key, grade, abs(price_local_per_litre - before) > 5e-5 AS changed, abs(price_max - price_min) > 5e-5 AS moved_intraday FROM flagged")
def change_flags(spark, sf_dir):
    return summary.change_flags(deduped(spark, sf_dir)).select("capture_date", "station_key", "grade", "changed", "moved_intraday")


@query(f"""WITH {_FLAGS} SELECT capture_date, station_key, brand, grade, price_local_per_litre, price_usd_per_litre,
  CASE country WHEN 'US' THEN 'USD' WHEN 'CA' THEN 'CAD' WHEN 'AU' THEN 'AUD' ELSE 'GBP' END AS currency, n_captures::bigint AS n_captures,
  abs(price_local_per_litre - before) > 5e-5 AS changed, abs(price_max - price_min) > 5e-5 AS moved_intraday FROM flagged""")
def history(spark, sf_dir):
    return summary.history(deduped(spark, sf_dir))


_LATEST = """latest AS (SELECT * FROM (SELECT *, max(ts) OVER (PARTITION BY station_key) AS newest, row_number() OVER (PARTITION BY station_key, grade_raw, ts ORDER BY capture_id DESC) AS n FROM rows_) WHERE ts = newest AND n = 1)"""


@query(f"WITH {CAP}, {_LATEST} SELECT station_key, country, grade_raw, capture_id, price, {texts('ts')} FROM latest")
def latest_snapshot(spark, sf_dir):
    return grain.latest_rows(captures(spark, sf_dir)).select("station_key", "country", "grade_raw", "capture_id", "price", text("captured_at_utc", "ts"))


_SPLIT = "DATE '2024-01-16'"


@query(f"""WITH {CAP}, halves AS (SELECT *, capture_date >= {_SPLIT} AS late FROM rows_),
  marked AS (SELECT *, max(ts) OVER (PARTITION BY station_key, late) AS newest FROM halves), old AS (SELECT * FROM marked WHERE NOT late AND ts = newest), new AS (SELECT * FROM marked WHERE late AND ts = newest),
  best AS (SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.station_key = old.station_key) UNION ALL SELECT * FROM new)
  SELECT station_key, grade_raw, price, {texts('ts')} FROM best""")
def latest_incremental(spark, sf_dir):
    c = captures(spark, sf_dir)
    late = F.col("capture_date") >= F.lit("2024-01-16").cast("date")
    out = grain.update_latest(grain.latest_rows(c.where(~late)), grain.latest_rows(c.where(late)))
    return out.select("station_key", "grade_raw", "price", text("captured_at_utc", "ts"))


@query(f"""WITH {DAY}, located AS (SELECT * FROM (SELECT *, max(capture_date) OVER (PARTITION BY station_key) AS newest FROM deduped) WHERE capture_date = newest AND split_part(station_key, '-', 3)::bigint % 9 <> 0)
  SELECT station_key, any_value(country) AS country, string_agg(grade || '=' || grade_raw || ':' || n_captures, ',' ORDER BY grade) AS grades, count(*)::int AS n_grades FROM located GROUP BY station_key""")
def latest_nested(spark, sf_dir):
    d = deduped(spark, sf_dir)
    newest = d.withColumn("newest", F.max("capture_date").over(Window.partitionBy("station_key"))).where("capture_date = newest").drop("newest")
    place = F.when(F.substring_index("station_key", "-", -1).cast("long") % 9 != 0, F.lit(1.0))  # every ninth has no coordinates
    rows = newest.withColumn("lat", place).withColumn("lon", place)
    seen = rows.groupBy("station_key").agg(F.lit("active").alias("status"), F.min("captured_at_utc").alias("first_seen_utc"))
    out = summary.latest_nested(rows, seen)
    entries = F.array_sort(F.transform(F.map_entries("grades"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["grade_raw"], F.lit(":"), e["value"]["n_captures"].cast("string"))))
    return out.select("station_key", "country", F.array_join(entries, ",").alias("grades"), F.size("grades").alias("n_grades"))


@query(f"WITH {CAP} SELECT station_key, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen_utc, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen_utc, string_agg(DISTINCT grade_raw, '|' ORDER BY grade_raw) AS grades_seen FROM rows_ GROUP BY 1")
def station_seen(spark, sf_dir):
    return stations.station_seen(captures(spark, sf_dir)).select("station_key", text("first_seen_utc"), text("last_seen_utc"), "grades_seen")


def _stations(c: DataFrame, keep) -> DataFrame:
    """Station records of the captures for which ``keep`` holds."""
    own = c.where(keep)
    base = stations.station_seen(own).join(own.groupBy("station_key").agg(F.max_by(F.struct("country", "brand", "region", F.col("user_id").cast("string").alias("source_station_id")), F.struct("captured_at_utc", "event_id")).alias("r")), "station_key")
    made = {"country": F.col("r.country"), "brand": F.col("r.brand"), "region": F.col("r.region"), "source_station_id": F.col("r.source_station_id"), "status": F.lit("active")}
    return base.select([(made[f.name] if f.name in made else F.col(f.name) if f.name in base.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STATION])


#: The second half of the stations' feeds, as one capture that lists the even users alone.
_UPSERT = f"""{CAP}, o AS (SELECT station_key, any_value(country) AS country, any_value(brand) AS brand, min(ts) AS f, max(ts) AS l, string_agg(DISTINCT grade_raw, '|' ORDER BY grade_raw) AS g FROM rows_ WHERE capture_date < {_SPLIT} AND user_id % 10 <> 0 GROUP BY 1),
  n AS (SELECT station_key, any_value(country) AS country, any_value(brand) AS brand, min(ts) AS f, max(ts) AS l, string_agg(DISTINCT grade_raw, '|' ORDER BY grade_raw) AS g FROM rows_ WHERE capture_date >= {_SPLIT} AND user_id % 4 <> 1 GROUP BY 1)"""


@query(f"""WITH {_UPSERT} SELECT station_key, strftime(least(o.f, n.f), '%Y-%m-%d %H:%M:%S.%f') AS first_seen_utc, strftime(greatest(o.l, n.l), '%Y-%m-%d %H:%M:%S.%f') AS last_seen_utc,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(string_split(o.g, '|'), []), coalesce(string_split(n.g, '|'), [])))), '|') AS grades_seen,
  CASE WHEN n.station_key IS NOT NULL THEN 'active' WHEN coalesce(o.country, n.country) = 'CA' THEN CASE WHEN TIMESTAMP '2024-02-20 00:00:00' - o.l > INTERVAL 45 DAY THEN 'closed' ELSE 'missing' END ELSE 'active' END AS status
  FROM o FULL JOIN n USING (station_key)""")
def station_upsert(spark, sf_dir):
    c = captures(spark, sf_dir)
    late = F.col("capture_date") >= F.lit("2024-01-16").cast("date")
    old, new = _stations(c, ~late & (F.col("user_id") % 10 != 0)), _stations(c, late & (F.col("user_id") % 4 != 1))
    feeds = inline(spark, [(f"{k}-{b}", "2024-01-15T1800Z", "ok" if k == "CA" else "failed", False) for k in COUNTRY for b in ("COSTCO", "SAMS")], "feed string, newest string, status string, disabled boolean")
    links = inline(spark, [], "old_station_key string, new_station_key string")
    out = stations.upsert(old, new, feeds, links, "2024-02-20T0000Z", thresholds={k: 45 for k in COUNTRY})
    return out.select("station_key", text("first_seen_utc"), text("last_seen_utc"), "grades_seen", "status")


@query(f"WITH {CAP} SELECT station_key, CASE WHEN TIMESTAMP '2024-02-14 06:00:00' - max(ts) > INTERVAL 15 DAY THEN 'closed' ELSE 'missing' END AS status FROM rows_ GROUP BY 1")
def station_status(spark, sf_dir):
    seen = stations.station_seen(captures(spark, sf_dir))
    return seen.select("station_key", stations.absent_status("last_seen_utc", F.lit("2024-02-14 06:00:00").cast("timestamp"), 15).alias("status"))


@query("""SELECT 'C-' || c_custkey AS station_key, CASE WHEN c_custkey % 7 = 3 THEN 'C-' || (c_custkey + 1) END AS superseded_by FROM customer""")
def superseded_links(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("station_key"), "c_custkey")
    links = c.where("c_custkey % 7 = 3").select(F.col("station_key").alias("old_station_key"), F.concat(F.lit("C-"), (F.col("c_custkey") + 1).cast("string")).alias("new_station_key"))
    full = c.select([F.col(f.name) if f.name == "station_key" else F.lit(None).cast(f.dataType).alias(f.name) for f in STATION])
    return stations.apply_links(full, links).select("station_key", "superseded_by")


@query("""SELECT event_id, ts::date AS capture_date, value FROM events WHERE ts::date NOT IN (DATE '2024-01-05', DATE '2024-01-09')
  UNION ALL SELECT event_id, ts::date, value * 2 FROM events WHERE ts::date IN (DATE '2024-01-05', DATE '2024-01-09') AND event_id % 2 = 0""")
def partition_replace(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("capture_date"), "value")
    again = e.where(F.col("capture_date").isin("2024-01-05", "2024-01-09") & (F.col("event_id") % 2 == 0)).withColumn("value", F.col("value") * 2)
    return grain.replace_partition(e, again, "capture_date")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')")
def fresh_anti(spark, sf_dir):
    urgent = read(spark, sf_dir, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return sets.minus(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), urgent, key="c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')")
def active_semi(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_orderstatus = 'O'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


_FEEDS = [f"{k}-COSTCO" for k in sorted(COUNTRY)] + ["US-SAMS"]


@query(f"WITH {CAP} SELECT capture_date, " + ", ".join(f"""count(DISTINCT capture_id) FILTER (WHERE country || '-' || brand = '{f}')::bigint AS "{f}" """ for f in _FEEDS) + " FROM rows_ GROUP BY 1")
def coverage_pivot(spark, sf_dir):
    return grain.coverage(captures(spark, sf_dir), _FEEDS)


@query(f"""SELECT l_orderkey, l_partkey, l_linenumber, u AS price_unit, round(CASE u WHEN 'USD/gal' THEN v / {LITRES_PER_US_GALLON!r}::double WHEN 'GBp/L' THEN v / 100.0::double ELSE v END, 4) AS price_local_per_litre,
  CASE u WHEN 'USD/gal' THEN 'USD' WHEN 'GBp/L' THEN 'GBP' WHEN 'CAD/L' THEN 'CAD' ELSE 'JPY' END AS currency
  FROM (SELECT *, ['CAD/L', 'USD/gal', 'GBp/L', 'JPY/L'][l_linenumber % 4 + 1] AS u, l_extendedprice AS v FROM lineitem)""")
def normalize_units(spark, sf_dir):
    unit = F.element_at(F.array(*map(F.lit, ("CAD/L", "USD/gal", "GBp/L", "JPY/L"))), F.col("l_linenumber") % 4 + 1)
    df = read(spark, sf_dir, "lineitem").withColumn("price_unit", unit).withColumn("v", F.col("l_extendedprice"))
    return df.select("l_orderkey", "l_partkey", "l_linenumber", "price_unit", S.round_price(S.local_per_litre("v", "price_unit")).alias("price_local_per_litre"), S.currency_of("price_unit").alias("currency"))


_POSTED = ["'$' || v", "'NT$ ' || v", "' ' || v || ' '", "'¥' || v", "v || 'p'", "replace(v, '.', ',')", "'.' || split_part(v, '.', 2)", "'-'"]


@query("SELECT event_id, price_raw, try_cast(t AS double) AS price FROM (SELECT *, CASE WHEN regexp_matches(s, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN s END AS t FROM (SELECT event_id, price_raw, trim(regexp_replace(trim(price_raw), 'NT\\$|[$¥£€,\u00a0\u3000]', '', 'g')) AS s FROM (SELECT event_id, [" + ", ".join(_POSTED) + "][event_id % 8 + 1] AS price_raw FROM (SELECT event_id, printf('%.2f', value) AS v FROM events))))")
def parse_price(spark, sf_dir):
    v = F.format_string("%.2f", "value")
    posted = F.array(F.concat(F.lit("$"), v), F.concat(F.lit("NT$ "), v), F.concat(F.lit(" "), v, F.lit(" ")), F.concat(F.lit("¥"), v), F.concat(v, F.lit("p")), F.replace(v, F.lit("."), F.lit(",")), F.concat(F.lit("."), F.split_part(v, F.lit("."), F.lit(2))), F.lit("-"))
    e = read(spark, sf_dir, "events").select("event_id", F.element_at(posted, (F.col("event_id") % 8 + 1).cast("int")).alias("price_raw"))
    return e.select("event_id", "price_raw", S.parse_price("price_raw").alias("price"))


@query("SELECT p_partkey, cast(printf('%.9e', 1.0::double / p_retailprice) AS double) AS fx_usd_per_unit, cast(printf('%.9e', p_retailprice) AS double) AS units_per_usd FROM part")
def round_fx(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", S.significant(S.reciprocal("p_retailprice")).alias("fx_usd_per_unit"), S.significant("p_retailprice").alias("units_per_usd"))


_ZONES = ("America/Denver", "Asia/Tokyo", "Australia/Sydney", "Nowhere/Land")


@query(f"SELECT event_id, zone, CASE WHEN user_id % 4 <> 3 THEN timezone(zone, ts AT TIME ZONE 'UTC')::date END AS local_date FROM (SELECT *, CASE WHEN user_id % 4 = 3 THEN 'UTC' ELSE {list(_ZONES)}[user_id % 4 + 1] END AS zone FROM events)")
def local_date(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("zone", F.element_at(F.array(*map(F.lit, _ZONES)), (F.col("user_id") % 4 + 1).cast("int")))
    good = normalize.valid_zone("zone")
    safe = e.withColumn("own", F.when(good, F.col("zone")))
    return safe.select("event_id", F.coalesce("own", F.lit("UTC")).alias("zone"), S.local_date(F.col("ts").cast("timestamp"), "own").alias("local_date"))


@query("""SELECT event_type, count(*) FILTER (WHERE NOT inside)::bigint AS n_out, count(*)::bigint AS n_parsed, count(*) FILTER (WHERE NOT inside) / count(*) > 0.05 AS degrades
  FROM (SELECT event_type, coalesce(value BETWEEN lo AND hi, true) AS inside FROM (SELECT *, CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 5.0 WHEN 'error' THEN 0.5 END AS lo, CASE event_type WHEN 'view' THEN 200.0 WHEN 'click' THEN 300.0 WHEN 'error' THEN 100.0 END AS hi FROM events)) GROUP BY 1""")
def bounds_drops(spark, sf_dir):
    bounds = inline(spark, [("u", None, 0.5, 100.0), ("u", "view", 1.0, 200.0), ("u", "click", 5.0, 300.0)], "unit string, grade_raw string, low double, high double")
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("grade_raw"), F.col("value").alias("price"), F.when(F.col("event_type").isin("view", "click", "error"), "u").otherwise("none").alias("price_unit"))
    marked = normalize.with_bounds(e, bounds).withColumn("inside", normalize.in_bounds())
    out = marked.groupBy(F.col("grade_raw").alias("event_type")).agg(F.count_if(~F.col("inside")).alias("n_out"), F.count(F.lit(1)).alias("n_parsed"))
    return out.withColumn("degrades", F.col("n_out") / F.col("n_parsed") > 0.05)


@query(f"WITH {CAP} SELECT country, brand, grade_raw, CASE WHEN grade_raw IN ('view', 'click') AND brand = 'COSTCO' THEN grade ELSE 'other' END AS grade, NOT (grade_raw IN ('view', 'click') AND brand = 'COSTCO') AS unknown, count(*)::bigint AS n FROM rows_ GROUP BY ALL")
def grade_map_unknown(spark, sf_dir):
    known = priorities(spark).where("brand = 'COSTCO' AND grade_raw IN ('view', 'click')")
    return normalize.with_grade(captures(spark, sf_dir).drop("grade"), known).groupBy("country", "brand", "grade_raw", "grade", "unknown").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CAP}, ranked AS (SELECT *, row_number() OVER (PARTITION BY capture_id, station_key, grade ORDER BY CASE grade_raw WHEN 'purchase' THEN 2 WHEN 'error' THEN 0 ELSE 1 END DESC, event_id) AS n FROM rows_)
  SELECT event_id, grade_raw, CASE WHEN grade <> 'other' AND n > 1 THEN 'other' ELSE grade END AS grade, grade <> 'other' AND n > 1 AS lost FROM ranked""")
def grade_conflict(spark, sf_dir):
    mapped = normalize.with_grade(captures(spark, sf_dir).drop("grade"), priorities(spark))
    return normalize.resolve_conflicts(mapped, ["capture_id", "station_key"], "event_id").select("event_id", "grade_raw", "grade", "lost")


@query(f"""WITH {CAP} SELECT event_id, coalesce(price < max(CASE WHEN grade_raw = 'view' THEN price END) OVER (PARTITION BY capture_id, station_key), false) AS below FROM rows_""")
def below_regular(spark, sf_dir):
    return normalize.below_regular(captures(spark, sf_dir), ["capture_id", "station_key"], "view").select("event_id", "below")


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority AS currency, strftime(o_orderdate, '%Y-%m-%dT%H%MZ') AS capture_id, o_totalprice AS units, o_orderdate::date - (o_custkey % 13)::int AS rate_date FROM orders WHERE o_orderstatus <> 'P'),
  newest AS (SELECT upper(currency) AS currency, arg_max({'u': units, 'd': rate_date}, (capture_id, rate_date, units)) AS x FROM r GROUP BY 1)
  SELECT currency, x.u AS units_per_usd, 1.0::double / x.u AS fx_usd_per_unit, x.d AS fx_rate_date FROM newest WHERE abs(date_diff('day', x.d, (SELECT max(o_orderdate)::date FROM orders))) <= 7""")
def fx_carry_forward(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    day = o.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    r = o.select(F.col("o_orderpriority").alias("currency"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HHmm'Z'").alias("capture_id"), F.col("o_totalprice").alias("units_per_usd"), F.date_sub(F.to_date("o_orderdate"), (F.col("o_custkey") % 13).cast("int")).alias("fx_rate_date"), F.when(F.col("o_orderstatus") == "P", "carried:x").otherwise("x").alias("fx_source"), F.lit(None).cast("timestamp").alias("fx_fetched_at_utc"))
    return fx.carry_forward(r, day).select("currency", "units_per_usd", "fx_usd_per_unit", "fx_rate_date")


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'no_gas_service' WHEN o_orderdate::date > DATE '1998-01-01' THEN 'not_open' WHEN o_custkey % 3 = 0 THEN 'no_hours' END AS gate FROM orders""")
def gate_disposition(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 11 == 0, "extra").otherwise("seen").alias("id_origin"), F.when(F.col("o_orderstatus") == "P", "no_gas").otherwise("gas").alias("ecom_state"), F.to_date("o_orderdate").alias("opening_date"), F.when(F.col("o_custkey") % 3 == 0, False).when(F.col("o_custkey") % 3 == 1, True).alias("has_hours"))
    return o.select("o_orderkey", normalize.gate(F.lit("1998-01-01").cast("date")).alias("gate"))


@query(f"""WITH {CAP}, f AS (SELECT country || '-' || brand AS feed, count(*)::bigint AS "rows", count(DISTINCT station_key)::bigint AS stations, max(capture_id) AS last_success_capture_id,
    CASE WHEN count(*) % 3 = 0 THEN 'failed' WHEN count(*) % 3 = 1 THEN 'degraded' ELSE 'ok' END AS status FROM rows_ GROUP BY 1)
  SELECT split_part(feed, '-', 1) AS country, arg_min(status, CASE status WHEN 'failed' THEN 0 WHEN 'degraded' THEN 1 ELSE 2 END) AS status, sum("rows")::bigint AS "rows", sum(stations)::bigint AS stations, string_agg(feed, ',' ORDER BY feed) AS feeds, max(last_success_capture_id) AS last_success_capture_id FROM f GROUP BY 1""")
def feed_rollup(spark, sf_dir):
    c = captures(spark, sf_dir).groupBy(S.feed_id("country", "brand").alias("feed")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("station_key").alias("stations"), F.max("capture_id").alias("last_success_capture_id"))
    c = c.withColumn("status", F.when(F.col("rows") % 3 == 0, "failed").when(F.col("rows") % 3 == 1, "degraded").otherwise("ok"))
    return status.rollup(c).withColumn("feeds", F.array_join("feeds", ","))


@query(f"""WITH {CAP} SELECT capture_date, 'sha256:' || sha256(string_agg(station_key || chr(9) || grade_raw || chr(9) || event_id || chr(10), '' ORDER BY station_key, grade_raw, event_id::varchar)) AS price_fingerprint FROM rows_ GROUP BY 1""")
def fingerprint(spark, sf_dir):
    c = captures(spark, sf_dir).withColumn("price_raw", F.col("event_id").cast("string"))
    return status.fingerprint(c, ["capture_date"])


@query("""WITH l AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  r AS (SELECT *, sum(CASE WHEN i = 1 OR event_type IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM l)
  SELECT event_id, user_id, run::bigint AS run, min(event_id) OVER (PARTITION BY user_id, run) AS unchanged_since FROM r""")
def unchanged_runs(spark, sf_dir):
    return status.unchanged_runs(read(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_type").select("event_id", "user_id", "run", "unchanged_since")


@query("""WITH s AS (SELECT event_type AS feed, event_id AS capture_id, CASE user_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'skipped' ELSE 'failed' END AS status FROM events),
  r AS (SELECT *, count(*) FILTER (WHERE status = 'ok') OVER (PARTITION BY feed ORDER BY capture_id) AS run FROM s)
  SELECT feed, capture_id, status, count(*) FILTER (WHERE status = 'failed') OVER (PARTITION BY feed, run ORDER BY capture_id ROWS UNBOUNDED PRECEDING)::bigint AS consecutive_failures FROM r""")
def failure_streaks(spark, sf_dir):
    s = read(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), F.col("event_id").alias("capture_id"), F.when(F.col("user_id") % 4 == 0, "ok").when(F.col("user_id") % 4 == 1, "skipped").otherwise("failed").alias("status"))
    return status.failure_streaks(s)


@query("SELECT l_orderkey, l_linenumber, count(*)::bigint AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_probe(spark, sf_dir):
    return validate.duplicate_probe(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) FILTER (WHERE o_orderkey IS NULL)::bigint AS o_orderkey, count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL)::bigint AS o_orderstatus, count(*) FILTER (WHERE o_totalprice IS NULL)::bigint AS o_totalprice FROM orders")
def null_probe(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return validate.null_probe(o, ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("SELECT range::bigint AS id FROM range(1, (SELECT max(c_custkey) FROM customer) + 201) WHERE range NOT IN (SELECT o_custkey FROM orders)")
def candidate_ids(spark, sf_dir):
    known = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return sets.candidate_ids(known, read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")))


@query("SELECT s_nationkey, ((n - 1) // 10)::bigint AS batch, string_agg(s_suppkey::varchar, ',' ORDER BY s_suppkey) AS ids, count(*)::bigint AS n_ids FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier) GROUP BY 1, 2")
def id_batches(spark, sf_dir):
    return sets.batches(read(spark, sf_dir, "supplier"), "s_suppkey", 10, ["s_nationkey"])


@query("""SELECT event_id, json_extract_string(props, '$.k')::int AS k, event_type || '=' || json_extract_string(props, '$.k') AS entry FROM events""")
def json_props(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("g", feeds.grade_map(F.col("props")))
    return e.select("event_id", F.col("g")["k"].cast("int").alias("k"), F.concat("event_type", F.lit("="), F.col("g")["k"]).alias("entry"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(list_distinct(regexp_extract_all(html, 'href="/([^"]*)"', 1)))::int AS n_links, array_to_string(list_distinct(list_sort(regexp_extract_all(html, 'ad (\\d+)', 1))).list_sort(), ',') AS ads FROM pages""")
def html_extract(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(S.ids_in_text("html", 'href="/([^"]*)"')).alias("n_links"), F.array_join(F.array_sort(S.ids_in_text("html", r"ad (\d+)")), ",").alias("ads"))


@query(r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(regexp_replace(url, '\?.*$', ''), '(\d+)$', 1), '') AS number FROM pages")
def url_parts(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), S.first_group("url", "[?&]page=([^&#]*)").alias("page"), S.trailing_number(F.regexp_replace("url", r"\?.*$", "")).alias("number"))


@query("""SELECT year(ts)::int AS year, month(ts)::int AS month, count(*)::bigint AS n_rows, count(DISTINCT ts::date)::bigint AS n_days, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1, 2""")
def year_close(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.year("ts").alias("year"), F.month("ts").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.to_date("ts")).alias("n_days"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(f"WITH {CAP}, r AS (SELECT capture_id, ts::date AS day, count(*)::bigint AS n FROM rows_ GROUP BY ALL) SELECT day, arg_max(n, capture_id) AS rows_expected FROM r GROUP BY 1")
def expected_rows(spark, sf_dir):
    c = captures(spark, sf_dir).groupBy("capture_id", F.col("capture_date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return stations.expected_rows(c).withColumnRenamed("rows", "rows_expected")


@query("SELECT o_custkey AS source_station_id, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate::date >= (SELECT max(o_orderdate)::date - 30 FROM orders) GROUP BY 1")
def seen_window(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "last_seen_utc")
    last = o.agg(F.max(F.to_date("last_seen_utc"))).first()[0]
    return stations.seen_within(o, last, 30).groupBy(F.col("o_custkey").alias("source_station_id")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT c_custkey::varchar AS source_station_id, row_number() OVER (ORDER BY c_custkey)::int AS place FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)""")
def roster_order(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("source_station_id"))
    b = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("source_station_id"))
    out = sets.roster(a, b)
    return out.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*S.numeric_first("source_station_id"))))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'absent' WHEN c_nationkey % 2 = 0 AND c_acctbal > 0 THEN 'gas' ELSE 'no_gas' END AS ecom_state FROM customer""")
def ecom_states(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("source_station_id", F.col("c_custkey").cast("string"))
    index = c.where("c_custkey % 5 <> 0").select(F.col("source_station_id").alias("id"), F.when(F.col("c_nationkey") % 2 == 0, "US").otherwise("CA").alias("country"), (F.col("c_acctbal") > 0).alias("has_gas"))
    return sets.ecom_state(c.select("c_custkey", "source_station_id"), index).select("c_custkey", "ecom_state")


@query(f"WITH {CAP} SELECT source, reason, count(*)::bigint AS n FROM (SELECT country || '-' || brand AS source, CASE WHEN price < 1 THEN 'low' WHEN price > 200 THEN 'high' END AS reason FROM rows_) WHERE reason IS NOT NULL GROUP BY 1, 2")
def drop_counts(spark, sf_dir):
    c = captures(spark, sf_dir).select(S.feed_id("country", "brand").alias("source"), F.when(F.col("price") < 1, "low").when(F.col("price") > 200, "high").alias("reason")).where("reason IS NOT NULL")
    return status.drop_counts(c, "source")


@query("SELECT DISTINCT ts::date AS capture_date FROM events WHERE ts::date NOT IN (SELECT ts::date FROM events WHERE event_id % 500 <> 1 AND ts::date > DATE '2024-01-04')")
def lost_dates(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("capture_date", F.to_date("ts"))
    return grain.lost_values(e, e.where("event_id % 500 <> 1 AND capture_date > DATE '2024-01-04'"), "capture_date")


@query(f"""WITH {CAP}, seen AS (SELECT station_key, any_value(country) AS country, min(ts) AS f, max(ts) AS l, string_agg(DISTINCT grade_raw, '|' ORDER BY grade_raw) AS g, max(ts) = (SELECT max(ts) FROM rows_) AS listed, max(user_id) AS u, max(capture_id) AS c FROM rows_ GROUP BY 1),
  newest AS (SELECT country, max(capture_id) AS c FROM rows_ GROUP BY 1)
  SELECT station_key, strftime(f, '%Y-%m-%d %H:%M:%S.%f') AS first_seen_utc, strftime(l, '%Y-%m-%d %H:%M:%S.%f') AS last_seen_utc, g AS grades_seen,
    CASE WHEN u % 3 = 0 THEN CASE WHEN listed THEN 'missing' WHEN (SELECT max(ts) FROM rows_) - l > INTERVAL 2 DAY THEN 'closed' ELSE 'missing' END
      WHEN seen.c = newest.c THEN 'active' WHEN (SELECT max(ts) FROM rows_) - l > INTERVAL 2 DAY AND NOT listed THEN 'closed' ELSE 'missing' END AS status FROM seen JOIN newest USING (country)""")
def station_rebuild(spark, sf_dir):
    c = captures(spark, sf_dir)
    whole = c.select("*", F.col("user_id").cast("string").alias("source_station_id"), *[F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("name_local", "string"), ("address", "string"), ("city", "string"), ("postcode", "string"), ("lat", "double"), ("lon", "double"), ("timezone", "string"))])
    existing = _stations(c, F.col("user_id") % 3 == 0).withColumn("status", F.lit("missing"))
    out = stations.rebuild(whole, existing, empty(spark, STATION).select(F.col("station_key").alias("old_station_key"), F.col("station_key").alias("new_station_key")), thresholds={k: 2 for k in COUNTRY})
    return out.select("station_key", text("first_seen_utc"), text("last_seen_utc"), "grades_seen", "status")


#: The events as raw stations: every user is polled on every day from the first to the last with events, each day is a
#: capture. Who is new, watched or closed, has its own unit or zone, follows from the user id.
_RAW = f"""st AS (SELECT *, CASE WHEN user_id % 7 = 0 THEN 'watch' WHEN user_id % 7 = 1 THEN 'extra' ELSE 'seen' END AS id_origin, CASE WHEN user_id % 5 = 0 THEN 'no_gas' WHEN user_id % 3 = 2 THEN 'absent' ELSE 'gas' END AS ecom_state,
    user_id % 11 = 0 AND day < DATE '2024-01-10' AS future, user_id % 13 = 0 AS closed, user_id % 17 <> 0 AS zoned, user_id % 14 = 0 AND day >= DATE '2024-01-16' AS is_on, user_id % 5 <> 0 AND user_id % 3 = 2 AS own_unit, user_id % 17 = 1 AND user_id % 5 <> 0 AND user_id % 3 = 1 AS own_zone
  FROM (SELECT user_id, unnest(generate_series(min(ts)::date, max(ts)::date, INTERVAL 1 DAY))::date AS day FROM events GROUP BY 1)),
pr AS (SELECT user_id, ts::date AS day, event_id, event_type AS grade_raw, value AS price, CASE event_type {_grade} END AS grade, CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 0 ELSE 1 END AS priority FROM events),
judged AS (SELECT *, CASE WHEN is_on OR id_origin = 'extra' THEN NULL WHEN ecom_state = 'no_gas' THEN 'no_gas_service' WHEN future THEN 'not_open' WHEN closed THEN 'no_hours' END AS gate,
    CASE WHEN gate IS NOT NULL THEN gate WHEN (user_id, day) NOT IN (SELECT (user_id, day) FROM pr) THEN 'no_price' WHEN NOT zoned THEN 'no_timezone' WHEN id_origin = 'watch' AND NOT is_on THEN 'watch' END AS reason FROM st),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, grade ORDER BY priority DESC, event_id) AS n FROM pr),
mapped AS (SELECT *, CASE WHEN grade <> 'other' AND n > 1 THEN 'other' ELSE grade END AS final, own_unit OR price BETWEEN 1.0 AND 100.0 AS inside FROM placed JOIN judged USING (user_id, day)),
shown AS (SELECT *, max(CASE WHEN inside THEN (final = 'regular')::int END) OVER (PARTITION BY user_id, day) AS regular FROM mapped),
settled AS (SELECT *, reason IS NULL AND regular = 0 AND id_origin = 'seen' AND ecom_state = 'absent' AS refused FROM shown)"""


def normalized(spark: SparkSession, sf_dir: str) -> normalize.Normalized:
    e = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.col("event_type").alias("grade_raw"), F.concat(F.lit("$"), F.col("value").cast("string")).alias("price_raw")))), lambda x: F.struct(x["grade_raw"].alias("grade_raw"), x["price_raw"].alias("price_raw")))
    prices = e.groupBy("user_id", "day").agg(listed.alias("prices"))
    polled = e.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    u, day = F.col("user_id"), F.col("day")
    raw = polled.select("user_id", F.explode(F.sequence("first", "last")).alias("day")).join(prices, ["user_id", "day"], "left")
    made = {
        "country": F.lit("US"), "brand": F.lit("COSTCO"), "source_station_id": u.cast("string"), "name": F.lit("n"), "prices": F.col("prices"), "region": F.when(u % 5 != 0, F.concat(F.lit("R"), (u % 3).cast("string"))),
        "id_origin": F.when(u % 7 == 0, "watch").when(u % 7 == 1, "extra").otherwise("seen"), "ecom_state": F.when(u % 5 == 0, "no_gas").when(u % 3 == 2, "absent").otherwise("gas"),
        "opening_date": F.when(u % 11 == 0, F.lit("2024-01-10").cast("date")), "has_hours": F.when(u % 13 == 0, False), "timezone": F.when(u % 17 == 0, "Nowhere/Land").when(u % 17 != 1, "America/Denver"),
    }
    kinds = StructType.fromDDL(normalize.RAW_STATION)
    capture = {"capture_id": F.date_format(day, "yyyy-MM-dd'T'0530'Z'"), "capture_date": day, "captured_at_utc": (day.cast("timestamp") + F.make_interval(hours=F.lit(5), mins=F.lit(30))), "source": F.lit("inline")}
    stations_ = raw.select([made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds] + [v.alias(k) for k, v in capture.items()])
    stations_ = normalize.with_zone(stations_, inline(spark, [("US", "R1", "Asia/Tokyo"), ("US", "*", "America/Denver")], "country string, region string, zone string"))
    on = polled.where("user_id % 14 = 0").select(F.lit("US-COSTCO").alias("feed"), F.col("user_id").cast("string").alias("source_station_id"), F.lit("2024-01-01").alias("detected"), F.lit("on").alias("status"), F.lit("2024-01-16").alias("publish_from"), F.lit("").alias("note"))
    dims = normalize.Dimensions(
        priorities(spark).unionByName(inline(spark, [("US", "COSTCO", "error", "other", 0)], "country string, brand string, grade_raw string, grade string, priority bigint")),
        inline(spark, [("US", None, "USD/gal"), ("US", "R2", "CAD/L")], "country string, region string, unit string"),
        inline(spark, [("USD/gal", None, 1.0, 100.0)], "unit string, grade_raw string, low double, high double"),
        on,
    )
    return normalize.normalize(stations_, rates(spark), dims)


@query(f"""WITH {_RAW} SELECT day AS capture_date, 'US-COSTCO-' || user_id AS station_key, grade_raw, final AS grade, price, round(CASE WHEN own_unit THEN price ELSE price / {LITRES_PER_US_GALLON!r}::double END, 9) AS price_local_per_litre,
    round(CASE WHEN own_unit THEN price * (1.0::double / 1.36::double) * {LITRES_PER_US_GALLON!r}::double ELSE price END, 6) AS price_usd_per_gallon, CASE WHEN own_zone THEN day ELSE day - 1 END AS local_date
  FROM settled WHERE reason IS NULL AND inside AND NOT refused""")
def normalize_rows(spark, sf_dir):
    return normalized(spark, sf_dir).rows.select("capture_date", "station_key", "grade_raw", "grade", "price", F.round("price_local_per_litre", 9).alias("price_local_per_litre"), F.round("price_usd_per_gallon", 6).alias("price_usd_per_gallon"), "local_date")


@query(f"""WITH {_RAW} SELECT strftime(day, '%Y-%m-%dT0530Z') AS capture_id, source_station_id, reason, count(*)::bigint AS n FROM (
    SELECT day, user_id::varchar AS source_station_id, reason FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT day, user_id::varchar, 'out_of_bounds' FROM settled WHERE reason IS NULL AND NOT inside
    UNION ALL SELECT DISTINCT day, user_id::varchar, 'no_regular' FROM settled WHERE refused) GROUP BY ALL""")
def normalize_drops(spark, sf_dir):
    return normalized(spark, sf_dir).drops.groupBy("capture_id", "source_station_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_RAW} SELECT day AS capture_date, user_id::varchar AS source_station_id, grade_raw, final AS grade, price, reason AS hold_reason FROM settled WHERE reason IN ('no_gas_service', 'not_open', 'no_hours', 'watch') AND zoned AND inside")
def normalize_held(spark, sf_dir):
    return normalized(spark, sf_dir).held.select("capture_date", "source_station_id", "grade_raw", "grade", "price", "hold_reason")


@query(f"""WITH {_RAW} SELECT strftime(day, '%Y-%m-%dT0530Z') AS capture_id, 'US-COSTCO' AS feed, code, detail FROM (SELECT DISTINCT day, 'no_regular' AS code, user_id::varchar AS detail FROM settled WHERE reason IS NULL AND inside AND regular = 0 AND NOT refused
    UNION ALL SELECT day, 'grade_conflict', 'US-COSTCO-' || user_id || ':' || grade || ':' || grade_raw FROM settled WHERE reason IS NULL AND final <> grade
    UNION ALL SELECT DISTINCT day, 'priced_before_open', user_id::varchar FROM settled WHERE gate IN ('not_open', 'no_hours') AND inside AND grade = 'regular')""")
def normalize_warnings(spark, sf_dir):
    return normalized(spark, sf_dir).warnings.select("capture_id", "feed", "code", "detail")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import body_queries  # noqa: F401  registers the queries on response bodies

    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from . import body_queries  # noqa: F401

    return {name: sql for name, (_, sql) in QUERIES.items()}
