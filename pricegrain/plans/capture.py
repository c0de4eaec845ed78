"""Stored responses to one capture: parse every feed, normalize, judge, and hand over for merging.

Requests are made elsewhere; this plan reads what they stored, so that a capture and its later rebuild run
the same code, the rebuild under today's interpretation tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import fx, normalize, sets, stations, status
from ..operators.constants import SEEN_DAYS
from ..schemas import FX, STATION, empty
from ..sources import feeds as parsers
from .history import Capture

#: What the rows of a feed give as their source; store lists are the rest.
SOURCES = {"US-SAMS": "sams-fuel-center", "US-COSTCO": "costco-us-gasprices", "CA-COSTCO": "costco-ca-lookup"}
STORE_LIST = "costco-occ"


@dataclass
class Metadata:
    """What the US and the Canadian feed know of stations beside their prices."""

    spark: SparkSession
    shared: DataFrame
    config: Config
    day: str
    previous: DataFrame

    def parse(self, feed: str, own: DataFrame, roster: DataFrame | None) -> parsers.Parsed:
        answers = self.shared.where(F.col("key").contains("ecom-api") & parsers.answered())
        places = parsers.locator(answers) if answers.limit(1).count() else None
        country = feed.split("-")[0]
        known = self.previous.where((F.col("country") == country) & (F.col("brand") == "COSTCO"))
        cached = stations.seen_within(known, self.day, SEEN_DAYS)
        if country == "CA":
            return parsers.ca_feed(own, places, cached)
        extras = self.config.extras(self.spark)
        if roster is None:
            listed = extras.select("source_station_id", F.lit("extra").alias("id_origin"))
            seen = cached.join(listed, "source_station_id", "left_anti").select("source_station_id", F.lit("seen").alias("id_origin"))
            roster = sets.ecom_state(listed.union(seen), places)
        return parsers.us_feed(own, roster, places, extras, cached)


@dataclass
class Captured:
    capture: Capture
    normalized: normalize.Normalized
    statuses: DataFrame


def rates_of(responses: DataFrame, previous: DataFrame, capture_date: str) -> DataFrame:
    """Rates of the primary source, else of the dated fallback, else carried forward."""
    primary = parsers.frankfurter(responses.where(F.col("key").contains("frankfurter")))
    dated = parsers.dated_rates(responses.where(F.col("key").contains("fawaz")))
    return fx.by_priority([primary, dated, fx.carry_forward(previous, capture_date)])


def run(spark: SparkSession, responses: DataFrame, config: Config, capture_id: str, captured_at: str, rosters: dict[str, DataFrame] | None = None, previous_rates: DataFrame | None = None, previous_status: DataFrame | None = None, selected: list[str] | None = None, previous_stations: DataFrame | None = None) -> Captured:
    """One capture of all feeds from stored responses (``sources.readers.read_responses``).

    ``rosters`` names the polled ids of a feed that needs them (the US default: stations seen of late, and extras);
    ``selected`` limits the feeds that ran. The locator's body is shared by the US and the Canadian feed.
    """
    rosters, every = rosters or {}, parsers.feeds_for()
    ran = [f for f in every if (selected is None or f in selected) and f not in config.disabled()]
    day = capture_id[:10]
    shared = responses.where("feed = 'shared' OR feed = 'fx'")
    rates = rates_of(shared, previous_rates if previous_rates is not None else empty(spark, FX), day)
    raw, warnings = None, None
    metadata = Metadata(spark, shared, config, day, previous_stations if previous_stations is not None else empty(spark, STATION))
    for feed in ran:
        own = responses.where(F.col("feed") == feed)
        if feed in ("US-COSTCO", "CA-COSTCO"):
            parsed = metadata.parse(feed, own, rosters.get(feed))
        elif feed in rosters or not feed.endswith("SAMS"):
            parsed = parsers.PARSERS[feed](own, rosters[feed]) if feed in rosters else parsers.PARSERS[feed](own)
        else:
            continue  # nothing was polled
        said = parsed.warnings.select(F.lit(feed).alias("feed"), "code", "detail")
        raw = parsed.stations if raw is None else raw.unionByName(parsed.stations)
        warnings = said if warnings is None else warnings.unionByName(said)
    if raw is None:
        raise ValueError("no feed ran")
    source = F.coalesce(F.create_map(*[F.lit(x) for kv in SOURCES.items() for x in kv])[F.concat("country", F.lit("-"), "brand")], F.lit(STORE_LIST))
    raw = normalize.with_zone(raw, config.zones(spark)).withColumn("source", source)
    out = normalize.normalize(raw, rates, config.dimensions(spark), capture_id, day, captured_at)
    warnings = warnings.unionByName(out.warnings.select("feed", "code", "detail"))  # they count before a feed is judged
    feeds = spark.createDataFrame([(f, f in ran) for f in every], "feed string, ran boolean")
    before = previous_status if previous_status is not None else spark.createDataFrame([], "feed string, price_fingerprint string, unchanged_since_capture_id string, consecutive_failures int, last_success_capture_id string, recent_errors array<string>")
    judged = status.evaluate(feeds, out.rows, out.drops.select("feed", "reason"), warnings, before, capture_id, captured_at)
    said = {}
    for w in warnings.collect():
        said.setdefault(w["feed"], []).append({"code": w["code"], "detail": w["detail"]})
    blocks = {r["feed"]: {"status": r["status"], "warnings": said.get(r["feed"], [])} for r in judged.collect()}
    return Captured(Capture(capture_id, out.rows, out.stations, rates, blocks), out, judged)
