"""Discovery of stations that aren't polled yet: candidate ids, plausible reports, a readable list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sets
from ..operators.constants import BOUNDS, LOOK_AHEAD, WATCH_CAP
from ..operators.grain import keep_first


def select_bundle(captures: DataFrame, feed: str = "US-COSTCO") -> DataFrame:
    """The newest capture (capture_id, asset, feed, status) with a usable feed and a stored bundle."""
    good = captures.where((F.col("feed") == feed) & F.col("status").isin("ok", "degraded") & F.col("asset").isNotNull())
    return good.groupBy("feed").agg(F.max_by(F.struct("capture_id", "asset"), "capture_id").alias("b")).select("b.*")


def candidates(known: list[DataFrame], polled: DataFrame, other_country: DataFrame, ahead: int = LOOK_AHEAD) -> DataFrame:
    """Ids to ask: up to the greatest known plus ``ahead``, without the polled and the neighbour's."""
    every = known[0].select("id")
    for k in known[1:]:
        every = every.union(k.select("id"))
    return sets.candidate_ids(every, polled.select("id").union(other_country.select("id")), ahead)


def reports(prices: DataFrame, listed: DataFrame, watched: DataFrame, low: float = BOUNDS["USD/gal"][0], high: float = BOUNDS["USD/gal"][1]) -> DataFrame:
    """Plausible prices (id, regular, premium) of ids neither listed nor watched, numbered in id order."""
    found = sets.reportable(prices, low, high)
    new = sets.minus(found, listed, watched, key="id")
    return keep_first(new, ["id"], [F.asc("regular"), F.asc("premium")])


def to_watch(found: DataFrame, feed: str, cap: int = WATCH_CAP) -> list[dict]:
    """The first ``cap`` reports as watch-list rows: a report for people, not a filter of data."""
    return [{"feed": feed, "source_station_id": str(r["id"]), "note": f"regular {r['regular']}"} for r in found.orderBy("id").limit(cap).collect()]


def issue_body(found: DataFrame, budget: int = 60_000) -> str:
    """A table of the reports that fits a byte budget, and how many didn't fit."""
    head, rows, size, left = "| id | regular | premium |\n| --- | --- | --- |\n", [], 0, 0
    for r in found.orderBy("id").toLocalIterator():
        line = f"| {r['id']} | {r['regular']} | {r['premium'] if r['premium'] is not None else ''} |\n"
        if left or size + len(line.encode()) > budget:
            left += 1
            continue
        rows.append(line)
        size += len(line.encode())
    return head + "".join(rows) + (f"\nand {left} more\n" if left else "")
