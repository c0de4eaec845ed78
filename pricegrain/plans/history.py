"""Captures into history: idempotent merge of one capture, closing of months and years, full rebuild.

The stored layout is a partitioned Parquet table of capture rows (``capture_date``), beside small current
tables. Every step replaces by key, and a JSON commit record is written last, so that a retry after a
crash converges: whatever isn't recorded is merged again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fx, grain, stations
from ..operators.validate import SchemaError, duplicate_probe, rounded, validate
from ..schemas import DAILY_ROWS, FX, LINKS, ROW, ROWS, STATION, empty
from ..sources.writers import AssetStore, write_json


class StorageError(RuntimeError):
    """Stored data that doesn't agree with its commit records."""


@dataclass
class Capture:
    """One capture to merge; ``feeds`` maps a feed to its status block (status, warnings)."""

    capture_id: str
    rows: DataFrame
    stations: DataFrame
    rates: DataFrame | None = None
    feeds: dict = field(default_factory=dict)

    @property
    def day(self) -> str:
        return self.capture_id[:10]

    @property
    def month(self) -> str:
        return self.capture_id[:7]


class History:
    """A price history under ``root``: Parquet tables, and manifests in an AssetStore."""

    def __init__(self, spark: SparkSession, root: str, links: DataFrame | None = None, thresholds: dict[str, int] | None = None, disabled: set[str] = frozenset()):
        self.spark, self.root = spark, root.rstrip("/")
        self.store = AssetStore(Path(self.root) / "manifests")
        self.links = links if links is not None else empty(spark, LINKS)
        self.thresholds, self.disabled = thresholds or {}, disabled

    # ---- tables ----

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _has(self, name: str) -> bool:
        fs, p = self._fs(f"{self.root}/{name}")
        return fs.exists(p)

    def versions(self, name: str) -> list[int]:
        """Complete versions of a current table, oldest first: Spark marks a folder that it wrote as a whole."""
        fs, p = self._fs(f"{self.root}/{name}")
        found = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(v[1:]) for v in found if v.startswith("v") and v[1:].isdigit() and self._has(f"{name}/{v}/_SUCCESS"))

    def table(self, name: str, schema) -> DataFrame:
        """A current table at its newest complete version, or the partitioned captures."""
        if name == "captures":
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}") if self._has(name) else empty(self.spark, schema)
        known = self.versions(name)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/v{known[-1]}") if known else empty(self.spark, schema)

    def captures(self, where=None) -> DataFrame:
        out = self.table("captures", ROW)
        return out.where(where) if where is not None else out

    def _swap(self, df: DataFrame, name: str, order: list[str]) -> None:
        """Write a current table as its next version. Readers take the newest complete one, so that a crash at any
        point leaves the version before; versions before that go."""
        known = self.versions(name)
        number = known[-1] + 1 if known else 1
        df.orderBy(*order).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}/v{number}")
        for v in known[:-1]:
            self._drop(f"{self.root}/{name}/v{v}")

    # ---- manifests ----

    def manifest(self, month: str) -> dict:
        return self.store.read_json(f"data-{month}", f"manifest-{month}.json") or {"captures": {}, "closed": False}

    def _commit(self, month: str, manifest: dict, token: str) -> None:
        folder = self.store.folder(f"data-{month}")
        write_json(folder / f".manifest-{token}", manifest)
        self.store.replace(f"data-{month}", f"manifest-{month}.json", folder / f".manifest-{token}", token)
        (folder / f".manifest-{token}").unlink()

    def merged(self) -> set[str]:
        return {c for tag in self.store.tags() for c in self.manifest(tag.removeprefix("data-"))["captures"]}

    def newest_by_feed(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for tag in self.store.tags():
            for capture_id, entry in self.manifest(tag.removeprefix("data-"))["captures"].items():
                for feed, block in entry.get("feeds", {}).items():
                    if block.get("status") in ("ok", "degraded"):
                        out[feed] = max(out.get(feed, ""), capture_id)
        return out

    # ---- one capture ----

    def merge(self, capture: Capture) -> dict[str, int]:
        """Merge a capture; running it again changes nothing. Returns its rows by day.

        Order: the day's partition, the current tables, and the manifest last. A day whose stored counts
        don't agree with the manifest's is refused before anything is written.
        """
        validate(capture.rows.select(ROW.names), ROWS)
        manifest = self.manifest(capture.month)
        day = F.col("capture_date") == F.lit(capture.day).cast("date")
        if capture.rows.where(~day).limit(1).count():
            raise SchemaError(f"rows of another day than {capture.day}")
        stored = self.captures(day)
        counts = {r["capture_id"]: r["n_rows"] for r in grain.counts_by(stored, "capture_id").collect()}
        for other, entry in manifest["captures"].items():
            expected = entry["rows"].get(capture.day)
            if other != capture.capture_id and expected is not None and counts.get(other, 0) != expected:
                raise StorageError(f"{capture.day}: capture {other} has {counts.get(other, 0)} rows, the manifest records {expected}")
        incoming = rounded(capture.rows.select(ROW.names), ROWS)
        day_rows = grain.replace_partition(stored, incoming, "capture_id") if counts else incoming
        if found := duplicate_probe(day_rows, ROWS.key).limit(5).collect():
            raise StorageError(f"{capture.day} isn't unique: {found}")
        out = day_rows.repartition(1).sortWithinPartitions(*ROWS.order)  # a day is one file
        staged = f"{self.root}/.staged-{capture.capture_id}"
        out.write.mode("overwrite").parquet(staged)  # the partition can't be read while it is replaced
        self.spark.read.schema(ROW).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("capture_date").parquet(f"{self.root}/captures")
        self._drop(staged)
        self._update_current(capture, incoming)
        own = {str(r["capture_date"]): r["n_rows"] for r in grain.counts_by(incoming, "capture_date").collect()}
        manifest["captures"][capture.capture_id] = {"feeds": capture.feeds, "rows": own}
        manifest["closed"] = False  # late data reopens a month
        self._commit(capture.month, manifest, capture.capture_id)
        return own

    def _drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _update_current(self, capture: Capture, incoming: DataFrame) -> None:
        latest = grain.update_latest(self.table("latest", ROW), incoming)
        known = self.newest_by_feed()
        blocks = capture.feeds
        rows = [(f, known.get(f), blocks.get(f, {}).get("status"), f in self.disabled) for f in {*known, *blocks, *self.disabled}]
        feeds = self.spark.createDataFrame(rows, "feed string, newest string, status string, disabled boolean")
        missed = [(f, w.get("detail")) for f, b in blocks.items() for w in b.get("warnings", []) if w.get("code") == "not_reached"]
        unreached = self.spark.createDataFrame(missed, "feed string, source_station_id string")
        previous = self.table("stations", STATION)
        upserted = stations.upsert(previous, capture.stations.select(STATION.names), feeds, self.links, capture.capture_id, unreached, self.thresholds)
        before, after = previous.count(), upserted.count()
        if after < before:
            raise StorageError(f"stations would shrink from {before} to {after}")
        self._swap(latest, "latest", ["station_key", "grade_raw"])
        self._swap(upserted, "stations", ["station_key"])
        if capture.rates is not None:
            rates = capture.rates.withColumn("capture_id", F.lit(capture.capture_id))
            self._swap(fx.upsert(self.table("fx", FX), rates), "fx", ["capture_id", "currency"])
        self._swap(self._covered(capture.day), "coverage", ["capture_date"])

    def _covered(self, day: str) -> DataFrame:
        """The coverage with one day counted anew; a feed that it hasn't met adds a column."""
        fresh = grain.coverage(self.captures(F.col("capture_date") == F.lit(day).cast("date")))
        known = self.versions("coverage")
        if not known:
            return fresh
        old = self.spark.read.parquet(f"{self.root}/coverage/v{known[-1]}").where(F.col("capture_date") != F.lit(day).cast("date"))
        both = old.unionByName(fresh, allowMissingColumns=True)
        return both.na.fill(0, [c for c in both.columns if c != "capture_date"]).select("capture_date", *sorted(c for c in both.columns if c != "capture_date"))

    # ---- periods ----

    def blocking_reasons(self, month: str) -> list[str]:
        """Why a month can't be closed: recorded days without rows, and days whose counts differ."""
        recorded = self.manifest(month)["captures"]
        rows = [(d, c, n) for c, e in recorded.items() for d, n in e["rows"].items()]
        expected = self.spark.createDataFrame(rows, "day string, capture_id string, n bigint")
        span = F.date_format("capture_date", "yyyy-MM") == month
        actual = grain.counts_by(self.captures(span), "capture_date", "capture_id").select(F.col("capture_date").cast("string").alias("day"), "capture_id", "n_rows")
        off = expected.join(actual, ["day", "capture_id"], "full").where(~F.col("n").eqNullSafe(F.col("n_rows"))).orderBy("day", "capture_id")
        return [f"day {r['day']}, capture {r['capture_id']}: {r['n_rows'] or 0} rows stored, {r['n'] or 0} recorded" for r in off.limit(100).collect()]

    def close_month(self, month: str) -> list[str]:
        """Write the month's daily grain and mark it closed; returns the reasons if it can't be."""
        if reasons := self.blocking_reasons(month):
            return reasons
        rows = self.captures(F.date_format("capture_date", "yyyy-MM") == month)
        daily = rounded(grain.daily_grain(rows), DAILY_ROWS)
        daily.repartitionByRange("capture_date").sortWithinPartitions(*DAILY_ROWS.order).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/months/month={month}")
        manifest = self.manifest(month)
        manifest |= {"closed": True, "daily_rows": self.spark.read.parquet(f"{self.root}/months/month={month}").count()}
        self._commit(month, manifest, "close")
        return []

    def close_year(self, year: str) -> bool:
        """Concatenate a year's closed months; skipped while the months are those it was made of."""
        months = [t.removeprefix("data-") for t in self.store.tags() if t.startswith(f"data-{year}-")]
        closed = {m: self.manifest(m).get("daily_rows") for m in months if self.manifest(m)["closed"]}
        if len(closed) < 12 or (self.store.read_json(f"year-{year}", "manifest.json") or {}).get("months") == closed:
            return False
        rows = self.spark.read.parquet(*[f"{self.root}/months/month={m}" for m in sorted(closed)])
        if rows.count() != sum(closed.values()):
            raise StorageError(f"{year}: the months' rows don't add up")
        rows.repartitionByRange("capture_date").sortWithinPartitions(*DAILY_ROWS.order).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/years/year={year}")
        folder = self.store.folder(f"year-{year}")
        write_json(folder / ".new", {"months": closed})
        self.store.replace(f"year-{year}", "manifest.json", folder / ".new", "year")
        (folder / ".new").unlink()
        return True

    def rebuild_current(self) -> None:
        """Recompute the current tables from all captures; agrees with what merging one by one yields."""
        rows = self.captures()
        newest = max(self.merged(), default=None)
        blocks = self.manifest(newest[:7])["captures"][newest]["feeds"] if newest else {}
        feeds = self.spark.createDataFrame([(f, b.get("status"), f in self.disabled) for f, b in blocks.items()], "feed string, status string, disabled boolean") if blocks else None
        before = self.table("stations", STATION)
        rebuilt = stations.rebuild(rows, before, self.links, feeds, None, self.thresholds)
        if (lost := grain.lost_values(before, rebuilt, "station_key").limit(5).collect()):
            raise StorageError(f"stations would be lost: {lost}")
        self._swap(grain.latest_rows(rows), "latest", ["station_key", "grade_raw"])
        self._swap(rebuilt, "stations", ["station_key"])
        self._swap(grain.coverage(rows), "coverage", ["capture_date"])
        posted = rows.where("currency <> 'USD' AND fx_usd_per_unit > 0").withColumn("units_per_usd", F.lit(1.0) / F.col("fx_usd_per_unit"))
        self._swap(fx.upsert(self.table("fx", FX), fx.rebuild(posted.select(*FX.names, "captured_at_utc"), "captured_at_utc")), "fx", ["capture_id", "currency"])

    def rebuild_from(self, captures: list[Capture]) -> dict[str, dict[str, int]]:
        """Merge re-parsed captures again, oldest first; those already merged with as many rows are skipped."""
        done = {}
        for c in sorted(captures, key=lambda c: c.capture_id):
            entry = self.manifest(c.month)["captures"].get(c.capture_id)
            if entry and sum(entry["rows"].values()) == c.rows.count():
                continue
            done[c.capture_id] = self.merge(c)
        return done


def status_json(statuses: DataFrame) -> str:
    return json.dumps({r["feed"]: {k: v for k, v in r.asDict(recursive=True).items() if k != "feed"} for r in statuses.collect()}, sort_keys=True)
