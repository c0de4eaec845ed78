"""Configuration: TOML country and feed tables and CSV dimensions, checked, then turned into broadcast frames.

Two views split what a rebuild takes from where: the fetch view (what was requested) belongs to a stored
capture, the interpretation view (how to read an answer) always to today's files.
"""

from __future__ import annotations

import csv
import re
import tomllib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path
from zoneinfo import available_timezones

from pyspark.sql import DataFrame, SparkSession

from .operators.constants import CURRENCY_OF_UNIT, ID_BATCH
from .operators.normalize import Dimensions
from .schemas import EXTRA_IDS, GRADES, LINKS, WATCH

GRADE_NAMES = ("regular", "premium", "diesel", "other")
WATCH_STATUSES = ("hold", "on")
INTERPRETATION = ("price_unit", "unit_overrides", "bounds", "floor", "stale_after_days", "closed_after_days", "timezones")


class ConfigError(ValueError):
    """A configuration that can't be used, with the place of every fault."""


@dataclass
class Config:
    countries: dict[str, dict]
    feeds: dict[str, dict] = field(default_factory=dict)
    http: dict = field(default_factory=dict)
    site: dict = field(default_factory=dict)
    grades: list[dict] = field(default_factory=list)
    extra_ids: list[dict] = field(default_factory=list)
    watch: list[dict] = field(default_factory=list)
    links: list[dict] = field(default_factory=list)

    # ---- views ----

    def fetch_view(self) -> dict:
        """What requests are made of: everything but the interpretation keys."""
        keep = {c: {k: v for k, v in t.items() if k not in INTERPRETATION} for c, t in self.countries.items()}
        return {"countries": keep, "feeds": self.feeds, "http": self.http, "extra_ids": self.extra_ids}

    def interpretation_view(self) -> dict:
        keep = {c: {k: v for k, v in t.items() if k in INTERPRETATION} for c, t in self.countries.items()}
        floors = {f: {"floor": t["floor"]} for f, t in self.feeds.items() if "floor" in t}
        return {"countries": keep, "feeds": floors, "grades": self.grades, "watch": self.watch, "links": self.links}

    # ---- frames ----

    def dimensions(self, spark: SparkSession) -> Dimensions:
        """The interpretation tables that normalization joins; all of them small."""
        units = [(c, None, t["price_unit"]) for c, t in self.countries.items()] + [(c, r, u) for c, t in self.countries.items() for r, u in t.get("unit_overrides", {}).items()]
        bounds = {}
        for table in self.countries.values():
            for unit, b in table.get("bounds", {}).items():
                bounds[unit, None] = (float(b["min"]), float(b["max"]))
                for label, own in b.get("grades", {}).items():
                    bounds[unit, label] = (float(own["min"]), float(own["max"]))
        return Dimensions(
            frame(spark, self.grades, GRADES),
            spark.createDataFrame(units, "country string, region string, unit string"),
            spark.createDataFrame([(*k, *v) for k, v in bounds.items()], "unit string, grade_raw string, low double, high double"),
            frame(spark, self.watch, WATCH),
        )

    def zones(self, spark: SparkSession) -> DataFrame:
        rows = [(c, r, z) for c, t in self.countries.items() for r, z in t.get("timezones", {}).items()]
        return spark.createDataFrame(rows, "country string, region string, zone string")

    def extras(self, spark: SparkSession) -> DataFrame:
        return frame(spark, self.extra_ids, EXTRA_IDS)

    def station_links(self, spark: SparkSession) -> DataFrame:
        return frame(spark, self.links, LINKS)

    def thresholds(self) -> dict[str, int]:
        return {c: int(t["closed_after_days"]) for c, t in self.countries.items() if t.get("closed_after_days")}

    def disabled(self) -> set[str]:
        return {f for f, t in self.feeds.items() if t.get("enabled") is False}


def frame(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    """Rows of text as a frame; blank is null, numbers are cast."""
    to = {"string": str, "bigint": int, "double": float}
    cell = lambda r, f: to[f.dataType.simpleString()](r[f.name]) if r.get(f.name) not in (None, "") else None
    return spark.createDataFrame([tuple(cell(r, f) for f in schema) for r in rows], schema)


def _csv(path: Path, columns: list[str], required: bool) -> list[dict]:
    """A dimension as text, so that leading zeros stay; an optional file may be absent."""
    if not path.exists():
        if required:
            raise ConfigError(f"{path.name} is missing")
        return []
    with path.open(encoding="utf-8", newline="") as f:
        out = csv.DictReader(f)
        if missing := [c for c in columns if c not in (out.fieldnames or [])]:
            raise ConfigError(f"{path.name}: no column {', '.join(missing)}")
        return list(out)


def _toml(path: Path, required: bool = False) -> dict:
    if not path.exists():
        if required:
            raise ConfigError(f"{path.name} is missing")
        return {}
    try:
        return tomllib.loads(path.read_text(encoding="utf-8"))
    except tomllib.TOMLDecodeError as e:
        raise ConfigError(f"{path.name}: {e}") from None


def load(folder: str | Path) -> Config:
    """The configuration in a folder; raises ConfigError that lists every fault found."""
    at = Path(folder)
    cfg = Config(
        _toml(at / "countries.toml", True).get("countries", {}), _toml(at / "feeds.toml").get("feeds", {}), _toml(at / "http.toml"), _toml(at / "site.toml"),
        _csv(at / "grades.csv", ["brand", "country", "grade_raw", "grade", "priority"], True), _csv(at / "us_extra_ids.csv", EXTRA_IDS.names, False),
        _csv(at / "watch.csv", WATCH.names, False), _csv(at / "station_links.csv", ["old_station_key", "new_station_key"], False),
    )
    if found := list(faults(cfg)):
        raise ConfigError("; ".join(found))
    return cfg


def _is_date(text: str | None) -> bool:
    try:
        return bool(date.fromisoformat(text or ""))
    except ValueError:
        return False


def faults(cfg: Config) -> Iterator[str]:
    """Everything wrong with a configuration, place first."""
    zones = available_timezones()
    for code, t in cfg.countries.items():
        units = {t.get("price_unit"), *t.get("unit_overrides", {}).values()}
        for unit in sorted(map(str, units)):
            if unit not in CURRENCY_OF_UNIT:
                yield f"{code}: unknown unit {unit}"
            if unit not in t.get("bounds", {}):
                yield f"{code}: no bounds for {unit}"
        for unit, b in t.get("bounds", {}).items():
            for label, x in [("", b), *b.get("grades", {}).items()]:
                if not x["min"] < x["max"]:
                    yield f"{code}: bounds of {unit} {label} are empty".replace("  ", " ")
        for key in ("floor", "stale_after_days", "closed_after_days"):
            if t.get(key, 1) < 1:
                yield f"{code}: {key} must be at least 1"
        if not 1 <= t.get("batch_size", 1) <= ID_BATCH:
            yield f"{code}: batch_size must be from 1 to {ID_BATCH}"
        table = t.get("timezones", {})
        if not table:
            yield f"{code}: no timezones"
        yield from (f"{code}: region {r}: unknown zone {z}" for r, z in table.items() if z not in zones)
        yield from (f"{code}: no timezone for region {r}" for r in t.get("unit_overrides", {}) if r not in table)
    for feed, t in cfg.feeds.items():
        if t.get("floor", 1) < 1:
            yield f"{feed}: floor must be at least 1"
        if t.get("budget_s", 1) <= 0:
            yield f"{feed}: budget_s must be above 0"
    for r in cfg.grades:
        where = f"grades.csv: {r['country']} {r['grade_raw']}"
        if r["country"] not in cfg.countries:
            yield f"{where}: unknown country"
        if r["grade"] not in GRADE_NAMES:
            yield f"{where}: unknown grade {r['grade']}"
        if r.get("spec_source") not in (None, "", "source", "reported"):
            yield f"{where}: unknown spec_source"
        if r.get("spec_source") == "reported" and not r.get("spec_source_url"):
            yield f"{where}: a reported spec needs its url"
    for r in cfg.extra_ids:
        if not r["source_station_id"] or r["timezone"] not in zones:
            yield f"us_extra_ids.csv {r['source_station_id'] or '?'}: needs an id and a known zone"
    seen: set[tuple] = set()
    for r in cfg.watch:
        where, key = f"watch.csv {r['feed']} {r['source_station_id']}", (r["feed"], r["source_station_id"])
        match = re.fullmatch(r"([A-Z]{2})-[A-Z]+", r["feed"] or "")
        if not match or match[1] not in cfg.countries:
            yield f"{where}: not a feed of a configured country"
        if not r["source_station_id"] or key in seen:
            yield f"{where}: no id, or listed twice"
        seen.add(key)
        if r["status"] not in WATCH_STATUSES or not _is_date(r["detected"]):
            yield f"{where}: needs a known status and a detected date"
        if (r["status"] == "on") != _is_date(r["publish_from"]):
            yield f"{where}: publish_from goes with status on, and only with it"
    old = [r["old_station_key"] for r in cfg.links]
    yield from (f"station_links.csv: {k} is listed twice" for k in sorted({k for k in old if old.count(k) > 1}))
