"""Writers: validated, rounded, sorted and byte-deterministic files; staged and verified replacement."""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import json
import os
import shutil
import tarfile
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampType

from ..operators.validate import prepared
from ..schemas import HELD_ROWS, ROWS, Table


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the text that files hold: ISO dates, instants with ``Z``, shortest doubles."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, TimestampType):
            out.append(F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f.name))
        elif isinstance(f.dataType, DateType):
            out.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, DoubleType):
            out.append(F.regexp_replace(F.col(f.name).cast("string"), r"(?<=\d)E", "e").alias(f.name))
        else:
            out.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(out)


def write_csv(df: DataFrame, path: str | Path, table: Table, check: bool = True) -> int:
    """One CSV file of a table, gzip by suffix, with the same bytes for the same rows; returns its rows.

    Published files hold one capture or one day. Rows stream to the driver in order, a partition at a
    time; for larger outputs use ``write_parquet``.
    """
    rows = as_text(prepared(df, table, check))
    n, raw = 0, io.TextIOWrapper(buffer := io.BytesIO(), encoding="utf-8", newline="")
    out = csv.writer(raw, lineterminator="\n")
    out.writerow(rows.columns)
    for n, row in enumerate(rows.toLocalIterator(), 1):
        out.writerow(["" if v is None else v for v in row])
    raw.flush()
    data = buffer.getvalue()
    if str(path).endswith(".gz"):
        packed = io.BytesIO()
        with gzip.GzipFile(filename="", mode="wb", fileobj=packed, mtime=0) as zipped:
            zipped.write(data)
        data = packed.getvalue()
    Path(path).write_bytes(data)
    return n


def write_rows(df: DataFrame, path) -> int:
    return write_csv(df, path, ROWS)


def write_held(df: DataFrame, path) -> int:
    return write_csv(df, path, HELD_ROWS)


def write_parquet(df: DataFrame, path: str, sort_by: list[str], partition_by: list[str] | None = None, rows_per_file: int | None = None) -> None:
    """Sorted Parquet with zstd and statistics; distributed, and partitions replaced one by one where given."""
    if missing := [c for c in sort_by if c not in df.columns]:
        raise ValueError(f"sort columns missing: {missing}")
    if partition_by:
        out = df.repartition(*partition_by).sortWithinPartitions(*partition_by, *sort_by).write.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    else:
        out = df.orderBy(*sort_by).write
    if rows_per_file:
        out = out.option("maxRecordsPerFile", rows_per_file)
    out.option("compression", "zstd").mode("overwrite").parquet(path)


def _plain(value):
    if isinstance(value, datetime):
        return (value.astimezone(UTC) if value.tzinfo else value).strftime("%Y-%m-%dT%H:%M:%SZ")
    if isinstance(value, date):
        return value.isoformat()
    raise TypeError(type(value).__name__)


def write_json(path: str | Path, payload) -> None:
    """Compact UTF-8 with ISO dates and a newline at the end."""
    Path(path).write_text(json.dumps(payload, ensure_ascii=False, separators=(",", ":"), default=_plain) + "\n", encoding="utf-8")


def write_bundle(path: str | Path, members: dict[str, bytes]) -> str:
    """A deterministic tar.gz of the members in order; returns its SHA-256."""
    packed = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", fileobj=packed, mtime=0) as zipped, tarfile.open(fileobj=zipped, mode="w") as tar:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
    Path(path).write_bytes(packed.getvalue())
    return hashlib.sha256(packed.getvalue()).hexdigest()


def append_watch(path: str | Path, candidates: list[dict], columns: list[str], day: str) -> int:
    """``hold`` rows for new candidates at the end of the watch list; bytes already there stay as they are."""
    path = Path(path)
    old = path.read_bytes().decode("utf-8") if path.exists() else ",".join(columns) + "\n"
    known = {(r["feed"], r["source_station_id"]) for r in csv.DictReader(io.StringIO(old, newline=""))}
    new = [c for c in candidates if (c["feed"], str(c["source_station_id"])) not in known]
    tail = io.StringIO(newline="")
    out = csv.DictWriter(tail, columns, restval="", extrasaction="ignore", lineterminator="\n")
    out.writerows({**c, "detected": day, "status": "hold"} for c in new)
    path.write_bytes((old + ("" if old.endswith("\n") else "\n") + tail.getvalue()).encode("utf-8"))
    return len(new)


class AssetStore:
    """Named assets in release folders, replaced by stage, verify and rename.

    A file is staged as ``.next-<token>``, verified by size and SHA-256, the live one set aside as
    ``.old-<token>``, the staged one promoted and the old one removed. ``recover`` finishes or unwinds what a
    crash left between these steps.
    """

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def folder(self, tag: str) -> Path:
        out = self.root / tag
        out.mkdir(parents=True, exist_ok=True)
        return out

    def list_assets(self, tag: str) -> list[str]:
        return sorted(p.name for p in self.folder(tag).iterdir() if p.is_file())

    def tags(self) -> list[str]:
        return sorted(p.name for p in self.root.iterdir() if p.is_dir()) if self.root.exists() else []

    def path(self, tag: str, name: str) -> Path:
        return self.folder(tag) / name

    def read(self, tag: str, name: str) -> bytes | None:
        """The live asset, or the one set aside if a replacement was cut short."""
        if (p := self.path(tag, name)).exists():
            return p.read_bytes()
        old = [x for x in self.list_assets(tag) if x.startswith(f"{name}.old-")]
        return self.path(tag, old[-1]).read_bytes() if old else None

    def read_json(self, tag: str, name: str):
        raw = self.read(tag, name)
        return None if raw is None else json.loads(raw)

    def put_if_absent(self, tag: str, name: str, source: str | Path) -> str:
        """Idempotent upload: the same content again is fine, other content under the name raises."""
        data = Path(source).read_bytes()
        digest = hashlib.sha256(data).hexdigest()
        there = self.read(tag, name)
        if there is None:
            self.replace(tag, name, source, digest[:12])
        elif hashlib.sha256(there).hexdigest() != digest:
            raise FileExistsError(f"{tag}/{name} has other content")
        return digest

    def replace(self, tag: str, name: str, source: str | Path, token: str) -> str:
        staged, live, old = self.path(tag, f"{name}.next-{token}"), self.path(tag, name), self.path(tag, f"{name}.old-{token}")
        data = Path(source).read_bytes()
        digest = hashlib.sha256(data).hexdigest()
        shutil.copyfile(source, staged)
        written = staged.read_bytes()
        if len(written) != len(data) or hashlib.sha256(written).hexdigest() != digest:
            staged.unlink()
            raise OSError(f"{tag}/{name}: the staged copy differs")
        if live.exists():
            os.replace(live, old)
        try:
            os.replace(staged, live)
        except OSError:
            if old.exists():
                os.replace(old, live)
            raise
        old.unlink(missing_ok=True)
        return digest

    def recover(self, tag: str) -> list[str]:
        """Finish or unwind replacements that were cut short; returns the names that were touched."""
        names = self.list_assets(tag)
        touched = sorted({x.split(".next-")[0].split(".old-")[0] for x in names if ".next-" in x or ".old-" in x})
        for name in touched:
            live = self.path(tag, name)
            newest = lambda mark: max((self.path(tag, x) for x in names if x.startswith(f"{name}.{mark}-")), key=lambda p: p.stat().st_mtime, default=None)  # noqa: E731, B023
            staged, old = newest("next"), newest("old")
            if not live.exists():
                source = old if old is not None else staged
                os.replace(source, live)
            for x in names:
                if x.startswith((f"{name}.next-", f"{name}.old-")):
                    self.path(tag, x).unlink(missing_ok=True)
        return touched

    def delete(self, tag: str, name: str) -> None:
        self.path(tag, name).unlink(missing_ok=True)
