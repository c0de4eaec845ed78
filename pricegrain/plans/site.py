"""The dashboard's outputs: summary, history, nested latest, stations and a small description."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grain, summary
from ..operators.constants import DASHBOARD_STALE_HOURS
from ..schemas import HISTORIES, SUMMARIES
from ..sources.writers import write_json, write_parquet

STATION_JSON = ("station_key", "country", "brand", "name", "name_local", "address", "city", "region", "postcode", "lat", "lon", "timezone", "status", "first_seen_utc", "last_seen_utc", "superseded_by", "alt_id", "source_station_id")
HISTORY_ROWS = 20_000


def visible_feeds(statuses: DataFrame, disabled: DataFrame) -> DataFrame:
    """Feeds to list: neither skipped by the capture nor switched off."""
    return statuses.where("status <> 'skipped'").join(disabled.select("feed"), "feed", "left_anti").orderBy("feed")


def grade_table(grades: DataFrame, rows: DataFrame) -> DataFrame:
    """The labels of chains that occur in the rows."""
    return grades.join(rows.select("country", "brand").distinct(), ["country", "brand"], "left_semi").orderBy("country", "brand", "grade_raw")


def write_lines(df: DataFrame, path: Path) -> None:
    """A JSON array of rows, streamed a partition at a time."""
    with path.open("w", encoding="utf-8") as out:
        out.write("[")
        for i, row in enumerate(df.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "ignoreNullFields": "false"}).alias("j")).toLocalIterator()):
            out.write(("," if i else "") + row["j"])
        out.write("]\n")


def build(spark: SparkSession, daily: DataFrame, latest: DataFrame, stations: DataFrame, priorities: DataFrame, out: str, generated_at: str) -> None:
    """All outputs under ``out``: two Parquet tables and three JSON files."""
    rows = grain.dedupe_daily(daily, priorities)
    folder = Path(out)
    folder.mkdir(parents=True, exist_ok=True)
    write_parquet(summary.summary_daily(rows, check=True), f"{out}/summary_daily", list(SUMMARIES.order))
    write_parquet(summary.history(rows), f"{out}/history", list(HISTORIES.order), rows_per_file=HISTORY_ROWS)
    write_lines(summary.latest_nested(latest, stations).orderBy("station_key"), folder / "latest.json")
    write_lines(stations.select(*STATION_JSON).orderBy("station_key"), folder / "stations.json")
    span = rows.agg(F.min("capture_date").alias("first"), F.max("capture_date").alias("last"), F.count_distinct("station_key").alias("n")).first()
    write_json(folder / "meta.json", {"generated_at_utc": generated_at, "stale_after_hours": DASHBOARD_STALE_HOURS, "first_date": span["first"], "last_date": span["last"], "stations": span["n"]})
