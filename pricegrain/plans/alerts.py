"""Alert rules: a table of feed statuses in, a table of actions out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.constants import CAPTURE_FAILURES, PUBLISH_FAILURES


def feed_actions(statuses: DataFrame) -> DataFrame:
    """(action, title, body): open after enough failures in a row, close on any success, skip says nothing."""
    action = F.when((F.col("status") == "failed") & (F.col("consecutive_failures") >= CAPTURE_FAILURES), "open").when(F.col("status").isin("ok", "degraded"), "close")
    body = F.format_string("%s: %s, %s failures in a row, last success %s", "feed", "status", F.col("consecutive_failures").cast("string"), F.coalesce("last_success_capture_id", F.lit("none recorded")))
    return statuses.select(action.alias("action"), F.concat(F.lit("Capture failing: "), "feed").alias("title"), body.alias("body")).where("action IS NOT NULL")


def grade_actions(warnings: DataFrame, statuses: DataFrame) -> DataFrame:
    """One issue for each unknown label of a feed that ran."""
    ran = statuses.where("status <> 'skipped'").select("feed")
    labels = warnings.where((F.col("code") == "unknown_grade") & (F.trim("detail") != "")).select("feed", F.trim("detail").alias("label")).distinct().join(ran, "feed", "left_semi")
    title = F.concat_ws(" ", F.lit("Unknown grade:"), "feed", "label")
    return labels.select(F.lit("open").alias("action"), title.alias("title"), F.concat(F.lit("Map it in the grade table: "), "label").alias("body"))


@dataclass
class Run:
    """What a run reports of itself."""

    publish_outcome: str | None = None
    publish_failures: int = 0
    unpublished: list[str] = field(default_factory=list)
    close_outcome: str | None = None
    close_reasons: list[str] = field(default_factory=list)
    locator_status: int | None = None


def run_actions(run: Run) -> list[tuple[str, str, str]]:
    out = []
    if run.publish_failures >= PUBLISH_FAILURES or run.unpublished:
        out.append(("open", "Publish failing", f"{run.publish_failures} failures in a row; unpublished: {', '.join(run.unpublished) or 'none'}"))
    elif run.publish_outcome == "success":
        out.append(("close", "Publish failing", "published"))
    if run.close_outcome == "failure" or run.close_reasons:
        out.append(("open", "Period close blocked", "; ".join(run.close_reasons)))
    elif run.close_outcome == "success":
        out.append(("close", "Period close blocked", "closed"))
    if run.locator_status == 401:
        out.append(("open", "Locator identifier rejected", "the locator answered 401"))
    elif run.locator_status == 200:
        out.append(("close", "Locator identifier rejected", "the locator answered 200"))
    return out


class Issues:
    """Issues by title: opening again refreshes, closing what isn't open does nothing. Records its actions."""

    def __init__(self, dry: bool = False):
        self.open: dict[str, str] = {}
        self.log: list[tuple[str, str]] = []
        self.dry = dry

    def ensure_open(self, title: str, body: str) -> None:
        self.log.append(("refresh" if title in self.open else "open", title))
        if not self.dry:
            self.open[title] = body

    def close(self, title: str) -> None:
        if title in self.open:
            self.log.append(("close", title))
            if not self.dry:
                del self.open[title]

    def apply(self, actions) -> None:
        for action, title, body in actions:
            if action == "open":
                self.ensure_open(title, body)
            else:
                self.close(title)
