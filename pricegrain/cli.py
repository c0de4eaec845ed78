"""Command line over stored captures: publish, close-periods, rebuild, discover, alerts, site-data.

Collecting feeds is a network job outside Spark; captures arrive as folders of rows.csv, stations.csv and
status.json.
"""

from __future__ import annotations

import argparse
import json
import re
from datetime import UTC, datetime
from pathlib import Path

from .operators import grain
from .plans import alerts, discover, site
from .plans.history import Capture, History
from .schemas import FX, GRADES, LINKS, ROW, STATION, WATCH
from .session import session
from .sources.readers import read_csv, read_optional_csv
from .sources.writers import append_watch


def load_capture(spark, folder: str) -> Capture:
    """A capture folder as a Capture: rows.csv(.gz), stations.csv, fx.csv if there are rates; its id is in status.json."""
    path = Path(folder)
    status = json.loads((path / "status.json").read_text(encoding="utf-8"))
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}T\d{4}Z", status["capture_id"]):
        raise ValueError(f"capture id {status['capture_id']!r}")
    rows = next(p for p in (path / "rows.csv.gz", path / "rows.csv") if p.exists())
    rates = read_csv(spark, str(path / "fx.csv"), FX) if (path / "fx.csv").exists() else None
    return Capture(status["capture_id"], read_csv(spark, str(rows), ROW), read_csv(spark, str(path / "stations.csv"), STATION), rates, status.get("feeds", {}))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="pricegrain")
    out.add_argument("--root", required=True, help="folder of the history")
    out.add_argument("--config", help="folder of grades.csv, links.csv and watch.csv")
    verbs = out.add_subparsers(dest="verb", required=True)
    for name in ("publish", "rebuild"):
        verbs.add_parser(name).add_argument("captures", nargs="+")
    close = verbs.add_parser("close-periods")
    close.add_argument("--through", help="last month to close, YYYY-MM; the month before now if not given")
    verbs.add_parser("site-data").add_argument("out")
    verbs.add_parser("alerts").add_argument("status")
    found = verbs.add_parser("discover")
    found.add_argument("prices", help="CSV of id, regular, premium")
    found.add_argument("watch")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    dimension = lambda name, schema: read_optional_csv(spark, f"{args.config or '.'}/{name}", schema)
    history = History(spark, args.root, dimension("links.csv", LINKS))
    if args.verb == "publish":
        for folder in args.captures:
            print(json.dumps(history.merge(load_capture(spark, folder))))
    elif args.verb == "rebuild":
        print(json.dumps(history.rebuild_from([load_capture(spark, f) for f in args.captures])))
        history.rebuild_current()
    elif args.verb == "close-periods":
        through = args.through or datetime.now(UTC).strftime("%Y-%m")
        months = [t.removeprefix("data-") for t in history.store.tags() if t.startswith("data-")]
        reasons = [r for m in months if (m <= through if args.through else m < through) and not history.manifest(m)["closed"] for r in history.close_month(m)]
        for year in sorted({m[:4] for m in months}):
            history.close_year(year)
        print("\n".join(reasons))
        return int(bool(reasons))
    elif args.verb == "site-data":
        daily = grain.daily_grain(history.captures())
        priorities = dimension("grades.csv", GRADES)
        site.build(spark, daily, history.table("latest", ROW), history.table("stations", STATION), priorities, args.out, datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    elif args.verb == "alerts":
        blocks = json.loads(Path(args.status).read_text(encoding="utf-8"))["feeds"]
        statuses = spark.createDataFrame([(f, b["status"], int(b.get("consecutive_failures") or 0), b.get("last_success_capture_id")) for f, b in blocks.items()], "feed string, status string, consecutive_failures int, last_success_capture_id string")
        issues = alerts.Issues(dry=True)
        issues.apply(alerts.feed_actions(statuses).orderBy("title").collect())
        print("\n".join(f"{a}: {t}" for a, t in issues.log))
    elif args.verb == "discover":
        prices = spark.read.option("header", True).csv(args.prices).selectExpr("try_cast(id AS long) AS id", "try_cast(regular AS double) AS regular", "try_cast(premium AS double) AS premium")
        ids = lambda df: df.selectExpr("try_cast(source_station_id AS long) AS id")
        found = discover.reports(prices, ids(history.table("stations", STATION).where("brand = 'COSTCO' AND country = 'US'")), ids(dimension("watch.csv", WATCH)))
        print(append_watch(args.watch, discover.to_watch(found, "US-COSTCO"), WATCH.names, datetime.now(UTC).date().isoformat()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
