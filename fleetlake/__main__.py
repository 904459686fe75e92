"""Run the layers as one job: ``spark-submit -m fleetlake`` or ``python -m fleetlake``."""

from __future__ import annotations

import argparse
from datetime import date

from fleetlake.model import FLEETS, Lake, Limits
from fleetlake.plans.pipeline import Pipeline
from fleetlake.session import build_session

STEPS = ("setup", "coverage", "raw", "trusted", "refined", "marts", "optimize")


def _month(text: str) -> date:
    return date.fromisoformat(f"{text}-01")


def _after(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fleetlake", description=__doc__)
    parser.add_argument("--landing", required=True, help="directory of <fleet>/ref_year=/...")
    parser.add_argument("--location", help="directory of the databases")
    parser.add_argument("--prefix", default="", help="put before every database name")
    parser.add_argument("--first", type=_month, default="2023-01", help="first month, YYYY-MM")
    parser.add_argument("--last", type=_month, default="2023-05", help="last month, YYYY-MM")
    parser.add_argument(
        "--months",
        nargs=2,
        metavar=("FROM", "TO"),
        help="file months that have changed, YYYY-MM; by default all",
    )
    parser.add_argument(
        "--steps", nargs="+", choices=STEPS, default=list(STEPS[:-1]), help="what to run"
    )
    return parser.parse_args(arguments)


def run(options: argparse.Namespace, spark) -> None:
    limits = Limits(options.first.isoformat(), _after(options.last).isoformat())
    lake = Lake(options.landing, options.prefix, options.location)
    pipeline = Pipeline(spark, lake, limits)
    months = options.months and tuple(options.months)
    per_fleet = {"raw": pipeline.load_raw, "trusted": pipeline.load_trusted}
    events = None

    def refined() -> None:
        # found before the fact changes; the steps after it follow them
        nonlocal events
        events = pipeline.touched_events(months) if months and pipeline.loaded() else None
        pipeline.load_fact(months, events)

    whole = {
        "setup": pipeline.setup,
        "coverage": lambda: pipeline.require_landed(options.first, options.last),
        "refined": refined,
        "marts": lambda: pipeline.load_marts(events),
        "optimize": lambda: pipeline.optimize(events),
    }
    for step in (s for s in STEPS if s in options.steps):
        if step in whole:
            whole[step]()
        else:
            for fleet in FLEETS:
                per_fleet[step](fleet, months)


if __name__ == "__main__":
    run(parse(), build_session())
