"""spark-submit entry point: landed files of a range of days to the warehouse.

    spark-submit --py-files barweave.zip run_days.py ROOT FIRST [LAST] [options]
    spark-submit --py-files barweave.zip run_days.py ROOT --changed [options]

ROOT is the URI that holds ``raw/``; days are ``yyyy-MM-dd``. Without ``--step`` all
steps run for all subjects; with it, one step of the given subjects. With ``--changed`` the days run
that have files which are new or have changed since they ran with it.
"""

from __future__ import annotations

import argparse

from barweave.plans import daily, landed_files
from barweave.plans.layout import Layout
from barweave.schemas import SUBJECTS
from barweave.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("root")
    parser.add_argument("first", nargs="?")
    parser.add_argument("last", nargs="?")
    parser.add_argument("--subject", action="append", choices=sorted(SUBJECTS))
    parser.add_argument("--step", choices=("ingest", "aggregate", "load"))
    parser.add_argument("--charset", default="utf-8", help="of index and trade files")
    parser.add_argument("--changed", action="store_true")
    options = parser.parse_args(arguments)
    if options.changed == bool(options.first) or (options.changed and options.step):
        parser.error("give either a range of days or --changed alone")

    spark = build_session("barweave")
    layout = Layout(options.root.rstrip("/"))
    subjects = options.subject or list(SUBJECTS)
    if options.changed:
        days = landed_files.run_changed(spark, layout, subjects, options.charset)
        print(f"{len(days)} days with new or changed files")
        return
    first, last = options.first, options.last or options.first
    if options.step is None:
        days = daily.run_days(spark, layout, first, last, subjects, options.charset)
        print(f"{len(days)} trading days from {first} to {last}")
        for subject, counts in days.counts.items():
            print(subject, *(f"{name}={n}" for name, n in counts.items()))
        return
    days = daily.open_days(spark, layout, first, last)
    for subject in subjects if days else ():
        if options.step == "ingest":
            daily.ingest(spark, layout, subject, days, options.charset)
        elif options.step == "aggregate":
            daily.aggregate(spark, layout, subject, first, last)
        else:
            left_out = daily.load(spark, layout, subject, days)
            if left_out:
                raise SystemExit(f"{subject} not loaded: {left_out}")


if __name__ == "__main__":
    main()
