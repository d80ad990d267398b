"""Print the physical plans of the main queries over stored, partitioned tables.

Loads the adapter's measurements through the full load path (as the
registered `etl_*` queries do) and prints, per query, the lines of
`explain("formatted")` that matter for scale: exchanges, aggregates, joins,
sorts, scans (partition filters, pushed filters, read schema).

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from measures.operators import rollup  # noqa: E402
from measures.operators.constraints import stored_ids_for  # noqa: E402
from measures.plans import analytics, catalog, reads  # noqa: E402
from measures.session import build_session  # noqa: E402

KEEP = ("Exchange", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Join",
        "TakeOrderedAndProject", "Sort ", "Window", "PartitionFilters", "PushedFilters",
        "ReadSchema", "BroadcastExchange", "Scan parquet")


def summary(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    details = [ln.strip() for ln in text.splitlines()
               if ln.strip().startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))]
    return tree + "\n" + "\n".join(details)


def main(sf_dir: str) -> None:
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    store = catalog.loaded_store(spark, sf_dir)
    facts, roll = store.measurements(spark), store.rollup(spark)
    plans = {
        "R1 filtered read, newest 1000": reads.query_measurements(
            facts, study_id="STUDY001", measurement_type="glucose", start_date="2024-01-10",
            end_date="2024-01-20"),
        "Q1 raw": analytics.quality_by_study(facts),
        "Q2 roll-up": analytics.daily_trend_rollup(roll, "P0001", "glucose"),
        "Q5 recent": analytics.recent_measurements(facts, 7, "2024-01-31"),
        "Q7 raw": analytics.mean_bmi(facts, "STUDY001"),
        "A1 daily roll-up": rollup.daily_rollup(facts),
        "A5 merge of a batch into the stored roll-up": rollup.merge_faithful(
            roll, rollup.daily_rollup(facts)),
        "V6 stored ids in reach of a batch": stored_ids_for(
            facts, {"STUDY002": (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))}),
    }
    for name, df in plans.items():
        print(f"### {name}\n```\n{summary(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
