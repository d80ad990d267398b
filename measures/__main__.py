"""Command line: `python -m measures <command> ...` (or the same via spark-submit).

  load    LANDING STORE [--rule faithful|exact] [--load-id ID] [--multiline]
  ingest  LANDING STORE --checkpoint DIR        process new files once (available-now)
  query   STORE NAME [--param k=v ...] [--out PATH]
          NAME: q1_raw q1_rollup q2_raw q2_rollup q3_raw q3_rollup q4 q5 q6 q7_raw q7_rollup
  read    STORE [--study S] [--participant P] [--type T] [--start D] [--end D] [--out PATH]
  job     STORE JOB_ID                          job record and status

Results go to `--out` as Parquet when given (nothing passes through the
driver at once); otherwise every row is printed, one JSON object a line.
"""

from __future__ import annotations

import argparse
import json
import sys

from measures.session import build_session


def _emit(df, out: str | None) -> None:
    if out:
        df.write.mode("overwrite").parquet(out)
        print(json.dumps({"written": out}))
    else:
        for line in df.toJSON().toLocalIterator():  # every row, a partition at a time
            print(line)


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import functions as F

    from measures.operators import ledger
    from measures.plans import loading, reads, sql
    from measures.sources.store import Store
    from measures.streaming import start_ingest

    p = argparse.ArgumentParser(prog="measures")
    p.add_argument("--master", default=None, help="Spark master (default: the launcher's)")
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="shuffle partitions before AQE coalescing (default: the launcher's)")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("landing"), a.add_argument("store")
    a.add_argument("--rule", default="faithful", choices=("faithful", "exact"))
    a.add_argument("--load-id"), a.add_argument("--multiline", action="store_true")
    a = sub.add_parser("ingest")
    a.add_argument("landing"), a.add_argument("store"), a.add_argument("--checkpoint", required=True)
    a = sub.add_parser("query")
    a.add_argument("store"), a.add_argument("name", choices=sorted(sql.STATEMENTS))
    a.add_argument("--param", action="append", default=[], help="k=v, e.g. study=STUDY001")
    a.add_argument("--out")
    a = sub.add_parser("read")
    a.add_argument("store")
    for flag in ("study", "participant", "type", "start", "end", "out"):
        a.add_argument(f"--{flag}")
    a = sub.add_parser("job")
    a.add_argument("store"), a.add_argument("job_id")
    args = p.parse_args(argv)

    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    store = Store(args.store)
    if args.cmd == "load":
        report = loading.run_load(spark, args.landing, store, load_id=args.load_id,
                                  rollup_rule=args.rule, multiline=args.multiline)
        for j in report.jobs.collect():
            print(json.dumps(j.asDict(), default=str))
    elif args.cmd == "ingest":
        start_ingest(spark, args.landing, store, args.checkpoint).awaitTermination()
    elif args.cmd == "query":
        sql.register_views(spark, store)
        params = dict(kv.split("=", 1) for kv in args.param)
        if "days" in params:
            params["days"] = int(params["days"])
        if "digits" in params:
            params["digits"] = int(params["digits"])
        _emit(sql.run(spark, args.name, **params), args.out)
    elif args.cmd == "read":
        _emit(reads.query_measurements(store.measurements(spark), api_layout=True,
                                       study_id=args.study, participant_id=args.participant,
                                       measurement_type=args.type, start_date=args.start,
                                       end_date=args.end), args.out)
    elif args.cmd == "job":
        events = store.jobs(spark)
        _emit(ledger.job_by_id(events, args.job_id, api_layout=True), None)
        _emit(ledger.job_status(events.where(F.col("job_id") == args.job_id)), None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
