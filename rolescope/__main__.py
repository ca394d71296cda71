"""Run a job on the incident table: ``python -m rolescope <job> --help``."""

from __future__ import annotations

import argparse

from rolescope.plans import jobs
from rolescope.presets import incidents
from rolescope.session import get_session
from rolescope.sources import tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rolescope")
    parser.add_argument("job", choices=("ingest", "profile", "anomalies", "analytics", "train",
                                        "score"))
    parser.add_argument("--input", required=True, help="CSV for ingest, Parquet otherwise")
    parser.add_argument("--output", required=True)
    parser.add_argument("--expected-rows", type=int, help="ingest: rows the CSV must have")
    parser.add_argument("--model", help="score: a saved pipeline")
    args = parser.parse_args(argv)
    spark, p = get_session(), incidents
    if args.job == "ingest":
        jobs.ingest(spark, args.input, args.output, p.SCHEMA, expected_rows=args.expected_rows)
        return
    df = tables.read_parquet(spark, args.input)
    if args.job == "profile":
        jobs.write_all(jobs.profile_reports(df, p.REPORT, p.PROFILED, p.TEXT, p.RANGED),
                       args.output)
    elif args.job == "anomalies":
        jobs.write_all(jobs.anomaly_reports(df, p.LADDER, p.PAIRS, p.EXTREMES, p.CONTEXT),
                       args.output)
    elif args.job == "analytics":
        jobs.analytics(df, p.REPORT, p.BUCKETS, p.FOCUS_FLAGS, args.output)
    elif args.job == "train":
        jobs.training(df, p.MODEL, p.REPORT.id, args.output)
    else:
        if not args.model:
            parser.error("score needs --model")
        jobs.scoring(df, args.model, p.MODEL, p.REPORT.id, args.output, p.DESCRIPTIONS)


if __name__ == "__main__":
    main()
