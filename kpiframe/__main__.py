"""``python -m kpiframe --tables DIR --as-of DATE --out PATH``: build and write the monthly report."""

from __future__ import annotations

import argparse

from kpiframe.functions.period import Period
from kpiframe.monthly import MonthlyReport
from kpiframe.session import cluster_builder, ensure_checkpoint_dir, local_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="kpiframe", description=__doc__)
    ap.add_argument("--tables", required=True, help="directory with the source Parquet tables")
    ap.add_argument("--as-of", required=True, help="report date; the KPI period is the month before it")
    ap.add_argument("--traffic-as-of", help="as-of date for traffic metrics (default: --as-of)")
    ap.add_argument("--traffic-unit", default="month", choices=["month", "week", "day"])
    ap.add_argument("--out", required=True, help="output path (Parquet, partitioned by report_month)")
    ap.add_argument("--by", nargs="*", default=[], choices=["nation", "regional"], help="one report for each of these")
    ap.add_argument("--counters", help="path of the stored daily counters, extended by the days they lack")
    ap.add_argument("--bucketed", help="prefix of stored tables, see kpiframe.sources.layout")
    ap.add_argument("--no-strict", action="store_true", help="write even if a placeholder has no value")
    ap.add_argument("--master", help="Spark master for a local run, e.g. local[8]; omit under spark-submit")
    ap.add_argument("--checkpoint-dir", help="shared checkpoint directory, used only if the session has none")
    args = ap.parse_args(argv)
    if args.master:
        spark = local_session(args.master.removeprefix("local[").removesuffix("]"))
    else:
        spark = cluster_builder("kpiframe-monthly").getOrCreate()
    if args.checkpoint_dir:
        ensure_checkpoint_dir(spark, args.checkpoint_dir)
    rep = MonthlyReport(spark, args.tables, Period(args.as_of, "month"),
                        Period(args.traffic_as_of or args.as_of, args.traffic_unit), by=args.by,
                        counters=args.counters, bucketed=args.bucketed)
    rep.run(args.out, strict=not args.no_strict)


if __name__ == "__main__":
    main()
