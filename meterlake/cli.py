"""Command line: ``spark-submit -m meterlake.cli <command> [options]`` (or ``python -m meterlake.cli``).

Commands:

* ``transform``      daily Silver + Gold for ``--run-date`` (writes a run-log row)
* ``backfill``       ``--start-date``..``--end-date`` in one job (``--per-day`` for one job per day,
                     ``--continue-on-failure`` to keep going after a failed day)
* ``build-moments``  store the moments of all Bronze files anew, for ``--baseline-mode moments``
* ``qa``             the five checks for ``--run-date`` (``--strict`` exits 1 when a check is FAIL)
* ``insights``       the insight queries and the summary findings
* ``log-run``        write a run-log row for ``--run-date`` by itself (``--status``, ``--error``)
* ``sql``            ``--query TEXT`` or ``--sql-file PATH`` over the five registered tables; prints
                     ``--max-rows`` rows and says when there are more; ``--save-json PATH`` saves all
* ``source-profile`` row count of Bronze on ``--run-date``, its time range and schema
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

from meterlake.config import build_parser, load_config, parse_run_date
from meterlake.session import get_spark


def _tables(spark, cfg):
    from meterlake.sinks.writers import register_tables, table_catalog

    register_tables(spark, table_catalog(cfg))
    return (
        spark.table("silver_half_hourly_clean"),
        spark.table("gold_peak_demand_substation_day"),
        spark.table("gold_avg_load_profile_day"),
    )


def _print(df, n: int = 100) -> None:
    """The first ``n`` rows, and a line that says so when there are more."""
    rows = df.take(n + 1)
    for row in rows[:n]:
        print(json.dumps(row.asDict(recursive=True), default=str))
    if len(rows) > n:
        print(f"# first {n} rows of more")


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command; a session passed in is used and left running."""
    parser = build_parser("meterlake jobs")
    parser.add_argument("command", choices=["transform", "backfill", "build-moments", "qa", "insights", "log-run",
                                            "sql", "source-profile"])
    parser.add_argument("--per-day", action="store_true")
    parser.add_argument("--continue-on-failure", action="store_true")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--query")
    parser.add_argument("--sql-file")
    parser.add_argument("--max-rows", type=int, default=100)
    parser.add_argument("--save-json")
    parser.add_argument("--status", choices=["SUCCESS", "FAILED"], default="SUCCESS")
    parser.add_argument("--error", default="")
    args = parser.parse_args(argv)
    cfg = load_config(args)
    owns_session = spark is None
    spark = spark if spark is not None else get_spark(f"meterlake-{args.command}")

    from meterlake.plans import jobs
    from meterlake.sources.bronze import parquet_profile, read_bronze, source_date_profile

    if args.command == "transform":
        print(json.dumps(jobs.run_with_log(spark, cfg), default=str))
    elif args.command == "backfill":
        start = parse_run_date(args.start_date or str(cfg.run_date))
        end = parse_run_date(args.end_date or str(cfg.run_date))
        out = jobs.backfill_range(spark, cfg, start, end, per_day=args.per_day,
                                  continue_on_failure=args.continue_on_failure)
        print(json.dumps(out, default=str))
    elif args.command == "build-moments":
        jobs.build_moments(spark, cfg)
    elif args.command == "qa":
        from meterlake.plans import qa

        from meterlake.sinks.writers import partition_days

        silver, peak, profile = _tables(spark, cfg)
        days = partition_days(spark, cfg.silver_uri, "collection_date")
        statuses = qa.check_statuses(qa.run_checks(silver, peak, profile, cfg.run_date, days))
        for status in statuses:
            print(json.dumps(status, default=str))
        if args.strict:
            try:
                qa.assert_all_pass(statuses)
            except RuntimeError as exc:
                print(exc, file=sys.stderr)
                if owns_session:
                    spark.stop()
                return 1
    elif args.command == "insights":
        from meterlake.plans import insights

        _silver, peak, profile = _tables(spark, cfg)
        for name, df in insights.all_insights(peak, profile).items():
            print(name)
            _print(df, 500)
        for row in insights.findings_text(insights.insight_summary(peak, profile)).orderBy("finding_order").collect():
            print("-", row["line"])
    elif args.command == "log-run":
        print(json.dumps(jobs.log_run(spark, cfg, args.status, args.error), default=str))
    elif args.command == "sql":
        from meterlake.sinks.writers import export_json, run_sql

        _tables(spark, cfg)
        text = args.query or Path(args.sql_file).read_text(encoding="utf-8")
        params = {"run_date": cfg.run_date} if ":run_date" in text else None
        df = run_sql(spark, text, args=params)
        _print(df, args.max_rows)
        if args.save_json:
            export_json(df, args.save_json)
    elif args.command == "source-profile":
        bronze = read_bronze(spark, cfg.source_uri)
        _print(source_date_profile(bronze, cfg.run_date))
        _print(parquet_profile(bronze))
        print(bronze.schema.treeString())
    if owns_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
