"""Command: ``python -m clicklens <input> [--output-dir DIR] [--run-date YYYY-MM-DD]``.

Writes ``<date>_SearchKeywordPerformance.tab`` into the output folder (default:
the current folder) and prints the number of report rows. Under spark-submit
it uses the cluster's session; alone, a local one. The job's argument names
``--input_path``/``--output_path`` and a JSON payload holding them
(``--execution-input FILE``) are accepted as well.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):  # run as a file, e.g. spark-submit clicklens/cli.py
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clicklens", description="Revenue by search engine and keyword")
    parser.add_argument("input", nargs="?", help="hit TSV file or folder (any Hadoop path)")
    parser.add_argument("--input_path", "--input-path", dest="input_path", default=None)
    parser.add_argument("--output-dir", "--output_path", dest="output_dir", default=None)
    parser.add_argument("--execution-input", default=None, help="JSON with input_path and output_path")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, default=None)
    parser.add_argument("--table", default=None, help="also keep the report in this run-date table")
    parser.add_argument("--multi-line", action="store_true", help="quoted fields may hold newlines")
    parser.add_argument("--by-input", action="store_true", help="table keeps one report per input file")
    parser.add_argument("--hosts", default=None, help="comma-separated search hosts (default: the built-in list)")
    parser.add_argument("--params", default=None, help="comma-separated keyword parameters, in priority order")
    parser.add_argument("--purchase-event", default=None, help="event code of a purchase")
    try:
        args = parser.parse_args(argv)
    except SystemExit as exc:
        return int(exc.code or 1)
    payload = {}
    if args.execution_input:
        with open(args.execution_input, encoding="utf-8") as f:
            payload = json.load(f)
    args.input = args.input or args.input_path or payload.get("input_path")
    args.output_dir = args.output_dir or payload.get("output_path") or os.getcwd()
    if not args.input:
        parser.print_usage(sys.stderr)
        return 1

    from pyspark.sql import SparkSession

    from clicklens.plans import SearchKeywordJob
    from clicklens.session import local_session
    from clicklens.sinks.files import matching

    spark = SparkSession.getActiveSession()
    if spark is None:
        # Under spark-submit the JVM is already up with the submitted
        # configuration (master included) and hands its gateway to Python;
        # run alone, the command uses a local session.
        submitted = "PYSPARK_GATEWAY_PORT" in os.environ
        spark = SparkSession.builder.getOrCreate() if submitted else local_session()
    # Asked of the input's own file system, so that globs and remote paths count.
    if not matching(spark, args.input):
        print(f"clicklens: nothing to read at {args.input}", file=sys.stderr)
        return 1
    lists = {}
    if args.hosts:
        lists["hosts"] = tuple(h.strip() for h in args.hosts.split(",") if h.strip())
    if args.params:
        lists["params"] = tuple(p.strip() for p in args.params.split(",") if p.strip())
    if args.purchase_event:
        lists["purchase_event"] = args.purchase_event
    job = SearchKeywordJob(
        input_path=args.input,
        output_prefix=args.output_dir,
        run_date=args.run_date,
        table_path=args.table,
        multi_line=args.multi_line,
        by_input=args.by_input,
        **lists,
    )
    result = job.run(spark)
    print(f"{result.rows} report rows in {result.output_file} (master {spark.sparkContext.master})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
