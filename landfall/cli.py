"""Command-line job entry points.

    python -m landfall file-feed --config-table main.cfg.feeds --ref-id 3 --job csv
    python -m landfall api-cdc --config-table main.cfg.api_sources --object-name device \\
        --target /lake/device --audit /lake/audit --username-env API_USER --password-env API_PASS

The job parameters of the original jobs become arguments; credentials are
read from environment variables whose *names* are given, so they never appear
on a command line.  The session comes from ``getOrCreate`` (spark-submit's, or
a local one).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="landfall")
    sub = p.add_subparsers(dest="command", required=True)

    f = sub.add_parser("file-feed", help="load one drop folder described by a config row")
    f.add_argument("--config-table", required=True, help="catalog table with one row per feed")
    f.add_argument("--ref-id", required=True)
    f.add_argument("--job", required=True, choices=["csv", "tsv", "json_flat", "json_nested"])
    f.add_argument("--tables-root", help="folder holding the target tables (default: below spark.checkpoint.dir)")
    f.add_argument("--append", action="store_true", help="append instead of truncate-and-load")
    f.add_argument("--keep-on-empty", action="store_true", help="keep the table when no file arrived")
    f.add_argument("--no-overwrites", action="store_true", help="read each path once, even when its file is rewritten in place")

    a = sub.add_parser("api-cdc", help="paged API -> change-detecting merge with audit")
    a.add_argument("--config-table", required=True)
    a.add_argument("--object-name", required=True)
    a.add_argument("--target", required=True, help="merge table location")
    a.add_argument("--audit", required=True, help="audit log location")
    a.add_argument("--jobs-table", help="table of jobs with a tags map")
    a.add_argument("--notebook-name")
    a.add_argument("--initial-watermark", help="MM/dd/yyyy[ HH:mm:ss] for the first run")
    a.add_argument("--username-env")
    a.add_argument("--password-env")
    a.add_argument("--pages-path", help="replay captured pages from this folder instead of HTTP")
    a.add_argument("--partitions", type=int, default=4)
    a.add_argument("--rows-per-part", type=int, help="rows of a part of the target, the unit that a merge rewrites")
    a.add_argument("--time-zone", help="zone of the API's date-time texts (default: the session's)")
    a.add_argument("--job-tag", action="append", default=[], metavar="KEY=VALUE", help="tag of the job's row in the jobs table")
    a.add_argument("--table-name", help="the target's schema.table in the catalog")
    a.add_argument("--audit-name", help="the audit log's schema.table in the catalog")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.command == "file-feed":
        from landfall.plans.file_jobs import run_feed

        res = run_feed(spark, args.config_table, args.ref_id, args.job, tables_root=args.tables_root,
                       replace=not args.append, empty_run="keep" if args.keep_on_empty else "clear",
                       allow_overwrites=not args.no_overwrites)
        out = {"run": res.run, "batches": res.batches, "published": res.published}
    else:
        from landfall.plans.api_job import run_api_cdc

        if args.pages_path:
            transport = {"transport": "files", "path": args.pages_path}
        else:
            transport = {"transport": "http"}
            if args.username_env:
                transport["username"] = os.environ[args.username_env]
                transport["password"] = os.environ.get(args.password_env or "", "")
        res = run_api_cdc(spark, args.config_table, args.object_name, target=args.target, audit=args.audit,
                          transport=transport, jobs=args.jobs_table, notebook_name=args.notebook_name,
                          initial_watermark=args.initial_watermark, rows_per_part=args.rows_per_part,
                          num_partitions=args.partitions, time_zone=args.time_zone, table_name=args.table_name, audit_name=args.audit_name,
                          job_tags=dict(t.split("=", 1) for t in args.job_tag))
        out = {k: (str(v) if v is not None else None) for k, v in res.items()}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
