"""landfall: incremental file and paged-API ingestion on Spark.

The engine loads drop folders of CSV, tab-delimited and JSON files as
run-to-completion streams, flattens nested records, publishes every run as a
snapshot (or an append), reads paged REST sources in parallel, upserts with
null-safe change detection and keeps a high watermark plus an audit log.
Everything is expressed with the DataFrame, SQL, Structured Streaming and
Python data source APIs over parquet.
"""

from landfall.session import build_session, workspace

__all__ = [
    "build_session", "workspace",
    "FileSource", "FileFeedJob", "feed_job", "run_feed",
    "run_api_cdc", "api_frame",
    "merge_into", "merge_frames", "latest_per_key", "duplicate_keys", "changed_rows",
    "Table", "AuditLog",
]


def __getattr__(name):
    # lazy, so importing the package does not pull every module in
    if name in ("FileSource",):
        from landfall.sources.files import FileSource
        return FileSource
    if name in ("FileFeedJob", "feed_job", "run_feed"):
        from landfall.plans import file_jobs
        return getattr(file_jobs, name)
    if name in ("run_api_cdc", "api_frame"):
        from landfall.plans import api_job
        return getattr(api_job, name)
    if name in ("merge_into", "merge_frames", "latest_per_key", "duplicate_keys", "changed_rows"):
        from landfall.operators import merge
        return getattr(merge, name)
    if name == "Table":
        from landfall.tables import Table
        return Table
    if name == "AuditLog":
        from landfall.plans.audit import AuditLog
        return AuditLog
    raise AttributeError(name)
