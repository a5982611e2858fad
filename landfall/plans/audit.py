"""Audit log of CDC runs and the run-status wrapper.

Every run appends exactly one row: SUCCESS with the new high watermark, or
FAILURE (and the error is re-raised).  The next run's watermark is the MAX of
``latest_update_dt`` over SUCCESS rows of the same object and source.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import last_path_segment
from landfall.functions.timestamps import elapsed_seconds_text, format_timestamp, seconds_text
from landfall.operators.watermark import high_watermark
from landfall.streaming.loads import write_batch
from landfall.tables import Table, conform

# ---- fixed values: the audit table's columns ---------------------------------
AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), True),
    T.StructField("object_id", T.IntegerType(), True),
    T.StructField("job_id", T.StringType(), True),
    T.StructField("object_name", T.StringType(), True),
    T.StructField("source_name", T.StringType(), True),
    T.StructField("job_name", T.StringType(), True),
    T.StructField("notebook_name", T.StringType(), True),
    T.StructField("latest_update_dt", T.TimestampType(), True),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("duration_sec", T.StringType(), True),
    T.StructField("run_status", T.StringType(), True),
    T.StructField("log_step", T.StringType(), True),
    T.StructField("audit_ts", T.TimestampType(), True),
])
# ------------------------------------------------------------------------------


def audit_rows(runs: DataFrame) -> DataFrame:
    """Shape run rows into audit rows: ``notebook_name`` is the last segment of
    a notebook path, ``duration_sec`` is the elapsed time as text."""
    df = runs
    if "notebook_path" in df.columns:
        df = df.withColumn("notebook_name", last_path_segment(F.col("notebook_path")))
    if "duration_sec" not in df.columns:
        df = df.withColumn("duration_sec", elapsed_seconds_text("start_time", "end_time"))
    if "audit_ts" not in df.columns:
        df = df.withColumn("audit_ts", F.current_timestamp())
    return conform(df, AUDIT_SCHEMA)


class AuditLog:
    """A catalog table with a part for each run: an append costs the same
    however many runs there were, and a run logged again replaces its rows."""

    def __init__(self, spark: SparkSession, location: str, name: str | None = None):
        self.spark = spark
        self.table = Table(spark, location, name)

    def append(self, rows: DataFrame, part: str | None = None) -> None:
        part = part or self.table.new_run("audit")
        write_batch(audit_rows(rows), self.table.path(part))
        self.table.publish_parts({part: self.table.path(part)}, AUDIT_SCHEMA)

    def read(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.table.read()

    def watermark(self, object_name: str, source_name: str) -> datetime | None:
        row = high_watermark(self.read(), equals={"object_name": object_name, "source_name": source_name}).first()
        return row[0] if row else None

    def watermark_text(self, object_name: str, source_name: str) -> str | None:
        """The watermark as the API's date-time text, formatted by Spark in the
        session time zone -- the zone its values were parsed in."""
        mark = high_watermark(self.read(), equals={"object_name": object_name, "source_name": source_name})
        return mark.select(format_timestamp("latest_update_dt").alias("mark")).first()["mark"]

    def log(self, **values) -> None:
        values.setdefault("audit_ts", datetime.now())
        start, end = values.get("start_time"), values.get("end_time")
        if "duration_sec" not in values:
            values["duration_sec"] = seconds_text((end - start) // timedelta(microseconds=1)) if start and end else None
        row = tuple(values.get(f.name) for f in AUDIT_SCHEMA.fields)
        run = values.get("run_id")
        self.append(self.spark.createDataFrame([row], AUDIT_SCHEMA), f"run-{run}" if run else None)


@dataclass
class RunContext:
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    start_time: datetime = field(default_factory=datetime.now)
    latest_update_dt: datetime | None = None
    log_step: str = "CDC_RUN"


@contextmanager
def audited_run(log: AuditLog, **identity):
    """Append SUCCESS (with ``ctx.latest_update_dt``) when the block ends, or
    FAILURE with the error text when it raises, then re-raise."""
    ctx = RunContext()
    try:
        yield ctx
    except Exception as exc:
        log.log(run_id=ctx.run_id, start_time=ctx.start_time, end_time=datetime.now(),
                latest_update_dt=None, run_status="FAILURE",
                log_step=f"{ctx.log_step}: {type(exc).__name__}: {exc}", **identity)
        raise
    log.log(run_id=ctx.run_id, start_time=ctx.start_time, end_time=datetime.now(),
            latest_update_dt=ctx.latest_update_dt, run_status="SUCCESS", log_step=ctx.log_step, **identity)
