"""High watermarks for change data capture.

Both are global aggregates: partial ``max`` per task, one row to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import find_column
from landfall.functions.predicates import status_is


def high_watermark(audit: DataFrame, *, equals: dict[str, str] | None = None, status_col: str = "run_status",
                   status: str = "SUCCESS", value_col: str = "latest_update_dt",
                   alias: str = "latest_update_dt") -> DataFrame:
    """``SELECT MAX(value) FROM audit WHERE a = x AND ... AND upper(status) = 'SUCCESS'``
    as a one-row DataFrame (NULL when no row qualifies)."""
    conds = [F.col(k) == F.lit(v) for k, v in (equals or {}).items()] + [status_is(status_col, status)]
    return audit.where(reduce(lambda a, b: a & b, conds)).agg(F.max(value_col).alias(alias))


def column_max(df: DataFrame, name: str, alias: str = "latest_update_dt") -> DataFrame:
    """``MAX`` of a column named at run time, matched case-insensitively; a
    NULL row when the table has no such column."""
    actual = find_column(df.columns, name)
    if actual is None:
        return df.sparkSession.range(1).select(F.lit(None).cast("timestamp").alias(alias))
    return df.agg(F.max(F.col(f"`{actual}`")).alias(alias))


def high_watermark_sql(spark, audit_table: str, object_name: str, source_name: str,
                       alias: str = "latest_update_dt"):
    """The same watermark as SQL over a catalog table or view, with named
    parameters (values are never spliced into the statement text)."""
    if not alias.isidentifier():
        raise ValueError(f"bad alias {alias!r}")
    return spark.sql(
        f"SELECT MAX(latest_update_dt) AS {alias} FROM IDENTIFIER(:audit) "
        "WHERE object_name = :object_name AND source_name = :source_name AND upper(run_status) = 'SUCCESS'",
        args={"audit": audit_table, "object_name": object_name, "source_name": source_name})
