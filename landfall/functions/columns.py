"""Column renames, drops, stamps and case-insensitive lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_column(columns: list[str], name: str) -> str | None:
    """Actual name of ``name`` among ``columns``, compared case-insensitively."""
    low = name.lower()
    return next((c for c in columns if c.lower() == low), None)


def has_column(df: DataFrame, name: str) -> bool:
    return find_column(df.columns, name) is not None


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """``toDF(*names)``; the arity must match exactly."""
    if len(names) != len(df.columns):
        raise ValueError(f"positional rename needs {len(df.columns)} names, got {len(names)}: "
                         f"source columns are {df.columns}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, mapping: dict[str, str], strict: bool = False) -> DataFrame:
    """Rename by name in one projection.  Absent sources are ignored, as
    ``withColumnRenamed`` does, unless ``strict``."""
    if strict:
        missing = [s for s in mapping if s not in df.columns]
        if missing:
            raise KeyError(f"columns to rename not found: {missing}; have {df.columns}")
    present = {s: t for s, t in mapping.items() if s in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by name; absent names are ignored."""
    return df.drop(*names)


def stamp(run_ts: datetime | str | None = None) -> Column:
    """Load timestamp: ``current_timestamp()``, or a fixed run time so one run
    stamps every row (and every merge branch) with the same value."""
    if run_ts is None:
        return F.current_timestamp()
    text = run_ts.isoformat(sep=" ") if isinstance(run_ts, datetime) else str(run_ts)
    return F.to_timestamp(F.lit(text))


def with_stamp(df: DataFrame, name: str = "update_ts", run_ts: datetime | str | None = None) -> DataFrame:
    return df.withColumn(name, stamp(run_ts))


def last_path_segment(path: Column) -> Column:
    """``"/a/b/notebook"`` -> ``"notebook"``."""
    return F.element_at(F.split(path, "/"), -1)
