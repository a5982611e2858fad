"""Timestamp text conversions used by the API mapping and the watermark.

* strict  -- ``to_timestamp(c, fmt)``: under ANSI mode a value that does not
  match raises and fails the run.
* lenient -- ``try_to_timestamp(c[, fmt])``: a value that does not match is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

API_FORMAT = "MM/dd/yyyy HH:mm:ss"      # fixed: the API's date-time text


def strict_timestamp(c: Column | str, fmt: str | None = API_FORMAT) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)


def lenient_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def format_timestamp(c: Column | str, fmt: str = API_FORMAT) -> Column:
    """Watermark text for the API's ``modifiedDate`` parameter."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


def elapsed_microseconds(start: Column | str, end: Column | str) -> Column:
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e)


def elapsed_seconds_text(start: Column | str, end: Column | str) -> Column:
    """Duration as text in seconds with six decimals (the audit log's ``duration_sec``)."""
    return (elapsed_microseconds(start, end).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")) \
        .cast("decimal(20,6)").cast("string")


def seconds_text(microseconds: int) -> str:
    """The same text for a duration known on the driver."""
    sign, us = ("-", -microseconds) if microseconds < 0 else ("", microseconds)
    return f"{sign}{us // 1_000_000}.{us % 1_000_000:06d}"
