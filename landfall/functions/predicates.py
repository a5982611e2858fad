"""Predicates: null-safe change detection, status and map-key filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(left: DataFrame | str, right: DataFrame | str, columns: list[str]) -> Column:
    """``NOT (l.c <=> r.c) OR ...`` over ``columns``: true when any value
    changed, counting a change to or from NULL and never a NULL-to-NULL."""
    if not columns:
        return F.lit(False)

    def ref(side, c):
        return side[c] if isinstance(side, DataFrame) else F.col(f"{side}.{c}")

    return reduce(lambda a, b: a | b, [~ref(left, c).eqNullSafe(ref(right, c)) for c in columns])


def status_is(col: str, status: str) -> Column:
    """Case-folded status compare, ``upper(run_status) = 'SUCCESS'``."""
    return F.upper(F.col(col)) == F.lit(status.upper())


def map_entries_equal(map_col: str, entries: dict[str, str]) -> Column:
    """``m['k1'] = v1 AND m['k2'] = v2 ...``; a missing key is NULL, so the row
    does not match."""
    return reduce(lambda a, b: a & b, [F.col(map_col)[k] == F.lit(v) for k, v in entries.items()])
