"""Source-to-target field mapping as data.

A mapping is a list of :class:`FieldMap` (source field, target column, type,
optional format).  :func:`apply_mapping` turns it into a single projection, so
Catalyst sees one ``Project`` rather than a chain of ``withColumn`` calls.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import find_column, stamp
from landfall.functions.timestamps import lenient_timestamp, strict_timestamp


@dataclass(frozen=True)
class FieldMap:
    source: str
    target: str
    type: str = "string"          # string | boolean | timestamp | any Spark SQL type name
    fmt: str | None = None        # timestamp text format
    strict: bool = True           # timestamp: raise on bad text (to_timestamp) or NULL (try_to_timestamp)

    def landed_type(self) -> T.DataType:
        """Type of the field as it arrives (timestamps arrive as text)."""
        if self.type == "timestamp":
            return T.StringType()
        return T.DataType.fromDDL(self.type)


def landing_schema(spec: list[FieldMap]) -> T.StructType:
    return T.StructType([T.StructField(m.source, m.landed_type(), True) for m in spec])


def convert(c: Column, m: FieldMap) -> Column:
    if m.type == "timestamp":
        return strict_timestamp(c, m.fmt) if m.strict else lenient_timestamp(c, m.fmt)
    if m.type == "string":
        return c
    return c.cast(m.landed_type())


def apply_mapping(df: DataFrame, spec: list[FieldMap], *, keep_unlisted: bool = False,
                  stamp_column: str | None = "update_ts", run_ts: datetime | str | None = None) -> DataFrame:
    """Rename, convert and order the listed fields; a listed field missing from
    the input becomes NULL.  Unlisted input columns follow when
    ``keep_unlisted``; the load stamp comes last."""
    cols = []
    used = set()
    for m in spec:
        name = find_column(df.columns, m.source)
        src = F.col(f"`{name}`") if name else F.lit(None).cast(m.landed_type())
        if name:
            used.add(name)
        cols.append(convert(src, m).alias(m.target))
    if keep_unlisted:
        cols.extend(F.col(f"`{c}`") for c in df.columns if c not in used and c != stamp_column)
    if stamp_column:
        cols.append(stamp(run_ts).alias(stamp_column))
    return df.select(*cols)
