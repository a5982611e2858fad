"""Flatten an array-of-struct parent node into one row per element.

``inline(arr)`` emits the struct's fields as columns in one ``Generate``; it is
what ``explode(arrays_zip(arr.f1, arr.f2, ...))`` followed by ``zipped.f*``
computes, without building six intermediate arrays.  Both drop rows whose
array is NULL or empty and turn a NULL element into a row of NULLs.  The
operator is stateless and narrow: no shuffle, element count per row is bounded
by the input record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_fields(df: DataFrame, array_col: str) -> list[str]:
    dt = df.schema[array_col].dataType
    if not (isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType)):
        raise TypeError(f"{array_col} is {dt.simpleString()}, not array<struct<...>>")
    return [f.name for f in dt.elementType.fields]


def flatten(df: DataFrame, array_col: str, keep: list[str] | None = None,
            fields: list[str] | None = None) -> DataFrame:
    """One row per array element with the struct fields as columns."""
    keep = keep or []
    all_fields = struct_fields(df, array_col)
    fields = fields or all_fields
    if fields == all_fields:
        return df.select(*keep, F.inline(F.col(array_col)))
    narrowed = F.transform(F.col(array_col), lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return df.select(*keep, F.inline(narrowed))


def flatten_zip(df: DataFrame, array_col: str, keep: list[str] | None = None,
                fields: list[str] | None = None) -> DataFrame:
    """The literal form: per-field arrays, ``arrays_zip``, ``explode``, fields out."""
    keep = keep or []
    fields = fields or struct_fields(df, array_col)
    arrays = df.select(*keep, *[F.col(f"{array_col}.{f}").alias(f) for f in fields])
    zipped = arrays.select(*keep, F.explode(F.arrays_zip(*fields)).alias("zipped"))
    return zipped.select(*keep, *[F.col(f"zipped.{f}").alias(f) for f in fields])
