"""Schema memory and schema hints.

``SchemaMemory`` keeps the schema a feed settled on in ``<location>/schema.json``
so a later run reads new files with the same columns instead of re-inferring
from scratch.  ``apply_hints`` overrides or adds fields from a DDL string, e.g.
``"items ARRAY<STRUCT<a: STRING, b: STRING>>"``, matched case-insensitively.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landfall import fs


class SchemaMemory:
    """``schema.json``, and in ``inferred`` the files (path, time and length)
    that inference has seen, so that a later run infers from all others --
    whatever their time stamps say."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.path = f"{location.rstrip('/')}/schema.json"
        self.inferred = f"{location.rstrip('/')}/inferred"
        self._listed = f"{location.rstrip('/')}/listed"

    def load(self) -> T.StructType | None:
        text = fs.read_text(self.spark, self.path)
        return T.StructType.fromJson(json.loads(text)) if text else None

    def listed(self, files: DataFrame) -> DataFrame:
        """The listing as it is now, written, so that all who use it see the same files."""
        files.write.mode("overwrite").parquet(self._listed)
        return self.spark.read.schema(files.schema).parquet(self._listed)

    def unseen(self, files: DataFrame) -> DataFrame:
        if not fs.list_names(self.spark, self.inferred):
            return files
        return files.join(self.spark.read.schema(files.schema).parquet(f"{self.inferred}/*"), files.columns, "left_anti")

    def save(self, schema: T.StructType, files: DataFrame | None = None) -> None:
        if self.load() != schema:
            fs.write_text(self.spark, self.path, schema.json())
        if files is not None:
            files.write.parquet(f"{self.inferred}/{uuid.uuid4().hex[:12]}")


def apply_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    if not hints:
        return schema
    hinted = T.StructType.fromDDL(hints)
    by_name = {f.name.lower(): f for f in hinted.fields}
    fields = []
    for f in schema.fields:
        h = by_name.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, h.dataType, True) if h else f)
    fields.extend(T.StructField(h.name, h.dataType, True) for h in by_name.values())
    return T.StructType(fields)
