"""Feed configuration lookups.

A config table holds one row per feed.  The lookup is a filter pushed down to
the scan plus ``limit(2)``: never a full count, and a second match is an
error because which row ``limit(1)`` returns would be arbitrary.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class ConfigNotFound(ValueError):
    pass


def parse_ref_id(value: str | int) -> int:
    """Job parameter check: the feed id must be a non-negative integer."""
    text = str(value).strip()
    if not text.isdigit():
        raise ValueError(f"a feed id is a whole number, not {value!r}")
    return int(text)


def lookup(config: DataFrame, column: str, value) -> DataFrame:
    """Rows of ``config`` with ``column = value`` (at most two are ever read)."""
    return config.where(F.col(column) == F.lit(value)).limit(2)


def lookup_row(config: DataFrame, column: str, value) -> Row:
    rows = lookup(config, column, value).collect()
    if not rows:
        raise ConfigNotFound(f"the config table has no row with {column} = {value}")
    if len(rows) > 1:
        raise ValueError(f"more than one configuration row for {column} = {value}")
    return rows[0]


@dataclass
class FeedConfig:
    """One file feed (``ref_id``).  The field names are fixed values: the config table's columns."""
    ref_id: int
    input_path: str
    file_format: str
    schema_path: str
    checkpoint_path: str
    table_catalog: str
    table_schema: str
    ingst_tbl_name: str
    glob_filter: str | None

    @classmethod
    def load(cls, config: DataFrame, ref_id: str | int) -> "FeedConfig":
        row = lookup_row(config, "ref_id", parse_ref_id(ref_id)).asDict()
        return cls(**{f.name: row.get(f.name) for f in fields(cls)})

    @property
    def table_name(self) -> str:
        """The target in the session's catalog."""
        return f"{self.table_schema}.{self.ingst_tbl_name}"


@dataclass
class ApiConfig:
    """One API object (``object_name``); source and object names are lower-cased.
    The field names are fixed values: the config table's columns."""
    object_id: int
    source_url: str
    source_name: str
    object_name: str
    source_delta_column: str

    @classmethod
    def load(cls, config: DataFrame, object_name: str) -> "ApiConfig":
        row = lookup_row(config, "object_name", object_name).asDict()
        return cls(object_id=row["object_id"], source_url=row["source_url"],
                   source_name=(row["source_name"] or "").lower(),
                   object_name=(row["object_name"] or "").lower(),
                   source_delta_column=row["source_delta_column"])


def job_for_tags(jobs: DataFrame, tags: dict[str, str], tags_col: str = "tags") -> Row | None:
    """The job whose tag map carries all ``tags`` (missing key -> no match).
    Two matches are an error: which of them is meant cannot be told."""
    from landfall.functions.predicates import map_entries_equal

    rows = jobs.where(map_entries_equal(tags_col, tags)).select("job_id", F.col("name").alias("job_name")).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"more than one job carries the tags {tags}")
    return rows[0] if rows else None
