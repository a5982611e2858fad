"""Change-detecting upsert (MERGE without a row-level table format).

Semantics, per key ``k`` (plain ``=``, so a NULL key never matches):

* target and source both have ``k`` and some compared column differs
  null-safely -> the source row replaces the target row, stamped ``run_ts``;
* both have ``k`` and nothing differs -> the target row stays, stamp untouched;
* only the source has ``k`` (or ``k`` is NULL) -> inserted, stamped;
* only the target has ``k`` -> kept (there is no delete branch).

:func:`merge_frames` is that rule as a DataFrame (a full outer equi-join plus
``CASE``).  :func:`merge_into` applies it to a catalog table by touched parts: a
join of the source with the target's key columns finds the parts that hold matching
keys, only those are read whole, joined and rewritten, and the catalog then
points at their new folders.  New rows fill the last part until it has
``rows_per_part`` rows, then parts of their own.  NULL-key rows, which can never
match, bypass the joins and are dealt among the new rows' parts.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import fs
from landfall.functions.columns import stamp
from landfall.functions.predicates import differs
from landfall.tables import PART, Table, conform, evolve_schema

ACTION = "merge_action"
ROWS_PER_PART = 5_000_000       # of a part, the unit that a merge rewrites


class DuplicateKeyError(ValueError):
    """Several source rows carry the same merge key."""


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys carried by more than one row (NULL keys never conflict)."""
    return (df.where(_all_not_null(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` tuple (e.g.
    ``page, position`` -- the later page wins, as page-by-page merges would
    leave it).  ``order_by`` must order rows totally.  NULL-key rows are all
    kept: each is a group of its own ``order_by`` tuple.  ``row_number() = 1``
    becomes a group limit before the shuffle, so a hot key is reduced map-side,
    and columns that the caller does not select are never read."""
    solo = F.when(~_all_not_null(keys), F.struct(*order_by))
    w = Window.partitionBy(*keys, solo).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def changed_rows(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Source rows whose key exists in the target with some compared value
    different (``NOT (t.c <=> s.c)`` OR-ed)."""
    t = target.select(*keys, *compare).alias("t")
    s = source.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return s.join(t, cond, "inner").where(differs("t", "s", compare)).select("s.*")


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str], *,
                 compare: list[str] | None = None, stamp_column: str | None = "update_ts",
                 run_ts: datetime | str | None = None, extra_join: list[str] | None = None,
                 split_nulls: bool = True) -> DataFrame:
    """Target after the merge, with a ``merge_action`` column
    (insert / update / unchanged / keep).  NULL-key rows go around the join
    (``split_nulls``) instead of all hashing to one join partition; callers
    that already removed them pass ``split_nulls=False``."""
    src_cols = [c for c in source.columns if c != stamp_column]
    compare = compare if compare is not None else [c for c in src_cols if c not in keys and c not in (extra_join or [])]
    out_cols = [c for c in target.columns] + [c for c in src_cols if c not in target.columns]
    if stamp_column and stamp_column not in out_cols:
        out_cols.append(stamp_column)
    join_keys = (extra_join or []) + keys

    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = source.select(*src_cols, *[c for c in (extra_join or []) if c not in src_cols]) \
              .withColumn("_s", F.lit(True)).alias("s")
    t_keyed = t.where(_all_not_null(keys)) if split_nulls else t
    s_keyed = s.where(_all_not_null(keys)) if split_nulls else s
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in join_keys]
    j = t_keyed.join(s_keyed, cond, "full_outer")

    # a compared column the target does not have yet is a change when the source has a value
    changed = differs("t", "s", [c for c in compare if c in target.columns])
    for c in (c for c in compare if c not in target.columns):
        changed = changed | F.col(f"s.{c}").isNotNull()
    action = (F.when(F.col("t._t").isNull(), F.lit("insert"))
              .when(F.col("s._s").isNull(), F.lit("keep"))
              .when(changed, F.lit("update"))
              .otherwise(F.lit("unchanged")))
    take_source = F.col(ACTION).isin("insert", "update")

    def pick(c: str) -> Column:
        in_t, in_s = c in target.columns, c in src_cols or c in (extra_join or [])
        if c == stamp_column:
            old = F.col(f"t.{c}") if in_t else F.lit(None).cast("timestamp")
            return F.when(take_source, stamp(run_ts)).otherwise(old)
        if c in join_keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        if in_t and in_s:
            return F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if in_s:    # new column: NULL for rows the source does not write
            return F.when(take_source, F.col(f"s.{c}"))
        # target-only column: an update keeps it, an insert has no value
        return F.when(F.col(ACTION) == "insert", F.lit(None)).otherwise(F.col(f"t.{c}"))

    joined = j.withColumn(ACTION, action)
    merged = joined.select(*[pick(c).alias(c) for c in out_cols], F.col(ACTION))
    if not split_nulls:
        return merged

    # NULL keys never match: target rows stay, source rows are inserted
    t_null = target.where(~_all_not_null(keys)).withColumn(ACTION, F.lit("keep"))
    s_null = source.where(~_all_not_null(keys))
    if stamp_column:
        s_null = s_null.withColumn(stamp_column, stamp(run_ts))
    s_null = s_null.withColumn(ACTION, F.lit("insert"))
    return (merged.unionByName(t_null, allowMissingColumns=True)
            .unionByName(s_null, allowMissingColumns=True)
            .select(*out_cols, ACTION))


def located(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` with the part of the target that holds its key (NULL: none
    does).  Of the target only the key columns are read, and of those only
    files and row groups within the source's range of the first key.  NULL
    keys go around the join, where they would all meet in one task."""
    keyed = source.where(_all_not_null(keys))
    alone = source.where(~_all_not_null(keys)).withColumn(PART, F.lit(None).cast("string"))
    if target is None:
        return keyed.withColumn(PART, F.lit(None).cast("string")).unionByName(alone)
    span = keyed.agg(F.min(keys[0]), F.max(keys[0])).first()
    have = target.where(_all_not_null(keys)).select(PART, *keys)
    if span[0] is not None:
        have = have.where(F.col(keys[0]).between(F.lit(span[0]), F.lit(span[1])))
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    found = keyed.alias("s").join(have.alias("t"), same, "left").select("s.*", f"t.{PART}")
    return found.unionByName(alone)


def placed(found: DataFrame, new_rows: int, last: tuple[str, int] | None, rows_per_part: int, run: str) -> tuple[DataFrame, tuple[str, int] | None]:
    """``found`` with a part for each new row, and the part that later rows may
    fill, with its number of rows.  New rows are dealt by a hash of the whole
    row, so those with a NULL key spread like others."""
    if not new_rows:
        return found, last
    if last is not None and last[1] + new_rows <= rows_per_part:
        return found.withColumn(PART, F.coalesce(PART, F.lit(last[0]))), (last[0], last[1] + new_rows)
    n = -(-new_rows // rows_per_part)
    number = F.pmod(F.xxhash64(*[c for c in found.columns if c != PART]), F.lit(n))
    part = F.concat(F.lit(f"{run}-"), F.lpad(number.cast("string"), 6, "0"))
    return found.withColumn(PART, F.coalesce(PART, part)), (f"{run}-{n - 1:06d}", -(-new_rows // n))


def merge_into(table: Table, source: DataFrame, keys: list[str], *, rows_per_part: int | None = None,
               compare: list[str] | None = None, stamp_column: str = "update_ts",
               run_ts: datetime | str | None = None, on_duplicate: str = "error",
               track_max: list[str] | tuple = ()) -> None:
    """Upsert ``source`` into a merge table (created on first use).

    What it costs: the target's key columns within the source's key range, and
    the parts that hold a matching key, read and written once.  Each key is in
    one part for good, and a part is moved by one statement, so a reader finds
    every key once at any moment; a merge that dies half-way leaves some parts
    merged, and running it again does the rest.

    ``on_duplicate``: ``"error"`` checks that no key repeats (a shuffle of the
    source by key); ``"unique"`` is for sources unique by construction (e.g.
    :func:`latest_per_key` output).

    ``rows_per_part`` (kept with the table) is about what a merge rewrites for
    one changed row; pick it so that a part is a few hundred megabytes.
    ``track_max`` names timestamp columns whose MAX over the whole table is kept
    with it, so :func:`table_max` answers without a scan.
    """
    spark = source.sparkSession
    src_schema = T.StructType([f for f in source.schema.fields if f.name != stamp_column])
    incoming = T.StructType(src_schema.fields + [T.StructField(stamp_column, T.TimestampType(), True)])
    first = not table.exists()
    before = table.schema
    evolve_schema(before, incoming)         # a conflict shows before anything is done
    if on_duplicate == "error":
        repeated = duplicate_keys(source, keys).first()
        if repeated is not None:
            raise DuplicateKeyError(f"source has several rows for key {repeated.asDict()}")
    run = table.new_run("merge")
    stage, out = table.path(f"_stage/{run}"), table.path(run)
    try:
        schema = table.prepare(incoming, parts=True)
        if first:
            table.note(keys=keys, rows_per_part=rows_per_part or ROWS_PER_PART)
        notes = table.notes()
        size = rows_per_part or notes.get("rows_per_part", ROWS_PER_PART)
        target = spark.table(table.name)
        found = located(None if first else target, source.select(src_schema.names), keys)
        found.write.parquet(stage)
        found = spark.read.schema(found.schema).parquet(stage)
        # a row for each touched part
        counts = {r[PART]: r["n"] for r in found.groupBy(PART).agg(F.count("*").alias("n")).collect()}
        new_rows, last = counts.pop(None, 0), tuple(notes["last"]) if notes.get("last") else None
        if not counts and not new_rows:
            return
        found, last = placed(found, new_rows, last, size, run)
        touched = sorted(set(counts) | ({last[0]} if new_rows and table.part_location(last[0]) else set()))
        stored = T.StructType(schema.fields + [T.StructField(PART, T.StringType(), True)])
        old = target.where(F.col(PART).isin(touched)) if touched else target.where(F.lit(False))
        merged = merge_frames(conform(old, stored), found, keys, compare=compare, stamp_column=stamp_column, run_ts=run_ts, extra_join=[PART])
        # rows of a part together, but a large part in several tasks and files
        conform(merged, stored).hint("rebalance", PART).write.partitionBy(PART).parquet(out)
        folders = {n.split("=", 1)[1]: f"{out}/{n}" for n in fs.list_names(spark, out) if n.startswith(f"{PART}=")}
    except Exception:
        fs.delete(spark, out)
        raise
    finally:
        fs.delete(spark, stage)
    # the changed parts one by one, then all new ones at once: a merge cut off in between is finished by running it again
    table.note(publishing=run)
    table.move_parts({n: p for n, p in folders.items() if n in touched})
    table.publish_parts({n: p for n, p in folders.items() if n not in touched}, schema)
    # what is known of a table whose last merge was cut off may be wrong
    tracked = {} if notes.get("publishing") else dict(notes.get("max", {}))
    for c in track_max:
        tracked[c] = _tracked(table, c, tracked.get(c), spark.read.schema(stored).parquet(out), touched, first)
    table.note(last=last, max=tracked, publishing=None)


def _micros(c: str, dtype: T.DataType) -> Column:
    """A timestamp as microseconds, whatever the session's zone is."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c))
    raise ValueError(f"{c}: only timestamp columns are tracked")


def _tracked(table: Table, column: str, known: list | None, written: DataFrame, touched: list[str], first: bool) -> list | None:
    """MAX of ``column`` over the table after a merge and a part that holds it.
    The maximum known before still counts if its part was not rewritten, or if
    the rewritten rows reach it; else, and when none is known, the column is scanned."""
    value = _micros(column, written.schema[column].dataType)
    newest = lambda df: df.agg(F.max(F.struct(value.alias("m"), F.col(PART).alias("p"))).alias("x")).first()["x"]
    fresh = newest(written.where(F.col(column).isNotNull()))
    if first:
        return list(fresh) if fresh else None
    if known is not None:
        if fresh is not None and fresh["m"] >= known[0]:
            return list(fresh)
        if known[1] not in touched:
            return known
    whole = newest(table.spark.table(table.name).where(F.col(column).isNotNull()))
    return list(whole) if whole else None


def table_max(table: Table, column: str):
    """MAX of ``column`` over the whole merge table: the tracked one, otherwise
    by a scan of that column."""
    from landfall.functions.columns import find_column
    from landfall.operators.watermark import column_max

    if not table.exists():
        return None
    schema = table.schema
    name = find_column(schema.names, column)
    if name is None:
        return None
    notes = table.notes()
    tracked = notes.get("max", {})
    if name not in tracked or notes.get("publishing"):
        return column_max(table.read(), name).first()[0]
    # microseconds -> the value collect() would give, without a job
    return schema[name].dataType.fromInternal(tracked[name][0]) if tracked[name] else None
