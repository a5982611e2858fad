"""Run-to-completion loads into a catalog table.

A *run* stages its rows in a fresh folder of the target table and publishes it
at the end with one statement -- either as the table's whole contents (truncate
and load: the table then holds exactly the files that arrived since the last
run) or added to what is there (append, a part for each batch).

Streams run with ``trigger(availableNow=True)`` and ``foreachBatch``.  Each
micro-batch overwrites its own folder ``batch-<id>`` of the run, so a batch
that Spark replays after a failure replaces its earlier output instead of
doubling it.  A run that has not been published yet is recorded in
``<state>/open_run``; a retry resumes it, so batches already committed to the
checkpoint are never lost by the truncate.  Whether a run is published is what
the catalog says: the table's location, or its parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from landfall import fs
from landfall.tables import Table

BatchHook = Callable[[DataFrame, int], None]


class SchemaGrew(Exception):
    """A file of a batch has columns that the stream was started without."""


@dataclass
class LoadResult:
    run: str
    batches: int
    published: bool


class RunState:
    """Per-feed state folder: stream checkpoint and the open-run record."""

    def __init__(self, spark: SparkSession, state_dir: str):
        self.spark = spark
        self.dir = state_dir.rstrip("/")
        self.checkpoint = f"{self.dir}/checkpoint"
        self._open = f"{self.dir}/open_run"

    def open_run(self) -> str | None:
        text = fs.read_text(self.spark, self._open)
        return text.strip() if text else None

    def begin(self, table: Table) -> str:
        """The run to load into: the recorded open run, unless that one was
        published already (the process died between publish and clean-up)."""
        run = self.open_run()
        if run is not None and published(table, run):
            run = None
        if run is None:
            run = table.new_run()
            fs.write_text(self.spark, self._open, run)
        return run

    def end(self) -> None:
        fs.delete(self.spark, self._open, recursive=False)


def batch_path(table: Table, run: str, batch_id: int) -> str:
    return f"{table.path(run)}/batch-{batch_id:012d}"


def batches_of(table: Table, run: str) -> dict[str, str]:
    """The run's staged batches: part name -> folder."""
    names = [n for n in fs.list_names(table.spark, table.path(run)) if n.startswith("batch-")]
    return {f"{run}.{n}": f"{table.path(run)}/{n}" for n in names}


def published(table: Table, run: str) -> bool:
    """Whether the catalog's table holds the run."""
    if not table.exists():
        return False
    if not table.in_parts:
        return table.whole_location() == fs.qualify(table.spark, table.path(run))
    staged = sorted(batches_of(table, run))
    return bool(staged) and table.part_location(staged[0]) is not None


def write_batch(df: DataFrame, path: str) -> None:
    """Idempotent batch write: a replay of the same batch replaces its folder."""
    df.write.mode("overwrite").parquet(path)


def publish(table: Table, run: str, schema, *, replace: bool, empty_run: str = "clear") -> bool:
    """Make the run visible.  ``empty_run="keep"`` leaves a snapshot table as
    it was when the run staged no batch."""
    staged = batches_of(table, run)
    if not replace:
        table.publish_parts(staged, schema)
        return True
    if not staged and empty_run == "keep" and table.exists():
        return False
    table.publish_whole(table.path(run), schema)
    return True


def load_stream(stream: DataFrame, table: Table, state_dir: str, *, replace: bool = True,
                empty_run: str = "clear", after_write: BatchHook | None = None,
                query_name: str | None = None, grown: Callable[[], bool] | None = None) -> LoadResult:
    """Run ``stream`` to completion (availableNow) and publish what it read.

    ``grown`` is asked before the first batch is read whether files can have columns
    that the stream lacks.  If so the batch is not written and ``SchemaGrew`` is
    raised: started again with the new schema, the run goes on with that batch.  Once
    is enough: an availableNow stream lists its folder before its first batch and
    reads nothing that arrives later."""
    spark = stream.sparkSession
    state = RunState(spark, state_dir)
    run = state.begin(table)
    ran, stopped = [], []

    def sink(df: DataFrame, batch_id: int) -> None:
        if grown is not None and not ran and grown():
            stopped.append(batch_id)
            raise SchemaGrew(f"batch {batch_id}")
        write_batch(df, batch_path(table, run, batch_id))
        ran.append(batch_id)
        if after_write is not None:
            after_write(df, batch_id)

    writer = (stream.writeStream.foreachBatch(sink)
              .option("checkpointLocation", state.checkpoint)
              .trigger(availableNow=True)
              .outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    query = writer.start()
    try:
        query.awaitTermination()
    except StreamingQueryException as exc:
        if stopped:
            raise SchemaGrew(f"batch {stopped[0]} needs columns that the stream lacks") from exc
        raise
    done = publish(table, run, stream.schema, replace=replace, empty_run=empty_run)
    state.end()
    return LoadResult(run, len(ran), done)
