"""The four file-drop jobs, config driven.

Each job is a :class:`FileSource` (how to read the drop folder) plus a
transform (how rows map onto the target), loaded into the configured catalog
table as a run-to-completion snapshot.  Discovery is the file stream (each new path read
once, progress checkpointed) or, with ``allow_overwrites``, the changed-file
ledger, which also re-reads files rewritten under the same name.
"""

from __future__ import annotations

from collections.abc import Callable
import contextlib
import uuid
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import fs
from landfall.functions.columns import drop_columns, rename_by_position, rename_columns, stamp
from landfall.operators.flatten import flatten, flatten_zip
from landfall.plans.config import FeedConfig, parse_ref_id
from landfall.session import session_conf
from landfall.sources.files import FileSource, spark_format
from landfall.sources.ledger import FileLedger
from landfall.streaming.loads import LoadResult, RunState, SchemaGrew, batch_path, load_stream, publish, published, write_batch
from landfall.tables import Table

Transform = Callable[[DataFrame], DataFrame]

# ---- fixed values: target layouts of the four jobs ---------------------------
CSV_TARGET = ["network_id", "nleader_name"]
TSV_DROP = ["Total User Count", "Active User Count", "Inactive User Count", "Division GUID"]
TSV_RENAME = {"User Division ID": "division_id", "User Division ": "division_name",
              "Division Parent ID": "parent_division_id", "Division Parent ": "parent_division_name"}
FLAT_JSON_SCHEMA = "TaskId STRING, TimeUpdated STRING, TimeCreated STRING, UserId STRING"
FLAT_JSON_RENAME = {"TaskId": "taskid", "TimeUpdated": "timeupdated", "TimeCreated": "timecreated",
                    "UserId": "activeapprovers_userid"}
FLAT_JSON_ORDER = ["taskid", "timecreated", "timeupdated", "activeapprovers_userid", "update_ts"]
NESTED_PARENT = "approvalFactDelegatee"
NESTED_HINT = ("approvalFactDelegatee ARRAY<STRUCT<SourceSystem: STRING, UserId: STRING, ApprovableId: STRING, "
               "TimeUpdated: STRING, Approver: STRING, ApprovalActivationDate: STRING>>")
NESTED_RENAME = {"ApprovableId": "approvableid", "Approver": "approver",
                 "ApprovalActivationDate": "approvalactivationdate", "TimeUpdated": "timeupdated",
                 "SourceSystem": "sourcesystem", "UserId": "userid"}
NESTED_ORDER = ["approvableid", "approver", "approvalactivationdate", "timeupdated", "sourcesystem",
                "userid", "update_ts"]
# ------------------------------------------------------------------------------


def csv_transform(run_ts=None) -> Transform:
    """Two data columns named by position, plus the load stamp.  A file with a
    third column fails the arity check."""
    def t(df: DataFrame) -> DataFrame:
        data = [c for c in df.columns if c != "_rescued_data"]
        return rename_by_position(df.select(*[F.col(f"`{c}`") for c in data]), CSV_TARGET) \
            .withColumn("update_ts", stamp(run_ts))
    return t


def tsv_transform(run_ts=None) -> Transform:
    """Drop the count columns, rename the four listed ones, stamp, keep rows
    with an id.  Unlisted columns pass through."""
    def t(df: DataFrame) -> DataFrame:
        df = rename_columns(drop_columns(df, TSV_DROP), TSV_RENAME).withColumn("update_ts", stamp(run_ts))
        return df.where(F.col("division_id").isNotNull())
    return t


def flat_json_transform(run_ts=None) -> Transform:
    def t(df: DataFrame) -> DataFrame:
        df = rename_columns(df, FLAT_JSON_RENAME).withColumn("update_ts", stamp(run_ts))
        return df.select(*FLAT_JSON_ORDER)
    return t


def nested_json_transform(run_ts=None, literal: bool = False) -> Transform:
    """Parent array of structs -> one row per element.  ``literal`` uses
    ``explode(arrays_zip(...))``; the default ``inline`` gives the same rows."""
    def t(df: DataFrame) -> DataFrame:
        flat = (flatten_zip if literal else flatten)(df, NESTED_PARENT)
        flat = rename_columns(flat, NESTED_RENAME).withColumn("update_ts", stamp(run_ts))
        return flat.select(*NESTED_ORDER)
    return t


JOBS = {
    "csv": (csv_transform, {}),
    # tab delimiter set by the job, whatever the config's format; no closing
    # select, so the rescued-data column reaches the table like any other
    "tsv": (tsv_transform, {"rescued_data_column": "_rescued_data"}),
    "json_flat": (flat_json_transform, {"schema": FLAT_JSON_SCHEMA}),
    "json_nested": (nested_json_transform, {"schema_hints": NESTED_HINT}),
}


@dataclass
class FileFeedJob:
    source: FileSource
    transform: Transform
    table: Table
    state_dir: str
    replace: bool = True              # truncate and load (True) or append
    empty_run: str = "clear"          # a run with no new file: clear | keep the table
    allow_overwrites: bool = False    # re-read files rewritten in place (ledger discovery)
    files_per_batch: int = 1000
    bytes_per_batch: int | None = None   # ledger mode: also size a batch by total file size

    def run(self, after_write=None) -> LoadResult:
        spark = self.table.spark
        with self._whole_lines(spark):
            if self.allow_overwrites:
                return self._run_ledger(spark, after_write)
            if not self.source.include_existing:
                self.source.existing = existing_files(spark, self.source, self.state_dir)
            return self._run_stream(spark, after_write)

    def _run_stream(self, spark: SparkSession, after_write=None) -> LoadResult:
        """Load by a file stream.  The stream lists the folder after inference did; a
        file that came in between is inferred from before its batch is read, and
        where it has columns of its own the stream starts again with them."""
        source = self.source
        if source.infers() and not source.schema_location:
            source = replace(source, schema_location=f"{self.state_dir.rstrip('/')}/schemas/{uuid.uuid4().hex[:12]}")
        batches = 0

        def count(df: DataFrame, batch_id: int) -> None:
            nonlocal batches
            batches += 1
            if after_write is not None:
                after_write(df, batch_id)

        while True:
            schema = source.resolve_schema(spark)
            stream = self.transform(source.stream(spark, schema))
            try:
                done = load_stream(stream, self.table, self.state_dir, replace=self.replace, empty_run=self.empty_run, after_write=count,
                                   grown=(lambda: source.resolve_schema(spark) != schema) if source.infers() else None)
                return LoadResult(done.run, batches, done.published)
            except SchemaGrew:
                continue

    def _whole_lines(self, spark: SparkSession):
        """CSV rescue judges whole lines: Spark's CSV column pruning would
        only check the columns a query reads, so it is off for this run (a
        stream keeps the setting it was started with)."""
        rescue = self.source.rescued_data_column or self.source.new_columns == "rescue"
        if rescue and spark_format(self.source.file_format) == "csv":
            return session_conf(spark, "spark.sql.csv.parser.columnPruning.enabled", "false")
        return contextlib.nullcontext()

    def _run_ledger(self, spark: SparkSession, after_write=None) -> LoadResult:
        """Load what the ledger finds changed.  The open run's work list and the
        batches that it has written are kept: a run that died is taken up where
        it was, and its finished batches are not read again."""
        ledger = FileLedger(spark, f"{self.state_dir.rstrip('/')}/ledger")
        state = RunState(spark, self.state_dir)
        opened = state.open_run()
        ledger.settle(opened if opened and published(self.table, opened) else None, keep=opened)
        run = state.begin(self.table)
        if not self.source.include_existing:
            ledger.skip_existing(self.source.input_path, self.source.glob_filter)
        done = {int(n.split("-")[1]) for n in batches_of_run(self.table, run)}
        work = ledger.resume(run, done, self.source.input_path, self.source.glob_filter)
        if work is None:
            changed = ledger.changed(self.source.input_path, self.source.glob_filter)
            size = changed.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
            batches = max(-(-size["n"] // self.files_per_batch), -(-size["bytes"] // self.bytes_per_batch) if self.bytes_per_batch else 0)
            work = ledger.record(changed, run, batches) if batches else None
        schema = self.source.resolve_schema(spark)
        out_schema = self.transform(spark.createDataFrame([], self.source._with_rescue(schema))).schema
        numbers = sorted(r.batch for r in work.select("batch").distinct().collect()) if work is not None else []
        for b in numbers:
            if b in done:
                continue
            # the names of one batch: about files_per_batch
            paths = [r.path for r in work.where(F.col("batch") == b).select("path").collect()]
            df = self.transform(self.source.batch(spark, paths, schema))
            write_batch(df, batch_path(self.table, run, b))
            if after_write is not None:
                after_write(df, b)
        made = publish(self.table, run, out_schema, replace=self.replace, empty_run=self.empty_run)
        if work is not None:
            ledger.settle(run)
        state.end()
        return LoadResult(run, len(numbers), made)


def batches_of_run(table: Table, run: str) -> list[str]:
    """Names of the batches that were written to their end."""
    names = [n for n in fs.list_names(table.spark, table.path(run)) if n.startswith("batch-")]
    return [n for n in names if fs.exists(table.spark, f"{table.path(run)}/{n}/_SUCCESS")]


def existing_files(spark: SparkSession, source: FileSource, state_dir: str) -> str:
    """Listing of the files that are there at the feed's first run, kept in its state folder."""
    where = f"{state_dir.rstrip('/')}/existing"
    if not fs.exists(spark, f"{where}/_SUCCESS"):
        reader = spark.read.format("binaryFile")
        if source.glob_filter:
            reader = reader.option("pathGlobFilter", source.glob_filter)
        reader.load(source.input_path).select(F.col("_metadata.file_path").alias("_lf_path")).write.mode("overwrite").parquet(where)
    return where


def feed_job(spark: SparkSession, config: FeedConfig, job: str, *, tables_root: str | None = None,
             run_ts: datetime | str | None = None, **options) -> FileFeedJob:
    """Build the job for one config row.  ``job`` is csv | tsv | json_flat |
    json_nested.  The target is the configured schema.table of Spark's catalog,
    its files below ``tables_root``."""
    make, source_opts = JOBS[job]
    reader_opts = dict(options.pop("reader_options", {}))
    if job == "tsv":
        reader_opts.setdefault("sep", "\t")
    source = FileSource(input_path=config.input_path, file_format=config.file_format,
                        glob_filter=config.glob_filter, schema_location=config.schema_path,
                        options=reader_opts, **source_opts,
                        **{k: options.pop(k) for k in list(options) if k in FileSource.__dataclass_fields__})
    if tables_root is None:
        # without a lasting place the next run would publish another table
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("pass tables_root (or set spark.checkpoint.dir): the target table needs a lasting folder")
        tables_root = f"{root.rstrip('/')}/landfall/tables"
    table = Table(spark, f"{tables_root}/{config.table_catalog}/{config.table_schema}/{config.ingst_tbl_name}", config.table_name)
    options.setdefault("allow_overwrites", True)    # a file rewritten in place is read again
    return FileFeedJob(source=source, transform=make(run_ts), table=table, state_dir=config.checkpoint_path, **options)


def run_feed(spark: SparkSession, config_table: DataFrame | str, ref_id: str | int, job: str,
             **options) -> LoadResult:
    """Entry point: ``ref_id`` -> config row -> load -> publish.  The config is
    a DataFrame or the name of a catalog table (``catalog.schema.table``)."""
    config = spark.table(config_table) if isinstance(config_table, str) else config_table
    return feed_job(spark, FeedConfig.load(config, parse_ref_id(ref_id)), job, **options).run()
