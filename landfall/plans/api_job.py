"""Paged-API change data capture job.

config row -> watermark (MAX ``latest_update_dt`` of SUCCESS audit rows) ->
pages read in parallel by the ``paged_api`` source -> JSON parsed and mapped
on the JVM -> last page wins per key -> one bulk change-detecting merge ->
new watermark = MAX of the delta column over the target -> audit row.
"""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import fs
from landfall.functions.timestamps import API_FORMAT
from landfall.operators.mapping import FieldMap, apply_mapping, landing_schema
from landfall.operators.merge import DuplicateKeyError, duplicate_keys, latest_per_key, merge_into, table_max
from landfall.plans.audit import AuditLog, audited_run
from landfall.plans.config import ApiConfig, job_for_tags
from landfall.session import scratch, session_conf
from landfall.sources import paged
from landfall.tables import Table

# ---- fixed values: API record fields, target columns and conversions --------
# (source field, target column, type, format, strict)
DEVICE_FIELDS = [
    ("status", "status", "string", None, True),
    ("deviceStatus", "device_status", "string", None, True),
    ("mendixUID", "mendix_uid", "string", None, True),
    ("mendixPID", "patient_id", "string", None, True),
    ("submissionSource", "submission_source", "string", None, True),
    ("submitterFirstname", "submitter_first_name", "string", None, True),
    ("submitterLastname", "submitter_last_name", "string", None, True),
    ("serialNumber", "serial_number", "string", None, True),
    ("modelNumber", "model_number", "string", None, True),
    ("reasonForMonitoring", "reason_for_monitoring", "string", None, True),
    ("monitorSerialNumber", "monitor_serial_number", "string", None, True),
    ("monitorModelNumber", "monitor_model_number", "string", None, True),
    ("enrolledStatus", "enrolled_status", "string", None, True),
    ("procedureDate", "procedure_date", "timestamp", None, False),
    ("procedureAccount", "procedure_account", "string", None, True),
    ("followupAccount", "followup_account", "string", None, True),
    ("procedureProviderNPI", "procedure_provider_npi", "string", None, True),
    ("followupProviderNPI", "followup_provider_npi", "string", None, True),
    ("inputDate", "input_date", "timestamp", API_FORMAT, True),
    ("modifiedDate", "modified_date", "timestamp", API_FORMAT, True),
    ("mendixEntityMergeID", "entity_merge_id", "string", None, True),
    ("GC_MX_ID", "gc_mendix_uid", "string", None, True),
    ("GC_RGSTRN_MX_UID", "gc_rgstrn_mx_uid", "string", None, True),
    ("dateOfOldestTransmission", "oldest_transmission_date", "timestamp", API_FORMAT, True),
    ("enrollmentDate", "enrollment_date", "timestamp", API_FORMAT, True),
    ("isResolving", "isresolving", "boolean", None, True),
    ("DateResolving", "resolving_date", "timestamp", API_FORMAT, True),
    ("RegPostedDate", "reg_posted_date", "timestamp", API_FORMAT, True),
    ("IsAutoCompleted", "isautocompleted", "boolean", None, True),
    ("completedDate", "completeddate", "timestamp", None, False),
    ("deviceCategory", "devicecategory", "string", None, True),
    ("assignedTo", "assignedto", "string", None, True),
]
DEVICE_KEY = ["mendix_uid"]
DEVICE_DATA_KEY = paged.DATA_KEY
# ------------------------------------------------------------------------------

REFUSED = "_refused"
RECORDS_PER_GROUP = 32_000          # of landed pages, in a parquet row group
DEVICE_MAPPING = [FieldMap(s, t, ty, fmt, strict) for s, t, ty, fmt, strict in DEVICE_FIELDS]


def mapping_for(column: str, mapping: list[FieldMap] = DEVICE_MAPPING) -> list[FieldMap]:
    """Mapping entries whose target is ``column`` (case-insensitive)."""
    return [m for m in mapping if m.target.lower() == (column or "").lower()]


class FetchFailed(RuntimeError):
    """A page before the end could not be read."""


class RecordsLost(FetchFailed):
    """Spark read another number of records of a page than the API sent."""


def fetch_pages(spark: SparkSession, options: dict, source=paged.PagedApiDataSource) -> DataFrame:
    """``(page, outcome, body, error, records)``: the outcome of every request,
    fetched in parallel.  A path is qualified here, so that every executor
    resolves it as Spark would.  ``options["source"]`` may name another class
    that extends the paged source."""
    options = dict(options)
    source = options.pop("source", source)
    paged.register(spark, source)
    if options.get("path"):
        options["path"] = fs.qualify(spark, options["path"])
    return spark.read.format(source.name()).options(**{k: str(v) for k, v in options.items()}).load()


def land_pages(spark: SparkSession, options: dict, path: str) -> DataFrame:
    """Call the API once and keep the outcomes as parquet at ``path``.  Row groups
    hold few pages: Spark reads up to 4096 rows of one at a time, bodies included."""
    pages = max(1, RECORDS_PER_GROUP // max(1, int(paged.Options(options).get("limit", 1000))))
    fetch_pages(spark, options).write.mode("overwrite").option("parquet.block.row.count.limit", pages).parquet(path)
    return spark.read.schema(paged.SCHEMA).parquet(path)


def read_pages(spark: SparkSession, options: dict, path: str | None = None) -> DataFrame:
    """``(page, position, record)`` rows of every page up to the first end,
    from pages landed at ``path`` (a scratch folder by default).  The caller
    writes the rows and then asks :func:`check_complete`."""
    landed = land_pages(spark, options, path or f"{scratch(spark, 'pages')}/pages")
    missing = paged.stopped_by(landed)
    if missing is not None:
        raise FetchFailed(missing)
    return paged.page_records(landed, options.get("dataKey", DEVICE_DATA_KEY))


def check_complete(landed: DataFrame, rows: DataFrame) -> None:
    """Fail unless ``rows`` holds as many records of each landed page as the
    reader counted in it: what Spark's JSON parser drops (a body it refuses is
    NULL, not an error) must not let the watermark move past it."""
    lost = paged.unread(landed, rows)
    worst = lost.agg(F.count("*").alias("pages"), F.min_by(F.struct("*"), "page").alias("first")).first()
    if worst["pages"]:
        first = worst["first"]
        raise RecordsLost(f"page {first['page']}: {first['records']} records sent, {first['found']} read"
                          + (f" (and {worst['pages'] - 1} more pages)" if worst["pages"] > 1 else ""))


def parse_records(pages: DataFrame, mapping: list[FieldMap] = DEVICE_MAPPING, *,
                  run_ts: datetime | str | None = None) -> DataFrame:
    """Typed, renamed frame (+ ``page``, ``position``): each record is parsed
    once, with strict booleans landing as text, then mapped in one projection
    that fails the run for a present value that is no JSON boolean, and for a
    record that is no object or that the parser refuses (it would come out as a
    row of NULLs)."""
    strict = {m.source for m in mapping if m.type == "boolean" and m.strict}
    landed = T.StructType([T.StructField(f.name, T.VariantType() if f.name in strict else f.dataType, True)
                           for f in landing_schema(mapping).fields] + [T.StructField(REFUSED, T.StringType(), True)])
    parsed = F.from_json("record", landed, {"columnNameOfCorruptRecord": REFUSED})
    refused = F.raise_error(F.concat(F.lit("record "), F.col("position").cast("string"), F.lit(" of page "), F.col("page").cast("string"),
                                     F.lit(" cannot be parsed as a JSON object"))).cast("int")
    fields = pages.select("page", "position", parsed.alias("r")).select(
        F.when(F.col("r").isNull() | F.col("r").getField(REFUSED).isNotNull(), refused).otherwise(F.col("page")).alias("page"),
        "position", "r.*").drop(REFUSED)
    checks = {}
    for name in strict:
        value = F.col(f"`{name}`")
        kind = F.schema_of_variant(value)
        checks[name] = F.when(value.isNull() | (kind == "VOID"), F.lit(None).cast("boolean")).when(
            kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).otherwise(F.raise_error(F.concat(
                F.lit(f"field {name} is not a JSON boolean: "), F.to_json(value))).cast("boolean"))
    return apply_mapping(fields.withColumns(checks), mapping, run_ts=run_ts, keep_unlisted=True)


def api_frame(spark: SparkSession, options: dict, *, run_ts=None, mapping=DEVICE_MAPPING,
              keys=DEVICE_KEY, stage_path: str | None = None, on_page_duplicate: str = "error") -> DataFrame:
    """Pages -> typed rows, one per key (the row of the latest page wins).  The
    pages and then the parsed records are landed under ``stage_path`` (a
    scratch folder by default), so the API is called once and the JSON parsed
    once.

    A key repeated *within one page* is what a per-page MERGE refuses;
    ``on_page_duplicate="error"`` raises for it, ``"last"`` keeps the later
    record of the page."""
    stage_path = stage_path or scratch(spark, "api")
    rows = parse_records(read_pages(spark, options, f"{stage_path}/pages"), mapping, run_ts=run_ts)
    rows.write.mode("overwrite").parquet(f"{stage_path}/parsed")
    rows = spark.read.schema(rows.schema).parquet(f"{stage_path}/parsed")
    check_complete(spark.read.schema(paged.SCHEMA).parquet(f"{stage_path}/pages"), rows)
    if on_page_duplicate == "error":
        dup = duplicate_keys(rows, list(keys) + ["page"]).first()
        if dup is not None:
            raise DuplicateKeyError(f"key repeated within one page: {dup.asDict()}")
    return latest_per_key(rows, keys, ["page", "position"]).drop("page", "position")


def attempt_rows(landed: DataFrame, run_id: str, identity: dict) -> DataFrame:
    """FAILURE audit rows for every failed request attempt, of pages that were
    read in the end and of pages that were not, built on the executors."""
    cols = {"run_id": F.lit(run_id), "latest_update_dt": F.lit(None).cast("timestamp"),
            "start_time": F.current_timestamp(), "end_time": F.current_timestamp(),
            "run_status": F.lit("FAILURE"),
            "log_step": F.concat(F.lit("REQUEST of page "), F.col("page").cast("string"), F.lit(": "), F.col("error"))}
    cols.update({k: F.lit(v) for k, v in identity.items()})
    return landed.where(F.col("error").isNotNull()).select(*[c.alias(k) for k, c in cols.items()])


def audit_attempts(spark: SparkSession, log: AuditLog, raw_path: str, run_id: str, identity: dict) -> None:
    """Log the failed attempts of the landed pages.  Bookkeeping must not hide
    why a run failed: what goes wrong here is only a warning."""
    try:
        if fs.exists(spark, f"{raw_path}/_SUCCESS"):
            rows = attempt_rows(spark.read.schema(paged.SCHEMA).parquet(raw_path), run_id, identity)
            if not rows.isEmpty():
                log.append(rows, f"requests-{run_id}")
    except Exception as exc:
        warnings.warn(f"request attempts of run {run_id} were not logged: {exc}", stacklevel=2)


def initial_text(initial: str | None) -> str:
    """``MM/dd/yyyy HH:mm:ss`` text to start from.  A first run has no SUCCESS
    row, so it needs an explicit value."""
    if initial is None:
        raise ValueError("no successful run recorded yet: pass initial_watermark")
    for fmt in ("%m/%d/%Y %H:%M:%S", "%m/%d/%Y"):
        try:
            return datetime.strptime(initial, fmt).strftime("%m/%d/%Y %H:%M:%S")
        except ValueError:
            continue
    raise ValueError(f"initial_watermark {initial!r} is not MM/dd/yyyy[ HH:mm:ss]")


def run_api_cdc(spark: SparkSession, config_table: DataFrame | str, object_name: str, *, target: str, audit: str,
                transport: dict, jobs: DataFrame | str | None = None, job_tags: dict[str, str] | None = None,
                mapping: list[FieldMap] = DEVICE_MAPPING, keys: list[str] = DEVICE_KEY,
                notebook_name: str | None = None, initial_watermark: str | None = None, run_ts=None,
                rows_per_part: int | None = None, num_partitions: int = 4, time_zone: str | None = None,
                table_name: str | None = None, audit_name: str | None = None) -> dict:
    """The whole CDC run.  ``transport`` holds the ``paged_api`` options other
    than ``modifiedDate`` (e.g. ``{"transport": "http", "url": ..., "username": ...}``).

    ``mapping`` and ``keys`` describe the object's records, ``job_tags`` finds
    its job row in ``jobs``.  ``time_zone`` is the zone of the API's date-time
    texts: they are parsed, and the watermark is written, in that zone (the
    session's by default), whatever zone the driver's host is in.
    ``target`` and ``audit`` are the folders of two catalog tables,
    ``table_name`` and ``audit_name`` (schema.table) their names."""
    if isinstance(config_table, str):
        config_table = spark.table(config_table)
    if isinstance(jobs, str):
        jobs = spark.table(jobs)
    cfg = ApiConfig.load(config_table, object_name)
    job = job_for_tags(jobs, job_tags) if jobs is not None and job_tags else None
    log = AuditLog(spark, audit, audit_name)
    identity = dict(object_id=cfg.object_id, job_id=job.job_id if job else None, object_name=cfg.object_name,
                    source_name=cfg.source_name, job_name=job.job_name if job else None,
                    notebook_name=notebook_name)
    table = Table(spark, target, table_name)
    zone = time_zone or spark.conf.get("spark.sql.session.timeZone")
    with session_conf(spark, "spark.sql.session.timeZone", zone):
        mark = log.watermark_text(cfg.object_name, cfg.source_name) or initial_text(initial_watermark)
        with audited_run(log, **identity) as ctx:
            options = {"url": cfg.source_url, "numPartitions": num_partitions, **transport, "modifiedDate": mark}
            staging = f"{table.location}/_staging/{ctx.run_id}"
            try:
                try:
                    frame = api_frame(spark, options, run_ts=run_ts, mapping=mapping, keys=keys, stage_path=staging)
                finally:
                    audit_attempts(spark, log, f"{staging}/pages", ctx.run_id, identity)
                # the delta is landed once; the merge reads it a few times
                frame.write.mode("overwrite").parquet(f"{staging}/rows")
                delta = spark.read.schema(frame.schema).parquet(f"{staging}/rows")
                # latest_per_key left one row per key: no duplicate check needed
                merge_into(table, delta, keys, rows_per_part=rows_per_part, run_ts=run_ts, on_duplicate="unique",
                           track_max=[m.target for m in mapping_for(cfg.source_delta_column, mapping) if m.type == "timestamp"])
                ctx.latest_update_dt = table_max(table, cfg.source_delta_column)
            finally:
                fs.delete(spark, staging)   # merged, or of no use: a new run asks again
    return {"watermark_used": mark, "latest_update_dt": ctx.latest_update_dt, "run_id": ctx.run_id}
