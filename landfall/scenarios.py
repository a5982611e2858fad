"""Registered scenarios: each builds its inputs from the given tables, runs
one engine operator end to end and returns the resulting DataFrame, paired
with a DuckDB SQL statement over the same tables that must give the same rows.

Conventions: the load stamp uses the fixed ``RUN_TS`` so results are
repeatable; timestamps are returned as ``timestamp_ntz`` (the tables' type);
text sources land strings, hence the ``CAST(... AS VARCHAR)`` in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import fs
from landfall.fixtures import FaultyApi, files_for, sf_table, stage_files, timed
from landfall.functions.columns import with_stamp
from landfall.functions.predicates import map_entries_equal
from landfall.functions.timestamps import format_timestamp, lenient_timestamp, strict_timestamp
from landfall.operators.merge import changed_rows, duplicate_keys, merge_into
from landfall.operators.watermark import column_max, high_watermark, high_watermark_sql
from landfall.plans.api_job import DEVICE_FIELDS, FetchFailed, RecordsLost, api_frame
from landfall.plans.audit import AuditLog
from landfall.plans.config import FeedConfig, lookup
from landfall.plans.file_jobs import FileFeedJob, feed_job, nested_json_transform, run_feed
from landfall.session import scratch
from landfall.sources.files import FileSource
from landfall.tables import PART, Table

RUN_TS = "2024-01-01 00:00:00"
RUN_TS_2 = "2024-02-01 00:00:00"
OLD_MS = 1_577_836_800_000         # 2020-01-01, long before any run
ROWS_PER_TASK = 250_000            # of what a task groups into arrays
SQL_TS = "TIMESTAMP '2024-01-01 00:00:00'"
SQL_TS_2 = "TIMESTAMP '2024-02-01 00:00:00'"


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _own(label: str, area: str) -> str:
    """A table name that no other run of a scenario has."""
    return f"{label}_{area.rsplit('/', 1)[-1].replace('-', '_')}"


def _config(area: str, fmt: str, glob: str, ref_id: int = 1) -> FeedConfig:
    return FeedConfig(ref_id=ref_id, input_path=f"{area}/drop", file_format=fmt, schema_path=f"{area}/schema",
                      checkpoint_path=f"{area}/state", table_catalog="main", table_schema="landfall",
                      ingst_tbl_name=_own("target", area), glob_filter=glob)


@timed
def _rows(df: DataFrame) -> int:
    return df.count()


# ---------------------------------------------------------------- file drops
def q01_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q01")
    cust = sf_table(spark, sf, "customer")
    src = cust.select(F.col("c_custkey").cast("string").alias("Network Id"), F.col("c_name").alias("Leader Name"))
    n = files_for(_rows(cust))
    stage_files(src, "csv", f"{area}/drop", "customers", n)
    stage_files(src, "json", f"{area}/drop", "decoy", n)          # must be skipped by the glob filter
    job = feed_job(spark, _config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables", run_ts=RUN_TS)
    job.run()
    return ntz(job.table.read(), "update_ts")


def q02_tsv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q02")
    cust = sf_table(spark, sf, "customer")
    src = cust.select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).alias("User Division ID"),
        F.col("c_name").alias("User Division "),
        F.col("c_nationkey").cast("string").alias("Division Parent ID"),
        F.col("c_mktsegment").alias("Division Parent "),
        (F.col("c_custkey") * 3).cast("string").alias("Total User Count"),
        (F.col("c_custkey") * 2).cast("string").alias("Active User Count"),
        F.col("c_custkey").cast("string").alias("Inactive User Count"),
        F.md5(F.col("c_name")).alias("Division GUID"),
        F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("region_code"),
    )
    stage_files(src, "tsv", f"{area}/drop", "divisions", files_for(_rows(cust)))
    job = feed_job(spark, _config(area, "tsv", "*.tsv"), "tsv", tables_root=f"{area}/tables", run_ts=RUN_TS)
    job.run()
    return ntz(job.table.read(), "update_ts")


def q03_json_flat(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q03")
    conv = sf_table(spark, sf, "conversations")
    src = conv.select(F.col("conv_id").alias("TaskId"), F.col("turn").alias("TimeUpdated"),
                      F.col("role").alias("TimeCreated"), F.col("text").alias("UserId"),
                      F.lit("unused").alias("Channel"))
    stage_files(src, "json", f"{area}/drop", "tasks", files_for(_rows(conv), 2_000))
    job = feed_job(spark, _config(area, "json", "*.json"), "json_flat", tables_root=f"{area}/tables",
                   run_ts=RUN_TS)
    job.run()
    return ntz(job.table.read(), "update_ts")


@timed
def stage_nested(spark: SparkSession, sf: str, dest: str) -> None:
    """lineitem as JSON records with an array-of-struct parent node (at most
    four elements per record); orders without lines carry no parent node or
    an empty one."""
    li = sf_table(spark, sf, "lineitem").withColumn("chunk", F.floor((F.col("l_linenumber") - 1) / 4))
    orders = sf_table(spark, sf, "orders")
    n = _rows(li)
    # grouped in parts that grow in number, not in what a task holds
    parts = max(2, -(-n // ROWS_PER_TASK))
    elem = F.struct(F.col("l_returnflag").alias("SourceSystem"), F.col("l_linenumber").alias("UserId"),
                    F.col("l_orderkey").cast("string").alias("ApprovableId"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("TimeUpdated"),
                    F.col("l_partkey").alias("Approver"), F.col("l_linestatus").alias("ApprovalActivationDate"))
    recs = (li.repartition(parts, "l_orderkey", "chunk").groupBy("l_orderkey", "chunk")
            .agg(F.collect_list(elem).alias("approvalFactDelegatee"))
            .select(F.col("l_orderkey").alias("OrderKey"), "approvalFactDelegatee"))
    keys = li.select(F.col("l_orderkey").alias("o_orderkey")).repartition(parts, "o_orderkey")
    empty = (orders.repartition(parts, "o_orderkey").join(keys, "o_orderkey", "left_anti")
             .select(F.col("o_orderkey").alias("OrderKey"),
                     F.when(F.col("o_orderstatus") == "F", F.array().cast(recs.schema["approvalFactDelegatee"].dataType))
                     .alias("approvalFactDelegatee")))
    stage_files(recs.unionByName(empty), "json", dest, "approvals", files_for(n, 50_000))


def q04_json_nested(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q04")
    stage_nested(spark, sf, f"{area}/drop")
    job = feed_job(spark, _config(area, "json", "*.json"), "json_nested", tables_root=f"{area}/tables",
                   run_ts=RUN_TS)
    job.run()
    return ntz(job.table.read(), "update_ts")


def q05_glob_filter(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q05")
    source = FileSource(input_path=sf, file_format="parquet", glob_filter="events.parquet",
                        schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state")
    job.run()
    return job.table.read()


def _stamped(run_ts):
    return lambda df: with_stamp(df, run_ts=run_ts)


def q06_changed_files(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q06")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)

    def stage(status: str, ver: str) -> None:
        rows = orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", F.lit(ver).alias("ver"))
        stage_files(rows, "csv", f"{area}/drop", f"orders-{status}", n)

    for s in ("F", "O", "P"):
        stage(s, "v1")
    source = FileSource(input_path=f"{area}/drop", file_format="csv", glob_filter="*.csv",
                        schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state", replace=False, allow_overwrites=True)
    job.run()
    job.run()                       # nothing changed: reads nothing
    stage("P", "v2")                # rewrite the P files in place
    job.run()
    return job.table.read()


def q07_schema_memory(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q07")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    first = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    later = orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    source = FileSource(input_path=f"{area}/drop", file_format="json", glob_filter="*.json",
                        schema_location=f"{area}/schema", new_columns="add")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state", replace=False)
    stage_files(first, "json", f"{area}/drop", "batch1", n)
    job.run()
    stage_files(later, "json", f"{area}/drop", "batch2", n)
    job.run()
    return job.table.read()


def q08_rescued(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q08")
    orders = sf_table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_orderstatus",
                         F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("o_orderpriority"))
    stage_files(rows, "json", f"{area}/drop", "orders", files_for(_rows(orders), 30_000))
    source = FileSource(input_path=f"{area}/drop", file_format="json", glob_filter="*.json",
                        schema="o_orderkey STRING, o_orderstatus STRING", rescued_data_column="_rescued_data")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state")
    job.run()
    return job.table.read()


# ---------------------------------------------------------------- paged API
@timed
def stage_pages(spark: SparkSession, sf: str, dest: str, status=None, modified=None, only=None) -> None:
    """orders as API pages of 1000 records (``page = o_orderkey div 1000 + 1``),
    one ``page=<n>`` folder each, records in key order; ``only``: the records
    that the API would send."""
    orders = sf_table(spark, sf, "orders")
    if only is not None:
        orders = orders.where(only)
    rec = F.struct(
        F.col("o_orderkey").alias("_k"),
        (status if status is not None else F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("deviceStatus"),
        F.col("o_orderkey").cast("string").alias("mendixUID"),
        F.col("o_custkey").cast("string").alias("mendixPID"),
        F.col("o_orderkey").alias("serialNumber"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("procedureDate"),
        format_timestamp("o_orderdate").alias("inputDate"),
        F.coalesce(modified, format_timestamp("o_orderdate")).alias("modifiedDate") if modified is not None
        else format_timestamp("o_orderdate").alias("modifiedDate"),
        (F.col("o_totalprice") > 200000).alias("isResolving"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("completedDate"),
        F.lit("n/a").alias("unknownField"),
    )
    pages = (orders.groupBy((F.floor(F.col("o_orderkey") / 1000) + 1).alias("page"))
             .agg(F.sort_array(F.collect_list(rec)).alias("r"))
             .select("page", F.transform("r", lambda x: x.dropFields("_k")).alias("deviceResponseData")))
    pages.write.partitionBy("page").json(dest)


def q09_paged_api(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q09")
    stage_pages(spark, sf, f"{area}/pages")
    frame = api_frame(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 4}, run_ts=RUN_TS,
                      stage_path=f"{area}/landed")
    ts_cols = [t for _, t, ty, _, _ in DEVICE_FIELDS if ty == "timestamp"] + ["update_ts"]
    return ntz(frame, *ts_cols)


def q20_last_page_wins(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q20")
    stage_pages(spark, sf, f"{area}/pages")
    frame = api_frame(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 3},
                      run_ts=RUN_TS, keys=["patient_id"], stage_path=f"{area}/landed", on_page_duplicate="last")
    return frame.select("patient_id", "mendix_uid")


def q26_api_cdc_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole CDC job twice: a first load from an initial watermark, then a
    delta where urgent orders changed status; the second run starts from the
    watermark the first one logged."""
    from landfall.plans.api_job import run_api_cdc

    area = scratch(spark, "q26")
    cfg = spark.createDataFrame([(1, "https://api.invalid/devices", "MDX", "device", "modified_date")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                                "source_delta_column STRING")
    jobs = spark.createDataFrame([("j1", "device_cdc", {"layer": "SDH", "schema": "MDX", "object": "DEVICE_CDC"})],
                                 "job_id STRING, name STRING, tags MAP<STRING,STRING>")
    stage_pages(spark, sf, f"{area}/pages1")
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).otherwise(F.col("o_orderstatus"))
    touched = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("01/01/2030 12:30:00")).otherwise(format_timestamp("o_orderdate"))
    # what is not older than the first run's watermark: every page of the table has such records
    stage_pages(spark, sf, f"{area}/pages2", status=changed, modified=touched, only=F.col("o_orderpriority") == "1-URGENT")
    common = dict(target=f"{area}/target", audit=f"{area}/audit", jobs=jobs, notebook_name="device_cdc",
                  job_tags={"layer": "SDH", "schema": "MDX", "object": "DEVICE_CDC"}, rows_per_part=20_000,
                  table_name=f"landfall.{_own('device', area)}")
    run_api_cdc(spark, cfg, "device", run_ts=RUN_TS, initial_watermark="01/01/1990",
                transport={"transport": "files", "path": f"{area}/pages1"}, **common)
    second = run_api_cdc(spark, cfg, "device", run_ts=RUN_TS_2,
                         transport={"transport": "files", "path": f"{area}/pages2"}, **common)
    newest = sf_table(spark, sf, "orders").agg(format_timestamp(F.max("o_orderdate")).alias("m")).first()["m"]
    if second["watermark_used"] != newest:
        raise AssertionError(f"second run did not start from the newest modified date {newest}: {second}")
    out = spark.table(common["table_name"])
    return ntz(out.select("mendix_uid", "patient_id", "status", "device_status", "modified_date", "update_ts"),
               "modified_date", "update_ts")


# ---------------------------------------------------------------- columns, filters
def q10_zip_explode(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q10")
    stage_nested(spark, sf, f"{area}/drop")
    from landfall.plans.file_jobs import NESTED_HINT
    source = FileSource(input_path=f"{area}/drop", file_format="json", glob_filter="*.json",
                        schema_hints=NESTED_HINT, schema_location=f"{area}/schema")
    df = nested_json_transform(RUN_TS, literal=True)(source.batch(spark))
    return ntz(df, "update_ts")


def q11_load_stamp(spark: SparkSession, sf: str) -> DataFrame:
    cust = sf_table(spark, sf, "customer").select("c_custkey")
    return ntz(with_stamp(cust, run_ts=RUN_TS), "update_ts")


def q12_high_watermark(spark: SparkSession, sf: str) -> DataFrame:
    ev = sf_table(spark, sf, "events")
    audit = ev.select(F.lit("events").alias("object_name"), F.lit("app").alias("source_name"),
                      F.initcap("event_type").alias("run_status"), F.col("ts").alias("latest_update_dt"))
    return high_watermark(audit, equals={"object_name": "events", "source_name": "app"}, status="purchase")


def q13_dynamic_max(spark: SparkSession, sf: str) -> DataFrame:
    return column_max(sf_table(spark, sf, "orders"), "O_ORDERDATE")


def q14_map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ev = sf_table(spark, sf, "events")
    jobs = ev.select("event_id", F.map_concat(F.from_json("props", "map<string,string>"),
                                              F.create_map(F.lit("type"), F.col("event_type"))).alias("tags"))
    return jobs.where(map_entries_equal("tags", {"type": "purchase"})).select("event_id", F.col("tags")["k"].alias("k"))


def q15_strict_ts(spark: SparkSession, sf: str) -> DataFrame:
    ev = sf_table(spark, sf, "events").select("event_id", format_timestamp("ts").alias("txt"))
    return ntz(ev.select("event_id", strict_timestamp("txt").alias("parsed")), "parsed")


def q16_lenient_ts(spark: SparkSession, sf: str) -> DataFrame:
    ev = sf_table(spark, sf, "events")
    txt = (F.when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
           .when(F.col("event_type") == "view", format_timestamp("ts"))
           .when(F.col("event_type") == "click", F.lit(""))
           .otherwise(F.date_format("ts", "MM/dd/yyyy")))
    return ntz(ev.select("event_id", lenient_timestamp(txt).alias("parsed")), "parsed")


def q17_config_lookup(spark: SparkSession, sf: str) -> DataFrame:
    cust = sf_table(spark, sf, "customer")
    seg = F.lower("c_mktsegment")
    config = cust.select(
        F.col("c_custkey").cast("int").alias("ref_id"),
        F.concat(F.lit("/landing/"), seg, F.lit("/"), F.col("c_custkey").cast("string")).alias("input_path"),
        F.when(F.col("c_nationkey") < 10, "csv").otherwise("json").alias("file_format"),
        F.concat(F.lit("/schemas/"), F.col("c_custkey").cast("string")).alias("schema_path"),
        F.concat(F.lit("/checkpoints/"), F.col("c_custkey").cast("string")).alias("checkpoint_path"),
        F.lit("main").alias("table_catalog"), seg.alias("table_schema"),
        F.concat(F.lit("t_"), F.col("c_custkey").cast("string")).alias("ingst_tbl_name"),
        F.lit("*.csv").alias("glob_filter"))
    return lookup(config, "ref_id", 7)


def q18_changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    cust = sf_table(spark, sf, "customer")
    altered = cust.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") == 3, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return changed_rows(cust, altered, ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def q19_merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q19")
    # one segment's customers come without a key, in the target and in the source
    key = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("c_custkey")
    cust = sf_table(spark, sf, "customer")
    table = Table(spark, f"{area}/target", f"landfall.{_own('merged', area)}")
    merge_into(table, cust.where(F.col("c_nationkey") < 15).select(key, *cust.columns[1:]), ["c_custkey"], rows_per_part=500, run_ts=RUN_TS)
    source = cust.where(F.col("c_nationkey") >= 10).select(
        key, "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_acctbal") < 1000, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    merge_into(table, source, ["c_custkey"], run_ts=RUN_TS_2)
    return ntz(spark.table(table.name).drop(PART), "update_ts")


def q21_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(sf_table(spark, sf, "orders"), ["o_custkey"])


def q22_audit_duration(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q22")
    ev = sf_table(spark, sf, "events")
    runs = ev.groupBy("user_id").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
                                     F.max_by("event_type", "ts").alias("last_type"))
    runs = runs.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("user_id").cast("int").alias("object_id"),
        F.lit("events").alias("object_name"), F.lit("app").alias("source_name"),
        F.concat(F.lit("/Workspace/jobs/n"), F.col("user_id").cast("string")).alias("notebook_path"),
        F.col("end_time").alias("latest_update_dt"), "start_time", "end_time",
        F.when(F.col("last_type") == "error", "FAILURE").otherwise("SUCCESS").alias("run_status"),
        F.lit("CDC_RUN").alias("log_step"))
    log = AuditLog(spark, f"{area}/audit")
    log.append(runs)
    out = log.read().select("run_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                            F.col("end_time").cast("timestamp_ntz").alias("end_time"),
                            "duration_sec", "run_status", "notebook_name")
    return out


# ---------------------------------------------------------------- run semantics
def q23_replay_safe(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q23")
    orders = sf_table(spark, sf, "orders")
    stage_files(orders, "parquet", f"{area}/drop", "orders", max(4, files_for(_rows(orders), 20_000)))
    source = FileSource(input_path=f"{area}/drop", file_format="parquet", glob_filter="*.parquet",
                        schema_location=f"{area}/schema", max_files_per_trigger=1)
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state")
    failed = []

    def crash_once(df, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected failure after the batch was written")

    try:
        job.run(after_write=crash_once)
    except Exception:
        pass
    if not failed:
        raise AssertionError("the injected failure did not happen")
    job.run()                           # resumes the open run, replays batch 1
    return job.table.read()


def q24_snapshot_replace(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q24")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    source = FileSource(input_path=f"{area}/drop", file_format="csv", glob_filter="*.csv",
                        schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state", replace=True)
    for ver in ("run1", "run2"):
        rows = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
                             F.lit(ver).alias("ver"))
        stage_files(rows, "csv", f"{area}/drop", ver, n)
        job.run()
    return spark.table(job.table.name)


def q25_add_columns(spark: SparkSession, sf: str) -> DataFrame:
    area = scratch(spark, "q25")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    table = Table(spark, f"{area}/table")
    stage_files(orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"),
                "parquet", f"{area}/drop_a", "a", n)
    stage_files(orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_totalprice", "o_orderstatus"),
                "parquet", f"{area}/drop_b", "b", n)
    for name in ("a", "b"):
        source = FileSource(input_path=f"{area}/drop_{name}", file_format="parquet", glob_filter="*.parquet",
                            schema_location=f"{area}/schema_{name}")
        FileFeedJob(source=source, transform=lambda df: df, table=table, state_dir=f"{area}/state_{name}",
                    replace=False).run()
    return table.read()


def q27_include_existing(spark: SparkSession, sf: str) -> DataFrame:
    """``include_existing=false``: files already in the folder at the feed's
    first run are never loaded; later arrivals are, also when they keep an older
    time stamp than that run's."""
    area = scratch(spark, "q27")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    stage_files(orders.where(F.col("o_orderstatus") == "F"), "parquet", f"{area}/drop", "before", n)
    source = FileSource(input_path=f"{area}/drop", file_format="parquet", glob_filter="*.parquet",
                        schema_location=f"{area}/schema", include_existing=False)
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"),
                      state_dir=f"{area}/state", replace=False)
    job.run()
    for path in stage_files(orders.where(F.col("o_orderstatus") != "F"), "parquet", f"{area}/drop", "after", n):
        fs.set_times(spark, path, OLD_MS)
    job.run()
    return job.table.read()


def q28_cdc_failure_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A page with a timestamp in the wrong text format fails the run (strict
    parse): FAILURE is logged, nothing is merged, the watermark stays; the
    corrected rerun logs SUCCESS with MAX(modified_date) of the target."""
    from landfall.plans.api_job import run_api_cdc

    area = scratch(spark, "q28")
    cfg = spark.createDataFrame([(1, "https://api.invalid/devices", "MDX", "device", "modified_date")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                                "source_delta_column STRING")
    broken = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
    stage_pages(spark, sf, f"{area}/bad", modified=broken)
    stage_pages(spark, sf, f"{area}/good")
    common = dict(target=f"{area}/target", audit=f"{area}/audit", initial_watermark="01/01/1990",
                  run_ts=RUN_TS)
    try:
        run_api_cdc(spark, cfg, "device", transport={"transport": "files", "path": f"{area}/bad"}, **common)
        raise AssertionError("the run with malformed timestamps did not fail")
    except AssertionError:
        raise
    except Exception:
        pass
    run_api_cdc(spark, cfg, "device", transport={"transport": "files", "path": f"{area}/good"}, **common)
    log = AuditLog(spark, f"{area}/audit").read()
    return log.select("run_status", "object_name", "source_name", F.col("run_id").rlike("^[0-9a-f-]{36}$").alias("has_run_id"),
                      F.col("latest_update_dt").cast("timestamp_ntz").alias("latest_update_dt"))


# ---------------------------------------------------------------- what a feed must not lose
def q29_late_files(spark: SparkSession, sf: str) -> DataFrame:
    """A stream feed's second run loads files far older than those of the first."""
    area = scratch(spark, "q29")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    stage_files(orders.where(F.col("o_orderstatus") == "F"), "parquet", f"{area}/drop", "now", n)
    source = FileSource(input_path=f"{area}/drop", file_format="parquet", glob_filter="*.parquet", schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"), state_dir=f"{area}/state",
                      replace=False)
    job.run()
    for path in stage_files(orders.where(F.col("o_orderstatus") != "F"), "parquet", f"{area}/drop", "late", n):
        fs.set_times(spark, path, OLD_MS)
    job.run()
    return job.table.read()


def q30_infer_every_file(spark: SparkSession, sf: str) -> DataFrame:
    """More than a thousand files, a field only in the oldest, and in a later
    run another field in a file with an even older time stamp."""
    area = scratch(spark, "q30")
    cust = sf_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    old, later = F.col("c_nationkey") == 3, F.col("c_nationkey") == 4
    (first,) = stage_files(cust.where(old), "json", f"{area}/drop", "oldest", 1)
    fs.set_times(spark, first, OLD_MS)
    stage_files(cust.where(~old & ~later).select("c_custkey", "c_name"), "json", f"{area}/drop", "many", max(1010, _rows(cust) // 20_000))
    source = FileSource(input_path=f"{area}/drop", file_format="json", glob_filter="*.json", schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"), state_dir=f"{area}/state",
                      replace=False, allow_overwrites=True, files_per_batch=2000)
    job.run()
    (second,) = stage_files(cust.where(later).withColumn("c_note", F.upper("c_name")), "json", f"{area}/drop", "later", 1)
    fs.set_times(spark, second, OLD_MS - 1000)
    job.run()
    return job.table.read().select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_note")


def q31_key_in_odd_places(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose bodies carry the list's key as a value, nested and escaped, read by three partitions."""
    area = scratch(spark, "q31")
    orders = sf_table(spark, sf, "orders")
    # small pages, up to the API's limit where there would be too many of them
    size = min(1000, max(100, _rows(orders) // 3000))
    page = (F.floor(F.col("o_orderkey") / size) + 1).alias("page")
    records = orders.groupBy(page).agg(F.to_json(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("mendixUID")))).alias("r"))
    body = F.array(F.lit('{"source":"deviceResponseData","deviceResponseData":%s}'),
                   F.lit('{"meta":{"deviceResponseData":[]},"deviceResponseData":%s}'),
                   F.lit('{"note":"\\\\"deviceResponseData\\\\": []","deviceResponseData":%s}'.replace("\\\\", "\\")))[
        (F.col("page") % 3).cast("int")]
    records.select("page", F.replace(body, F.lit("%s"), F.col("r")).alias("value")).write.partitionBy("page").text(f"{area}/pages")
    frame = api_frame(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 3}, run_ts=RUN_TS, stage_path=f"{area}/landed")
    return frame.select("mendix_uid")


def q32_request_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Failed request attempts of a run that succeeds and of one that fails, as audited."""
    from landfall.plans.api_job import run_api_cdc

    area = scratch(spark, "q32")
    cfg = spark.createDataFrame([(1, "https://api.invalid/devices", "MDX", "device", "modified_date")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, source_delta_column STRING")
    stage_pages(spark, sf, f"{area}/pages")
    common = dict(target=f"{area}/target", audit=f"{area}/audit", initial_watermark="01/01/1990", run_ts=RUN_TS)
    flaky = {"transport": "files", "path": f"{area}/pages", "retries": 2, "source": FaultyApi}
    try:
        run_api_cdc(spark, cfg, "device", transport={**flaky, "failPages": "2:2"}, **common)
        raise AssertionError("the run with a page that cannot be read did not fail")
    except FetchFailed:
        pass
    run_api_cdc(spark, cfg, "device", transport={**flaky, "failPages": "1:1,2:1"}, **common)
    return AuditLog(spark, f"{area}/audit").read().select("run_status", "log_step")


def q38_records_lost(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of which some hold a record that Spark's JSON parser refuses (nested too deeply): the run fails, names
    the first such page and leaves the watermark; a run over the repaired pages loads every record.  Returns the audit
    log with the number of rows in the target after each run."""
    from landfall.plans.api_job import run_api_cdc

    area = scratch(spark, "q38")
    cfg = spark.createDataFrame([(1, "https://api.invalid/devices", "MDX", "device", "modified_date")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, source_delta_column STRING")
    orders = sf_table(spark, sf, "orders")
    page = (F.floor(F.col("o_orderkey") / 1000) + 1).alias("page")
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("mendixUID"), format_timestamp("o_orderdate").alias("modifiedDate")))
    deep = F.concat(F.lit('{"mendixUID":"deep","x":'), F.repeat(F.lit("["), 1100), F.repeat(F.lit("]"), 1100), F.lit("}"))
    records = orders.groupBy(page).agg(F.concat_ws(",", F.collect_list(record)).alias("r"))
    body = lambda r: F.concat(F.lit('{"deviceResponseData":['), r, F.lit("]}")).alias("value")
    broken = F.when(F.col("page") % 2 == 0, F.concat_ws(",", deep, "r")).otherwise(F.col("r"))
    records.select("page", body(broken)).write.partitionBy("page").text(f"{area}/broken")
    records.select("page", body(F.col("r"))).write.partitionBy("page").text(f"{area}/whole")
    common = dict(target=f"{area}/target", audit=f"{area}/audit", initial_watermark="01/01/1990", run_ts=RUN_TS)
    try:
        run_api_cdc(spark, cfg, "device", transport={"transport": "files", "path": f"{area}/broken"}, **common)
        raise AssertionError("the run that lost records did not fail")
    except RecordsLost:
        pass
    table = Table(spark, f"{area}/target")
    before = table.read().count() if table.exists() else 0
    out = run_api_cdc(spark, cfg, "device", transport={"transport": "files", "path": f"{area}/whole"}, **common)
    if not out["watermark_used"].startswith("01/01/1990"):
        raise AssertionError("the failed run moved the watermark")
    after = table.read().agg(F.count("*").alias("n"))
    log = AuditLog(spark, f"{area}/audit").read()
    return log.crossJoin(F.broadcast(after)).select(
        "run_status", F.regexp_extract("log_step", r"page \d+: \d+ records sent, \d+ read", 0).alias("step"),
        F.when(F.col("run_status") == "SUCCESS", F.col("n")).otherwise(F.lit(before)).alias("rows_after"))


def q39_rescue_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that the schema lacks inside array elements and structs, from JSON lines and from files that hold one JSON array."""
    area = scratch(spark, "q39")
    orders = sf_table(spark, sf, "orders")
    plain = F.format_string('{"k": %d, "a": [{"x": %d}], "s": {"p": {"q": "%s"}}}', "o_orderkey", "o_custkey", "o_orderstatus")
    more = F.format_string('{"k": %d, "a": [{"x": %d, "y": "%s"}, {"x": 1}], "s": {"p": {"q": "%s", "r": [1, 2]}, "z": {}}}',
                           "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    text = F.when(F.col("o_orderstatus") == "P", more).otherwise(plain)
    orders.select(text.alias("value")).write.text(f"{area}/lines")
    groups = F.floor(F.col("o_orderkey") / 5000).alias("g")
    orders.groupBy(groups).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(text), ",\n"), F.lit("\n]")).alias("value")) \
        .write.partitionBy("g").text(f"{area}/arrays")
    out = None
    for form, options in (("lines", {}), ("arrays", {"multiLine": True})):
        source = FileSource(input_path=f"{area}/{form}", file_format="json", schema="k BIGINT, a ARRAY<STRUCT<x: BIGINT>>, s STRUCT<p: STRUCT<q: STRING>>",
                            rescued_data_column="_rescued_data", options=options)
        job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/{form}_table"), state_dir=f"{area}/{form}_state",
                          allow_overwrites=True)
        job.run()
        part = job.table.read().select(F.lit(form).alias("form"), "k", F.col("a")[0]["x"].alias("x"), F.size("a").cast("long").alias("n"),
                                       F.col("s.p.q").alias("q"), "_rescued_data")
        out = part if out is None else out.unionByName(part)
    return out


def q40_late_field(spark: SparkSession, sf: str) -> DataFrame:
    """Files with a field of their own that arrive after a stream run inferred its schema."""
    area = scratch(spark, "q40")
    orders = sf_table(spark, sf, "orders")
    n = files_for(_rows(orders), 30_000)
    plain = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    later = orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    late = []

    def arrive(df: DataFrame) -> DataFrame:
        """The transform is made between inference and the stream's own listing."""
        if not late:
            late.append(stage_files(later, "json", f"{area}/drop", "late", n))
        return df

    source = FileSource(input_path=f"{area}/drop", file_format="json", glob_filter="*.json", schema_location=f"{area}/schema",
                        max_files_per_trigger=2)
    job = FileFeedJob(source=source, transform=arrive, table=Table(spark, f"{area}/table"), state_dir=f"{area}/state")
    stage_files(plain, "json", f"{area}/drop", "plain", n)
    job.run()
    return job.table.read()


def _with_schema(spark: SparkSession, area: str, label: str) -> str:
    name = f"lf_{label}_{area.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{area}/catalog'")
    return name


def q33_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A feed found in a config table by its id as text, loaded twice, read with ``spark.table``."""
    area = scratch(spark, "q33")
    schema = _with_schema(spark, area, "q33")
    cust = sf_table(spark, sf, "customer")
    config = cust.select(
        F.col("c_custkey").cast("int").alias("ref_id"), F.lit(f"{area}/drop").alias("input_path"), F.lit("csv").alias("file_format"),
        F.lit(f"{area}/schema").alias("schema_path"), F.lit(f"{area}/state").alias("checkpoint_path"), F.lit("main").alias("table_catalog"),
        F.lit(schema).alias("table_schema"), F.concat(F.lit("leaders_"), "c_custkey").alias("ingst_tbl_name"), F.lit("*.csv").alias("glob_filter"))
    config.write.saveAsTable(f"{schema}.feeds")
    rows = cust.select(F.col("c_custkey").cast("string").alias("Network Id"), F.col("c_name").alias("Leader Name"))
    for half in (0, 1):
        stage_files(rows.where(F.col("c_custkey") % 2 == half), "csv", f"{area}/drop", f"half{half}", files_for(_rows(cust)))
        run_feed(spark, f"{schema}.feeds", "7", "csv", tables_root=f"{area}/tables", run_ts=RUN_TS, replace=False)
    return ntz(spark.table(f"{schema}.leaders_7").drop(PART), "update_ts")


def q34_catalog_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log as a catalog table, its watermark by SQL."""
    area = scratch(spark, "q34")
    schema = _with_schema(spark, area, "q34")
    ev = sf_table(spark, sf, "events")
    log = AuditLog(spark, f"{area}/audit", f"{schema}.audit_log")
    for kind in ("purchase", "view"):
        log.append(ev.where(F.col("event_type") == kind).select(
            F.col("event_id").cast("string").alias("run_id"), F.lit("events").alias("object_name"), F.lit("app").alias("source_name"),
            F.when(F.col("event_type") == "purchase", "Success").otherwise("FAILURE").alias("run_status"),
            F.col("ts").cast("timestamp").alias("latest_update_dt"), F.col("ts").cast("timestamp").alias("start_time"),
            F.col("ts").cast("timestamp").alias("end_time")))
    return ntz(high_watermark_sql(spark, f"{schema}.audit_log", "events", "app"), "latest_update_dt")


def q35_csv_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of three header layouts, the first again after the table has grown."""
    area = scratch(spark, "q35")
    cust = sf_table(spark, sf, "customer").select(F.format_string("%06d", "c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                  F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"))
    n = files_for(_rows(cust))
    part = lambda k: cust.where(F.col("nation").cast("int") % 4 == k)
    source = FileSource(input_path=f"{area}/drop", file_format="csv", glob_filter="*.csv", schema_location=f"{area}/schema")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"), state_dir=f"{area}/state",
                      replace=False, allow_overwrites=True)
    stage_files(part(0).select("id", "name"), "csv", f"{area}/drop", "a", n)
    stage_files(part(1).select("name", "id"), "csv", f"{area}/drop", "b", n)
    job.run()
    stage_files(part(2).select("segment", "id", "nation"), "csv", f"{area}/drop", "c", n)
    job.run()
    stage_files(part(3).select("id", "name"), "csv", f"{area}/drop", "d", n)
    job.run()
    return job.table.read().select("id", "name", "segment", "nation")


def q36_rescue_everything(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines that are cut off and values of the wrong type are kept in the rescue column."""
    area = scratch(spark, "q36")
    orders = sf_table(spark, sf, "orders")
    line = F.when(F.col("o_orderstatus") == "P", F.format_string('{"k": %d, "n": {"z":', "o_orderkey")).when(
        F.col("o_orderstatus") == "F", F.format_string('{"k": %d, "n": {"z":1}}', "o_orderkey")).otherwise(
        F.format_string('{"k": %d, "n": 5, "more": "x"}', "o_orderkey"))
    orders.select(line.alias("value")).write.text(f"{area}/drop")
    source = FileSource(input_path=f"{area}/drop", file_format="json", schema="k BIGINT, n INT", rescued_data_column="_rescued_data")
    job = FileFeedJob(source=source, transform=lambda df: df, table=Table(spark, f"{area}/table"), state_dir=f"{area}/state")
    job.run()
    return job.table.read()


def q37_csv_rewritten(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV job itself: files rewritten in place are read again, one of them with a glob sign in its name."""
    area = scratch(spark, "q37")
    cust = sf_table(spark, sf, "customer")
    n = files_for(_rows(cust))

    def stage(kind: str, ver: str) -> None:
        rows = cust.where((F.col("c_custkey") % 3 == 0) == (kind == "leaders[1]"))
        stage_files(rows.select(F.col("c_custkey").cast("string").alias("Network Id"), F.concat("c_name", F.lit(ver)).alias("Leader Name")),
                    "csv", f"{area}/drop", kind, n)

    job = feed_job(spark, _config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables", run_ts=RUN_TS, replace=False)
    stage("leaders[1]", "-v1")
    stage("plain", "-v1")
    job.run()
    stage("leaders[1]", "-v2")
    job.run()
    return ntz(job.table.read(), "update_ts")


QUERIES = {
    "q01_csv_ingest": q01_csv_ingest,
    "q02_tsv_ingest": q02_tsv_ingest,
    "q03_json_flat": q03_json_flat,
    "q04_json_nested": q04_json_nested,
    "q05_glob_filter": q05_glob_filter,
    "q06_changed_files": q06_changed_files,
    "q07_schema_memory": q07_schema_memory,
    "q08_rescued": q08_rescued,
    "q09_paged_api": q09_paged_api,
    "q10_zip_explode": q10_zip_explode,
    "q11_load_stamp": q11_load_stamp,
    "q12_high_watermark": q12_high_watermark,
    "q13_dynamic_max": q13_dynamic_max,
    "q14_map_lookup": q14_map_lookup,
    "q15_strict_ts": q15_strict_ts,
    "q16_lenient_ts": q16_lenient_ts,
    "q17_config_lookup": q17_config_lookup,
    "q18_changed_rows": q18_changed_rows,
    "q19_merge_upsert": q19_merge_upsert,
    "q20_last_page_wins": q20_last_page_wins,
    "q21_duplicate_keys": q21_duplicate_keys,
    "q22_audit_duration": q22_audit_duration,
    "q23_replay_safe": q23_replay_safe,
    "q24_snapshot_replace": q24_snapshot_replace,
    "q25_add_columns": q25_add_columns,
    "q26_api_cdc_job": q26_api_cdc_job,
    "q27_include_existing": q27_include_existing,
    "q28_cdc_failure_audit": q28_cdc_failure_audit,
    "q29_late_files": q29_late_files,
    "q30_infer_every_file": q30_infer_every_file,
    "q31_key_in_odd_places": q31_key_in_odd_places,
    "q32_request_attempts": q32_request_attempts,
    "q33_catalog_table": q33_catalog_table,
    "q34_catalog_watermark": q34_catalog_watermark,
    "q35_csv_layouts": q35_csv_layouts,
    "q36_rescue_everything": q36_rescue_everything,
    "q37_csv_rewritten": q37_csv_rewritten,
    "q38_records_lost": q38_records_lost,
    "q39_rescue_nested": q39_rescue_nested,
    "q40_late_field": q40_late_field,
}
