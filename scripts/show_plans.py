"""Print the physical plans of the engine's key operators.

    python scripts/show_plans.py [sf_dir] > plans.txt

Inputs are built from the tables into a scratch folder first; each section is
the ``explain("formatted")`` of what the engine runs.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from landfall import scenarios as S  # noqa: E402
from landfall.fixtures import sf_table, stage_files  # noqa: E402
from landfall.operators import merge as M  # noqa: E402
from landfall.plans.api_job import api_frame  # noqa: E402
from landfall.plans.file_jobs import NESTED_HINT, nested_json_transform, tsv_transform  # noqa: E402
from landfall.session import build_session, scratch, session_conf  # noqa: E402
from landfall.sources.files import FileSource  # noqa: E402
from landfall.sources.ledger import FileLedger, listing  # noqa: E402
from landfall.tables import PART, Table  # noqa: E402


def section(title, df):
    print(f"\n===== {title} =====")
    df.explain("formatted")


def written(spark, area: str, view: str) -> None:
    """The plan of writing a view into a parquet table."""
    name = f"plan_of_{view}_{area.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{area}/{view}' AS SELECT * FROM {view} LIMIT 0")
    print(spark.sql(f"EXPLAIN FORMATTED INSERT INTO {name} SELECT * FROM {view}").collect()[0][0])
    spark.sql(f"DROP TABLE {name}")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    area = scratch(spark, "plans")

    cust = sf_table(spark, sf, "customer")
    tsv = cust.select(F.col("c_custkey").cast("string").alias("User Division ID"), F.col("c_name").alias("User Division "),
                      F.col("c_nationkey").cast("string").alias("Division Parent ID"),
                      F.col("c_mktsegment").alias("Division Parent "), F.lit("1").alias("Total User Count"))
    stage_files(tsv, "tsv", f"{area}/tsv", "d", 2)
    src = FileSource(f"{area}/tsv", "csv", "*.tsv", options={"sep": "\t"})
    section("TSV job: drop, rename, stamp, IS NOT NULL (batch form of one micro-batch)",
            tsv_transform("2024-01-01")(src.batch(spark)))

    S.stage_nested(spark, sf, f"{area}/nested")
    n = FileSource(f"{area}/nested", "json", "*.json", schema_hints=NESTED_HINT)
    section("Nested JSON job: inline flatten", nested_json_transform("2024-01-01")(n.batch(spark)))

    ledger = FileLedger(spark, f"{area}/ledger")
    ledger.record(listing(spark, f"{area}/tsv", "*.tsv"), "run-0", 1)
    ledger.settle("run-0")
    section("Changed-file discovery: binaryFile listing anti-joined with the ledger",
            ledger.changed(f"{area}/tsv", "*.tsv"))

    S.stage_pages(spark, sf, f"{area}/pages")
    frame = api_frame(spark, {"transport": "files", "path": f"{area}/pages", "numPartitions": 4},
                      stage_path=f"{area}/landed")
    section("Paged API: landed records -> last page wins per key (group limit)", frame)

    orders = sf_table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    t = Table(spark, f"{area}/target")
    M.merge_into(t, orders, ["k"], rows_per_part=5000, run_ts="2024-01-01")
    target, delta = spark.table(t.name), orders.where(F.col("o_orderstatus") == "P")
    section("Merge: the parts that hold matching keys, from the key column within the source's range", M.located(target, delta, ["k"]))
    found = M.located(target, delta, ["k"])
    merged = M.merge_frames(target.where(F.col(PART).isin(t.parts()[:2])), found, ["k"], run_ts="2024-02-01", extra_join=[PART], split_nulls=False)
    section("Merge: touched parts and their rows, full outer join on (part, key)", merged)
    print("\n===== Merge, written: rebalanced by part =====")
    merged.hint("rebalance", PART).createOrReplaceTempView("merged")
    written(spark, area, "merged")
    tsv_transform("2024-01-01")(src.batch(spark)).createOrReplaceTempView("rows")
    print("\n===== Load, written: scan, project, filter and write in one stage =====")
    written(spark, area, "rows")


if __name__ == "__main__":
    main()
