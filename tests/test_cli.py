"""Command-line entry points, run in-process on the test session."""

import json

from conftest import own_name, write
from landfall.cli import main


def test_file_feed_command(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n2,two\n")
    spark.createDataFrame([(9, f"{area}/drop", "csv", f"{area}/schema", f"{area}/state", "main", "landfall", own_name(area),
                            "*.csv")],
                          "ref_id INT, input_path STRING, file_format STRING, schema_path STRING, "
                          "checkpoint_path STRING, table_catalog STRING, table_schema STRING, "
                          "ingst_tbl_name STRING, glob_filter STRING").createOrReplaceTempView("cli_feeds")
    out = main(["file-feed", "--config-table", "cli_feeds", "--ref-id", "9", "--job", "csv",
                "--tables-root", f"{area}/tables"])
    assert out["batches"] == 1 and out["published"]


def test_api_cdc_command(spark, area):
    recs = [{"mendixUID": "1", "modifiedDate": "01/02/2024 00:00:00"}]
    write(f"{area}/pages/page=1/part-0.json", json.dumps({"deviceResponseData": recs}) + "\n")
    spark.createDataFrame([(1, "https://api.invalid", "MDX", "device", "modified_date")],
                          "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                          "source_delta_column STRING").createOrReplaceTempView("cli_api")
    out = main(["api-cdc", "--config-table", "cli_api", "--object-name", "device", "--target", f"{area}/target",
                "--audit", f"{area}/audit", "--pages-path", f"{area}/pages", "--initial-watermark", "01/01/2024",
                "--rows-per-part", "4"])
    assert out["latest_update_dt"] == "2024-01-02 00:00:00"
