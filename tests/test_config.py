import pytest

from landfall.plans.config import ApiConfig, ConfigNotFound, FeedConfig, job_for_tags, lookup_row, parse_ref_id


def test_parse_ref_id():
    assert parse_ref_id("12") == 12
    for bad in ("", "x1", "-3", "1.5"):
        with pytest.raises(ValueError):
            parse_ref_id(bad)


def _feeds(spark):
    cols = "ref_id INT, input_path STRING, file_format STRING, schema_path STRING, checkpoint_path STRING, " \
           "table_catalog STRING, table_schema STRING, ingst_tbl_name STRING, glob_filter STRING"
    return spark.createDataFrame([(1, "/in/a", "csv", "/s/a", "/c/a", "cat", "sch", "a", "*.csv"),
                                  (2, "/in/b", "json", "/s/b", "/c/b", "cat", "sch", "b", "*.json"),
                                  (2, "/in/b2", "json", "/s/b", "/c/b", "cat", "sch", "b", "*.json")], cols)


def test_feed_config_lookup(spark):
    cfg = FeedConfig.load(_feeds(spark), "1")
    assert cfg.input_path == "/in/a" and cfg.table_name == "sch.a"
    with pytest.raises(ConfigNotFound):
        FeedConfig.load(_feeds(spark), "9")
    with pytest.raises(ValueError):          # two rows: the pick would be arbitrary
        FeedConfig.load(_feeds(spark), "2")


def test_api_config_lower_cases_names(spark):
    df = spark.createDataFrame([(7, "http://x", "MDX", "Device", "modified_date")],
                               "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                               "source_delta_column STRING")
    cfg = ApiConfig.load(df, "Device")
    assert (cfg.source_name, cfg.object_name) == ("mdx", "device")
    with pytest.raises(ConfigNotFound):
        lookup_row(df, "object_name", "device")       # the lookup itself is case-sensitive


def test_job_for_tags_missing_key_does_not_match(spark):
    jobs = spark.createDataFrame([("1", "other", {"layer": "SDH"}),
                                  ("2", "cdc", {"layer": "SDH", "schema": "MDX", "object": "DEVICE_CDC"})],
                                 "job_id STRING, name STRING, tags MAP<STRING,STRING>")
    assert job_for_tags(jobs, {"layer": "SDH", "schema": "MDX"}).job_name == "cdc"
    assert job_for_tags(jobs, {"layer": "XX"}) is None
