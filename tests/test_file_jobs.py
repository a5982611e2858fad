"""The four file-drop jobs on hand-written edge inputs (FIXTURES section 3)."""

import pytest
from pyspark.sql.utils import StreamingQueryException

from conftest import own_name, rows, write
from landfall.plans.config import FeedConfig
from landfall.plans.file_jobs import feed_job, run_feed

TS = "2024-01-01 00:00:00"


def config(area, fmt, glob, ref_id=1):
    return FeedConfig(ref_id, f"{area}/drop", fmt, f"{area}/schema", f"{area}/state", "main", "landfall", own_name(area), glob)


def test_csv_positional_rename_and_glob(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n2,two\n")
    write(f"{area}/drop/b.csv", "Id,Name\n3,\n")                   # empty value -> NULL
    write(f"{area}/drop/c.csv", "Id,Name\n")                        # empty file
    write(f"{area}/drop/notes.txt", "not,a,feed\n")                 # skipped by the glob
    job = feed_job(spark, config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables", run_ts=TS)
    job.run()
    out = job.table.read()
    assert out.columns == ["network_id", "nleader_name", "update_ts"]
    assert rows(out, "network_id", "nleader_name") == [("1", "one"), ("2", "two"), ("3", None)]


def test_csv_extra_column_fails_arity(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name,Extra\n1,one,x\n")
    job = feed_job(spark, config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables")
    with pytest.raises(ValueError, match="positional rename"):
        job.run()


def test_csv_columns_are_matched_by_header_name(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n")
    job = feed_job(spark, config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables")
    job.run()                                                       # schema remembered: Id, Name
    write(f"{area}/drop/b.csv", "Name,Id\ntwo,2\n")
    job = feed_job(spark, config(area, "csv", "*.csv"), "csv", tables_root=f"{area}/tables", new_columns="ignore")
    job.run()
    assert rows(job.table.read(), "network_id", "nleader_name") == [("2", "two")]


def test_csv_stream_refuses_another_header(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n")
    options = dict(tables_root=f"{area}/tables", allow_overwrites=False, new_columns="ignore")
    feed_job(spark, config(area, "csv", "*.csv"), "csv", **options).run()
    write(f"{area}/drop/b.csv", "Name,Id\ntwo,2\n")
    with pytest.raises(StreamingQueryException, match="header"):
        feed_job(spark, config(area, "csv", "*.csv"), "csv", **options).run()


def test_tsv_drop_rename_filter_and_passthrough(spark, area):
    header = "User Division ID\tUser Division \tDivision Parent ID\tDivision Parent \tTotal User Count\t" \
             "Active User Count\tExtra Col\n"
    write(f"{area}/drop/a.tsv", header + "1\tSales\t10\tRoot\t5\t4\tx\n\tNoId\t10\tRoot\t1\t1\ty\n"
                                "2\tOps\t10\tRoot\t1\t1\tz\tspill\n")
    job = feed_job(spark, config(area, "tsv", "*.tsv"), "tsv", tables_root=f"{area}/tables", run_ts=TS)
    job.run()
    out = job.table.read()
    # listed columns renamed, the absent "Inactive User Count"/"Division GUID" drops ignored,
    # the unlisted column passes through, the row without an id is gone
    assert out.columns == ["division_id", "division_name", "parent_division_id", "parent_division_name",
                           "Extra Col", "_rescued_data", "update_ts"]
    # the whole line is judged, also for columns the job drops
    assert rows(out, "division_id", "division_name", "Extra Col", "_rescued_data") == [
        ("1", "Sales", "x", None), ("2", "Ops", "z", "2\tOps\t10\tRoot\t1\t1\tz\tspill")]


def test_flat_json_fixed_schema(spark, area):
    write(f"{area}/drop/a.json", "\n".join([
        '{"TaskId": 1, "TimeUpdated": "u1", "TimeCreated": "c1", "UserId": "p1", "Other": 5}',
        '{"TaskId": "2", "TimeCreated": "c2"}',
        'this is not json',
    ]) + "\n")
    job = feed_job(spark, config(area, "json", "*.json"), "json_flat", tables_root=f"{area}/tables", run_ts=TS)
    job.run()
    out = job.table.read()
    assert out.columns == ["taskid", "timecreated", "timeupdated", "activeapprovers_userid", "update_ts"]
    assert rows(out, "taskid", "timecreated", "timeupdated", "activeapprovers_userid") == [
        ("1", "c1", "u1", "p1"), ("2", "c2", None, None), (None, None, None, None)]


def test_nested_json_edges(spark, area):
    write(f"{area}/drop/a.json", "\n".join([
        '{"approvalFactDelegatee": [{"SourceSystem": "S", "UserId": 7, "ApprovableId": "A1", "TimeUpdated": "t",'
        ' "Approver": "p", "ApprovalActivationDate": "d"}, {"ApprovableId": "A2"}]}',
        '{"approvalFactDelegatee": []}',
        '{"approvalFactDelegatee": null}',
        '{"approvalFactDelegatee": [null]}',
        '{"other": 1}',
    ]) + "\n")
    job = feed_job(spark, config(area, "json", "*.json"), "json_nested", tables_root=f"{area}/tables", run_ts=TS)
    job.run()
    out = job.table.read()
    assert out.columns == ["approvableid", "approver", "approvalactivationdate", "timeupdated", "sourcesystem",
                           "userid", "update_ts"]
    assert rows(out, "approvableid", "userid", "sourcesystem") == [
        ("A1", "7", "S"), ("A2", None, None), (None, None, None)]


def test_nested_json_pretty_printed_needs_multiline(spark, area):
    write(f"{area}/drop/a.json", '{\n  "approvalFactDelegatee": [\n    {"ApprovableId": "A1"}\n  ]\n}\n')
    job = feed_job(spark, config(area, "json", "*.json"), "json_nested", tables_root=f"{area}/tables",
                   reader_options={"multiLine": True})
    job.run()
    assert rows(job.table.read(), "approvableid") == [("A1",)]


def test_run_feed_from_config_table(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n")
    cfg = config(area, "csv", "*.csv", ref_id=4)
    table = spark.createDataFrame([tuple(cfg.__dict__.values())],
                                  "ref_id INT, input_path STRING, file_format STRING, schema_path STRING, "
                                  "checkpoint_path STRING, table_catalog STRING, table_schema STRING, "
                                  "ingst_tbl_name STRING, glob_filter STRING")
    res = run_feed(spark, table, "4", "csv", tables_root=f"{area}/tables")
    assert res.published and res.batches == 1
    with pytest.raises(ValueError):
        run_feed(spark, table, "abc", "csv", tables_root=f"{area}/tables")


def test_config_from_catalog_table_and_sql_view(spark, area):
    write(f"{area}/drop/a.csv", "Id,Name\n1,one\n")
    cfg = config(area, "csv", "*.csv", ref_id=5)
    spark.createDataFrame([tuple(cfg.__dict__.values())],
                          "ref_id INT, input_path STRING, file_format STRING, schema_path STRING, "
                          "checkpoint_path STRING, table_catalog STRING, table_schema STRING, "
                          "ingst_tbl_name STRING, glob_filter STRING").createOrReplaceTempView("feed_config")
    run_feed(spark, "feed_config", "5", "csv", tables_root=f"{area}/tables")
    job = feed_job(spark, cfg, "csv", tables_root=f"{area}/tables")
    job.table.register_view("landed")
    assert spark.sql("SELECT network_id FROM landed").collect()[0][0] == "1"


import time as _time

SECOND_RUN = {
    "csv": ("csv", "*.csv", "a.csv", "Id,Name\n1,one\n", "b.csv", "Id,Name\n2,two\n", "network_id", ["2"]),
    "tsv": ("tsv", "*.tsv", "a.tsv", "User Division ID\tUser Division \n1\tx\n", "b.tsv",
            "User Division ID\tUser Division \n2\ty\n", "division_id", ["2"]),
    "json_flat": ("json", "*.json", "a.json", '{"TaskId": "1"}\n', "b.json", '{"TaskId": "2"}\n', "taskid", ["2"]),
    "json_nested": ("json", "*.json", "a.json", '{"approvalFactDelegatee": [{"ApprovableId": "1"}]}\n', "b.json",
                    '{"approvalFactDelegatee": [{"ApprovableId": "2", "New": "n"}], "top": 1}\n',
                    "approvableid", ["2"]),
}


@pytest.mark.parametrize("job", sorted(SECOND_RUN))
def test_every_job_reruns_with_new_arrivals(spark, area, job):
    fmt, glob, f1, body1, f2, body2, col, expect = SECOND_RUN[job]
    write(f"{area}/drop/{f1}", body1)
    j = feed_job(spark, config(area, fmt, glob), job, tables_root=f"{area}/tables", run_ts=TS)
    j.run()
    _time.sleep(1.1)
    write(f"{area}/drop/{f2}", body2)
    j = feed_job(spark, config(area, fmt, glob), job, tables_root=f"{area}/tables", run_ts=TS)
    j.run()
    assert [r[0] for r in rows(j.table.read(), col)] == expect


def test_headers_are_read_from_the_first_bytes(spark, area):
    """Bytes read don't grow with the file, nothing is sorted, odd files and names are read."""
    import gzip

    from landfall.sources.files import FileSource
    from landfall.sources.headers import first_lines
    from landfall.sources.ledger import listing

    write(f"{area}/drop/big.csv", "id,name\n" + "1,some text to fill the file\n" * 200_000)
    write(f"{area}/drop/odd [1] %41.csv", "\r\n\r\nname,id\r\nx,2\r\n")
    write(f"{area}/drop/wide.csv", ",".join(f"column{i}" for i in range(9000)) + "\n")
    write(f"{area}/drop/one.csv", "id,name")
    write(f"{area}/drop/empty.csv", "")
    with gzip.open(f"{area}/drop/z.csv.gz", "wt") as f:
        f.write("id,zipped\n7,8\n")
    lines = first_lines(listing(spark, f"{area}/drop"))
    got = {r.path.rsplit("/", 1)[1]: (r.line, r.bytes_read) for r in lines.collect()}
    assert set(got) == {"big.csv", "odd [1] %41.csv", "wide.csv", "one.csv", "z.csv.gz"}
    assert got["big.csv"][0] == got["one.csv"][0] == "id,name" and got["big.csv"][1] <= 1 << 14
    assert got["odd [1] %41.csv"][0] == "name,id" and got["z.csv.gz"][0] == "id,zipped"
    assert got["wide.csv"][0].endswith("column8999") and got["wide.csv"][1] <= 8 * (1 << 14)
    plan = lines._jdf.queryExecution().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    src = FileSource(f"{area}/drop", "csv", "o*.csv")
    assert src.resolve_schema(spark).names == ["id", "name"] or src.resolve_schema(spark).names == ["name", "id"]
    assert src.batch(spark).select("name", "id").collect() == [("x", "2")]


def test_header_lines_that_cross_a_block(spark, area):
    from landfall.sources.headers import STEP, first_line

    import io

    for text in ("é" * STEP + "\nrest", "a" * (STEP - 1) + "\r\nrest", "\n" * (3 * STEP) + "late\n", "a\u2028b\x0bc\nrest"):
        want = next(x for x in text.replace("\r\n", "\n").split("\n") if x)
        assert first_line(io.BytesIO(text.encode()), "utf-8")[0] == want
    assert first_line(io.BytesIO("käse,x\r\n1,2".encode("latin-1")), "latin-1")[0] == "käse,x"
    assert first_line(io.BytesIO(b""), "utf-8") == ("", 0)
