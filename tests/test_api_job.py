"""The CDC job end to end over captured pages: success, failure paths, watermark."""

import json
from datetime import datetime

import pytest

from conftest import write
from landfall.operators.merge import DuplicateKeyError
from landfall.plans.api_job import run_api_cdc
from landfall.plans.audit import AuditLog
from landfall.tables import Table


def pages(root, *pages_):
    for p, recs in enumerate(pages_, start=1):
        write(f"{root}/page={p}/part-0.json", json.dumps({"deviceResponseData": recs}) + "\n")


def rec(uid, modified, **extra):
    return {"mendixUID": uid, "modifiedDate": modified, "status": "A", **extra}


@pytest.fixture
def cfg(spark):
    return spark.createDataFrame([(3, "https://api.invalid", "MDX", "Device", "modified_date")],
                                 "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                                 "source_delta_column STRING")


def run(spark, cfg, area, folder, **kw):
    return run_api_cdc(spark, cfg, "Device", target=f"{area}/target", audit=f"{area}/audit",
                       transport={"transport": "files", "path": f"{area}/{folder}"}, rows_per_part=4,
                       num_partitions=2, **kw)


def test_first_run_needs_initial_watermark_then_advances(spark, cfg, area):
    pages(f"{area}/p1", [rec("1", "01/02/2024 00:00:00"), rec("2", "01/05/2024 10:00:00")],
          [rec("2", "01/06/2024 00:00:00", status="B")], [])
    with pytest.raises(ValueError, match="initial_watermark"):
        run(spark, cfg, area, "p1")
    out = run(spark, cfg, area, "p1", initial_watermark="01/01/2024")
    assert out["watermark_used"] == "01/01/2024 00:00:00"
    assert out["latest_update_dt"] == datetime(2024, 1, 6)
    got = {r.mendix_uid: r.status for r in Table(spark, f"{area}/target").read().collect()}
    assert got == {"1": "A", "2": "B"}                           # the later page won
    pages(f"{area}/p2", [rec("3", "01/07/2024 00:00:00")])
    out = run(spark, cfg, area, "p2")
    assert out["watermark_used"] == "01/06/2024 00:00:00"
    log = AuditLog(spark, f"{area}/audit").read().collect()
    assert sorted(r.run_status for r in log) == ["SUCCESS", "SUCCESS"]
    assert {r.object_name for r in log} == {"device"} and {r.source_name for r in log} == {"mdx"}


@pytest.mark.parametrize("bad, error", [
    ([rec("1", "2024-01-02")], Exception),                                   # strict timestamp text
    ([rec("1", "01/02/2024 00:00:00", isResolving="true")], Exception),      # boolean sent as text
    ([rec("1", "01/02/2024 00:00:00"), rec("1", "01/03/2024 00:00:00")], DuplicateKeyError),
])
def test_failures_are_audited_and_leave_the_target(spark, cfg, area, bad, error):
    pages(f"{area}/bad", bad)
    with pytest.raises(error):
        run(spark, cfg, area, "bad", initial_watermark="01/01/2024")
    log = AuditLog(spark, f"{area}/audit").read().collect()
    assert [r.run_status for r in log] == ["FAILURE"]
    assert log[0].latest_update_dt is None
    assert not Table(spark, f"{area}/target").exists()


def test_json_booleans_parse(spark, cfg, area):
    pages(f"{area}/ok", [rec("1", "01/02/2024 00:00:00", isResolving=True, IsAutoCompleted=False)])
    run(spark, cfg, area, "ok", initial_watermark="01/01/2024")
    r = Table(spark, f"{area}/target").read().first()
    assert (r.isresolving, r.isautocompleted) == (True, False)


def test_missing_delta_column_logs_null_and_success(spark, area):
    cfg = spark.createDataFrame([(3, "https://api.invalid", "MDX", "Device", "no_such_column")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, "
                                "source_delta_column STRING")
    pages(f"{area}/p", [rec("1", "01/02/2024 00:00:00")])
    out = run(spark, cfg, area, "p", initial_watermark="01/01/2024")
    assert out["latest_update_dt"] is None
    log = AuditLog(spark, f"{area}/audit").read().collect()
    assert [(r.run_status, r.latest_update_dt) for r in log] == [("SUCCESS", None)]


ZONE_SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from landfall.session import build_session
from landfall.scenarios import q26_api_cdc_job
spark = build_session("local[2]", shuffle_partitions=4)
out = q26_api_cdc_job(spark, {sf!r})
print("ROWS", out.count(), out.where("modified_date = TIMESTAMP_NTZ '2030-01-01 12:30:00'").count())
"""


def test_watermark_does_not_depend_on_the_host_zone(tmp_path):
    """The scenario itself checks that the second run asks from the newest date in the data."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "zone.py"
    script.write_text(ZONE_SCRIPT.format(repo=repo, sf="/root/testdata/sf0.001"))
    done = subprocess.run([sys.executable, str(script)], env={**os.environ, "TZ": "Asia/Kolkata"}, capture_output=True, text=True, timeout=300,
                          cwd=repo)
    assert done.returncode == 0, done.stderr[-2000:]
    total, changed = map(int, done.stdout.split("ROWS")[1].split())
    assert total == 1500 and 0 < changed < total


def test_time_zone_of_the_api_is_an_option(spark, area):
    """Texts are parsed and the watermark is written in the given zone; the session's zone is put back."""
    import json

    from conftest import write
    from landfall.plans.api_job import run_api_cdc

    cfg = spark.createDataFrame([(1, "https://api.invalid", "MDX", "device", "modified_date")],
                                "object_id INT, source_url STRING, source_name STRING, object_name STRING, source_delta_column STRING")
    write(f"{area}/pages/page=1/a.json", json.dumps({"deviceResponseData": [{"mendixUID": "1", "modifiedDate": "06/01/2024 10:00:00"}]}))
    common = dict(target=f"{area}/t", audit=f"{area}/a", transport={"transport": "files", "path": f"{area}/pages"}, rows_per_part=2,
                  initial_watermark="01/01/2020", time_zone="America/New_York")
    run_api_cdc(spark, cfg, "device", **common)
    assert run_api_cdc(spark, cfg, "device", **common)["watermark_used"] == "06/01/2024 10:00:00"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    from landfall.tables import Table
    got = Table(spark, f"{area}/t").read().selectExpr("CAST(unix_seconds(modified_date) AS BIGINT) AS s").first().s
    assert got == 1717250400                                   # 14:00 UTC
