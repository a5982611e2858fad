"""Audit log, run status and the high watermark."""

from datetime import datetime

import pytest

from landfall.operators.watermark import column_max, high_watermark
from landfall.plans.api_job import initial_text
from landfall.plans.audit import AuditLog, audited_run


def test_watermark_from_success_rows_only(spark, area):
    log = AuditLog(spark, f"{area}/audit")
    assert log.watermark("obj", "src") is None                       # no row yet
    ident = dict(object_id=1, object_name="obj", source_name="src")
    log.log(run_id="r1", latest_update_dt=datetime(2024, 1, 5), run_status="FAILURE", **ident)
    assert log.watermark("obj", "src") is None                       # only FAILURE rows
    log.log(run_id="r2", latest_update_dt=datetime(2024, 1, 3), run_status="Success", **ident)
    log.log(run_id="r3", latest_update_dt=None, run_status="SUCCESS", **ident)
    log.log(run_id="r4", latest_update_dt=datetime(2024, 2, 1), run_status="SUCCESS", object_id=1,
            object_name="other", source_name="src")
    assert log.watermark("obj", "src") == datetime(2024, 1, 3)


def test_audited_run_logs_success_and_failure(spark, area):
    log = AuditLog(spark, f"{area}/audit")
    with audited_run(log, object_id=1, object_name="o", source_name="s") as ctx:
        ctx.latest_update_dt = datetime(2024, 3, 1)
    with pytest.raises(ZeroDivisionError):
        with audited_run(log, object_id=1, object_name="o", source_name="s"):
            1 / 0
    got = sorted((r.run_status, r.latest_update_dt) for r in log.read().collect())
    assert got == [("FAILURE", None), ("SUCCESS", datetime(2024, 3, 1))]
    rows = log.read().collect()
    assert all(r.duration_sec is not None and float(r.duration_sec) >= 0 for r in rows)
    assert any("ZeroDivisionError" in r.log_step for r in rows)


def test_zero_duration_is_stored_as_zero(spark, area):
    log = AuditLog(spark, f"{area}/audit")
    t = datetime(2024, 1, 1)
    log.log(run_id="r", start_time=t, end_time=t, run_status="SUCCESS")
    assert log.read().first().duration_sec == "0.000000"


def test_watermark_text_and_initial_value(spark, area):
    log = AuditLog(spark, f"{area}/audit")
    assert log.watermark_text("o", "s") is None
    log.append(spark.sql("SELECT 'r' AS run_id, 'o' AS object_name, 's' AS source_name, 'SUCCESS' AS run_status, "
                         "timestamp '2024-01-02 03:04:05' AS latest_update_dt, timestamp '2024-01-02' AS start_time, "
                         "timestamp '2024-06-02' AS end_time"))
    assert log.watermark_text("o", "s") == "01/02/2024 03:04:05"
    assert log.read().first().duration_sec == "13132800.000000"         # no exponent, however long
    assert initial_text("01/02/2024") == "01/02/2024 00:00:00"
    for bad in (None, "2024-01-02"):
        with pytest.raises(ValueError):
            initial_text(bad)


def test_error_text_is_logged_whole(spark, area):
    log = AuditLog(spark, f"{area}/audit")
    with pytest.raises(RuntimeError):
        with audited_run(log, object_name="o", source_name="s"):
            raise RuntimeError("x" * 5000 + " the end")
    assert log.read().first().log_step.endswith("the end")


def test_high_watermark_and_dynamic_column(spark):
    df = spark.createDataFrame([("o", "s", "success", datetime(2024, 1, 1)), ("o", "s", "FAILURE", datetime(2025, 1, 1))],
                               "object_name STRING, source_name STRING, run_status STRING, latest_update_dt TIMESTAMP")
    assert high_watermark(df, equals={"object_name": "o"}).first()[0] == datetime(2024, 1, 1)
    assert column_max(df, "LATEST_update_DT").first()[0] == datetime(2025, 1, 1)
    assert column_max(df, "missing").first()[0] is None


def test_sql_watermark_matches_dataframe_form(spark, area):
    from landfall.operators.watermark import high_watermark_sql

    log = AuditLog(spark, f"{area}/audit")
    ident = dict(object_id=1, object_name="obj", source_name="src")
    log.log(run_id="a", latest_update_dt=datetime(2024, 1, 3), run_status="success", **ident)
    log.log(run_id="b", latest_update_dt=datetime(2024, 2, 3), run_status="FAILURE", **ident)
    log.table.register_view("audit_log_view")
    got = high_watermark_sql(spark, "audit_log_view", "obj", "src").first()[0]
    assert got == log.watermark("obj", "src") == datetime(2024, 1, 3)
    assert high_watermark_sql(spark, "audit_log_view", "obj' OR '1'='1", "src").first()[0] is None
