"""Inputs built from the tables: what a task holds does not grow with them."""

import pytest

from landfall import scenarios as S


def test_nested_records_are_grouped_in_parts_that_grow_in_number(spark, area, monkeypatch):
    spark.range(300).selectExpr("id div 3 AS l_orderkey", "CAST(id % 3 * 3 + 1 AS INT) AS l_linenumber", "'A' AS l_returnflag", "id AS l_partkey",
                                "'O' AS l_linestatus", "timestamp'2024-01-01' AS l_shipdate").write.parquet(f"{area}/sf/lineitem.parquet")
    spark.range(120).selectExpr("id AS o_orderkey", "if(id % 2 = 0, 'F', 'O') AS o_orderstatus").write.parquet(f"{area}/sf/orders.parquet")
    made = []
    monkeypatch.setattr(S, "stage_files", lambda df, *a, **k: made.append(df))
    monkeypatch.setattr(S, "ROWS_PER_TASK", 10, raising=False)
    S.stage_nested(spark, f"{area}/sf", f"{area}/drop")
    (df,) = made
    rows = [(r.OrderKey, r.approvalFactDelegatee) for r in df.collect()]
    assert len(rows) == 300 - 100 + 20           # lines 1 and 4 of an order are in one record, line 7 in the next
    assert sum(len(a or []) for _, a in rows) == 300
    assert sorted(k for k, a in rows if not a) == list(range(100, 120))
    assert df.rdd.getNumPartitions() >= 30


@pytest.mark.parametrize("keys,pages", [(1_000, 10), (600_000, 3_000)])
def test_small_pages_grow_before_there_are_too_many(spark, area, monkeypatch, keys, pages):
    spark.range(keys).selectExpr("id AS o_orderkey").write.parquet(f"{area}/sf/orders.parquet")
    seen = []

    class Stop(Exception):
        pass

    def stop(df, *a):
        seen.append(df.count())
        raise Stop

    monkeypatch.setattr("pyspark.sql.DataFrame.write", property(stop), raising=False)
    monkeypatch.setattr(type(spark.range(1)), "write", property(stop), raising=False)
    with pytest.raises(Stop):
        S.q31_key_in_odd_places(spark, f"{area}/sf")
    assert seen == [pages]
