"""Change-detecting upsert: against a dict model, idempotence, NULL keys,
duplicate keys, later page wins, bulk versus page-by-page."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from landfall.operators.merge import (DuplicateKeyError, changed_rows, duplicate_keys, latest_per_key,
                                      merge_frames, merge_into)
from landfall.operators import merge as M
from landfall.tables import PART, Table

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SCHEMA = "k INT, v STRING, w INT"


def model(target: dict, source: list, ts):
    """Reference semantics on plain Python values: key -> (v, w, stamp)."""
    out = dict(target)
    inserted_null = []
    for k, v, w in source:
        if k is None:
            inserted_null.append((None, v, w, ts))
        elif k not in out or out[k][:2] != (v, w):
            out[k] = (v, w, ts)
    return sorted([(k, *val) for k, val in out.items()] + inserted_null, key=repr)


def as_rows(table):
    return sorted([(r.k, r.v, r.w, str(r.update_ts)) for r in table.read().collect()], key=repr)


vals = st.one_of(st.none(), st.sampled_from(["a", "b"]))
ints = st.one_of(st.none(), st.integers(0, 2))
source_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), vals, ints), max_size=12,
                       unique_by=lambda r: r[0])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=source_rows, second=source_rows)
def test_merge_matches_dict_model(spark, tmp_path_factory, first, second):
    area = str(tmp_path_factory.mktemp("m"))
    t = Table(spark, f"{area}/t")
    merge_into(t, spark.createDataFrame(first, SCHEMA), ["k"], rows_per_part=4, run_ts=T0)
    merge_into(t, spark.createDataFrame(second, SCHEMA), ["k"], run_ts=T1)
    start = {k: (v, w, "2024-01-01 00:00:00") for k, v, w in first if k is not None}
    first_nulls = [(None, v, w, "2024-01-01 00:00:00") for k, v, w in first if k is None]
    expect = [(k, v, w, str(ts)) for k, v, w, ts in model(start, second, "2024-02-01 00:00:00") + first_nulls]
    assert as_rows(t) == sorted(expect, key=repr)


def test_merge_is_idempotent_and_detects_change_to_null(spark, area):
    t = Table(spark, f"{area}/t")
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    merge_into(t, src, ["k"], rows_per_part=4, run_ts=T0)
    merge_into(t, src, ["k"], run_ts=T1)                     # same rows: nothing changes
    assert {r.update_ts.isoformat(sep=" ") for r in t.read().collect()} == {T0}
    merge_into(t, spark.createDataFrame([(2, None, 2)], SCHEMA), ["k"], run_ts=T2)
    got = {r.k: (r.v, r.update_ts.isoformat(sep=" ")) for r in t.read().collect()}
    assert got == {1: ("a", T0), 2: (None, T2)}


def test_null_keys_are_inserted_every_run(spark, area):
    t = Table(spark, f"{area}/t")
    src = spark.createDataFrame([(None, "x", 1), (1, "a", 1)], SCHEMA)
    merge_into(t, src, ["k"], rows_per_part=4, run_ts=T0)
    merge_into(t, src, ["k"], run_ts=T1)
    assert sorted((r.k is None) for r in t.read().collect()) == [False, True, True]


def test_duplicate_source_keys_raise(spark, area):
    t = Table(spark, f"{area}/t")
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (None, "n", 1), (None, "m", 1)], SCHEMA)
    assert rows(duplicate_keys(src, ["k"])) == [(1, 2)]
    with pytest.raises(DuplicateKeyError):
        merge_into(t, src, ["k"], rows_per_part=4)


def test_latest_per_key_later_page_wins_and_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "p1", 1, 0), (1, "p2", 2, 5), (1, "p2b", 2, 7), (2, "x", 1, 3),
                                (None, "n1", 1, 1), (None, "n2", 2, 0)],
                               "k INT, v STRING, page INT, position INT")
    got = rows(latest_per_key(df, ["k"], ["page", "position"]), "k", "v")
    assert got == sorted([(1, "p2b"), (2, "x"), (None, "n1"), (None, "n2")], key=repr)


def test_bulk_merge_equals_page_by_page(spark, area):
    pages = [[(1, "a", 1), (2, "b", 1)], [(2, "c", 1), (3, "d", 1)], [(1, "e", 2)]]
    by_page = Table(spark, f"{area}/p")
    for p in pages:
        merge_into(by_page, spark.createDataFrame(p, SCHEMA), ["k"], rows_per_part=4, run_ts=T0)
    flat = [(k, v, w, i, j) for i, p in enumerate(pages) for j, (k, v, w) in enumerate(p)]
    src = latest_per_key(spark.createDataFrame(flat, SCHEMA + ", page INT, position INT"), ["k"],
                         ["page", "position"]).drop("page", "position")
    bulk = Table(spark, f"{area}/b")
    merge_into(bulk, src, ["k"], rows_per_part=4, run_ts=T0)
    assert as_rows(by_page) == as_rows(bulk)


def test_merge_frames_actions_and_changed_rows(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 2), (3, "c", 9), (4, "d", 4)], SCHEMA)
    acts = {r.k: r.merge_action for r in merge_frames(tgt, src, ["k"], stamp_column=None).collect()}
    assert acts == {1: "keep", 2: "unchanged", 3: "update", 4: "insert"}
    assert rows(changed_rows(tgt, src, ["k"], ["v", "w"]), "k") == [(3,)]


def test_new_source_column_extends_the_table(spark, area):
    t = Table(spark, f"{area}/t")
    merge_into(t, spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k"], rows_per_part=4, run_ts=T0)
    merge_into(t, spark.createDataFrame([(2, "b", 2, "z")], SCHEMA + ", extra STRING"), ["k"], run_ts=T1)
    got = {r.k: r.extra for r in t.read().collect()}
    assert got == {1: None, 2: "z"}


def test_tracked_maximum_equals_scan_and_survives_time_zone_change(spark, area):
    from datetime import datetime

    from landfall.operators.merge import table_max
    t = Table(spark, f"{area}/t")
    schema = "k INT, d TIMESTAMP"
    merge_into(t, spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 3, 1)),
                                         (None, datetime(2024, 4, 1))], schema),
               ["k"], rows_per_part=4, run_ts=T0, track_max=["d"])
    assert table_max(t, "D") == datetime(2024, 4, 1)
    merge_into(t, spark.createDataFrame([(2, datetime(2023, 1, 1))], schema), ["k"], run_ts=T1, track_max=["d"])
    scanned = t.read().agg({"d": "max"}).first()[0]
    assert table_max(t, "d") == scanned == datetime(2024, 4, 1)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert table_max(t, "d") == t.read().agg({"d": "max"}).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merge_frames_with_a_column_new_to_the_target(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    src = spark.createDataFrame([(1, "a", 1, None), (2, "b", 2, "z")], SCHEMA + ", extra STRING")
    got = {r.k: (r.merge_action, r.extra) for r in merge_frames(tgt, src, ["k"], stamp_column=None).collect()}
    assert got == {1: ("unchanged", None), 2: ("update", "z")}


def test_hot_key_and_hot_null_bucket(spark, area):
    from pyspark.sql import functions as F

    n = 3000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit("v").alias("v"), F.lit(1).alias("w"))
    t = Table(spark, f"{area}/t")
    merge_into(t, base, ["k"], rows_per_part=400, run_ts=T0)                 # a third of the rows have a NULL key
    assert t.read().count() == n
    src = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(7)).otherwise(F.col("id")).cast("int").alias("k"),
                                F.lit("x").alias("v"), F.col("id").cast("int").alias("w"),
                                F.floor(F.col("id") / 100).cast("int").alias("page"),
                                (F.col("id") % 100).cast("int").alias("position"))
    # a third of the source rows carry key 7: reported once, reduced to its latest row
    assert rows(duplicate_keys(src, ["k"])) == [(7, n // 3)]
    latest = latest_per_key(src, ["k"], ["page", "position"]).drop("page", "position")
    assert latest.where("k = 7").first().w == n // 3 - 1
    merge_into(t, latest, ["k"], run_ts=T1)
    got = t.read()
    inserted = sum(1 for i in range(n // 3, n) if i % 3 == 0)         # keys the target held as NULL rows
    assert got.count() == n + inserted
    assert got.where("k IS NULL").count() == n // 3
    assert got.where("k = 7").first().w == n // 3 - 1                 # the hot key updated once


def test_tracked_ntz_maximum_survives_time_zone_change(spark, area):
    from datetime import datetime

    from landfall.operators.merge import table_max
    t = Table(spark, f"{area}/t")
    df = spark.createDataFrame([(1, datetime(2024, 5, 1, 12, 30)), (2, datetime(2024, 1, 1))], "k INT, d TIMESTAMP_NTZ")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        merge_into(t, df, ["k"], rows_per_part=4, run_ts=T0, track_max=["d"])
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert table_max(t, "d") == datetime(2024, 5, 1, 12, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_unique_source_mode_skips_the_key_shuffle(spark, area):
    t = Table(spark, f"{area}/t")
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], SCHEMA)
    merge_into(t, src, ["k"], rows_per_part=4, run_ts=T0, on_duplicate="unique")
    merge_into(t, spark.createDataFrame([(2, "c", 2)], SCHEMA), ["k"], run_ts=T1, on_duplicate="unique")
    assert sorted((r.k, r.v) for r in t.read().collect() if r.k is not None) == [(1, "a"), (2, "c")]
    assert t.read().count() == 3


lp_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(1, 3), st.integers(0, 5)),
                   max_size=15, unique_by=lambda r: (r[1], r[2]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=lp_rows)
def test_latest_per_key_matches_model(spark, data):
    rows_ = [(k, f"v{p}.{q}", p, q) for k, p, q in data]
    best = {}
    for k, v, p, q in rows_:
        if k is not None and (k not in best or (p, q) > best[k][1:]):
            best[k] = (v, p, q)
    expect = sorted([(k, v) for k, (v, _, _) in best.items()] + [(None, v) for k, v, _, _ in rows_ if k is None],
                    key=repr)
    df = spark.createDataFrame(rows_, "k INT, v STRING, page INT, position INT")
    got = sorted(((r.k, r.v) for r in latest_per_key(df, ["k"], ["page", "position"]).collect()), key=repr)
    assert got == expect


def part_files(table):
    """part -> (folder, rows)"""
    from pyspark.sql import functions as F

    rows = table.spark.table(table.name).groupBy(PART).agg(F.count("*").alias("n")).collect()
    return {r[PART]: (table.part_location(r[PART]), r["n"]) for r in rows}


def test_only_touched_parts_are_rewritten(spark, area):
    from pyspark.sql import functions as F

    t = Table(spark, f"{area}/t")
    base = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("w"))
    merge_into(t, base, ["k"], rows_per_part=100, run_ts=T0)
    before = part_files(t)
    assert len(before) == 10 and sum(n for _, n in before.values()) == 1000
    home = {r.k: r[PART] for r in spark.table(t.name).collect()}
    merge_into(t, base.where("k IN (3, 700)").withColumn("v", F.lit("x")), ["k"], run_ts=T1)
    after = part_files(t)
    assert {p for p in after if after[p] != before[p]} == {home[3], home[700]}
    assert t.read().where("v = 'x'").count() == 2 and t.read().count() == 1000
    # a key stays in its part
    assert {r.k: r[PART] for r in spark.table(t.name).collect()} == home


def test_new_rows_fill_the_last_part_and_then_their_own(spark, area):
    from pyspark.sql import functions as F

    t = Table(spark, f"{area}/t")
    batch = lambda a, b: spark.range(a, b).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("w"))
    merge_into(t, batch(0, 10), ["k"], rows_per_part=25, run_ts=T0)
    merge_into(t, batch(10, 25), ["k"], run_ts=T0)
    assert [n for _, n in part_files(t).values()] == [25]
    merge_into(t, batch(25, 26), ["k"], run_ts=T0)
    assert sorted(n for _, n in part_files(t).values()) == [1, 25]
    merge_into(t, batch(100, 180), ["k"], run_ts=T0)
    sizes = sorted(n for _, n in part_files(t).values())
    assert len(sizes) == 6 and sum(sizes) == 106
    assert t.read().select("k").distinct().count() == 106


def test_replaced_folders_stay_until_the_next_merge(spark, area):
    import os

    t = Table(spark, f"{area}/t")
    one = lambda v: spark.createDataFrame([(1, v, 1)], SCHEMA)
    merge_into(t, one("a"), ["k"], run_ts=T0)
    (first, _), = part_files(t).values()
    merge_into(t, one("b"), ["k"], run_ts=T1)
    (second, _), = part_files(t).values()
    local = lambda p: p.removeprefix("file:")
    assert first != second and os.path.exists(local(first))
    merge_into(t, one("c"), ["k"], run_ts=T2)
    assert not os.path.exists(local(first)) and os.path.exists(local(second))
    assert [r.v for r in t.read().collect()] == ["c"]


def test_a_merge_cut_off_between_parts_is_finished_by_the_next(spark, area, monkeypatch):
    from datetime import datetime

    t = Table(spark, f"{area}/t")
    schema = "k INT, d TIMESTAMP"
    rows_ = [(i, datetime(2024, 1, 1 + i)) for i in range(12)]
    merge_into(t, spark.createDataFrame(rows_, schema), ["k"], rows_per_part=3, run_ts=T0, track_max=["d"])
    later = spark.createDataFrame([(k, datetime(2024, 2, 1 + k)) for k, _ in rows_] + [(99, datetime(2024, 3, 1))], schema)
    real, moved = Table.move_parts, []

    def half(self, folders):
        some = dict(sorted(folders.items())[:2])
        moved.append(some)
        real(self, some)
        raise RuntimeError("the driver died")

    monkeypatch.setattr(Table, "move_parts", half)
    with pytest.raises(RuntimeError):
        merge_into(t, later, ["k"], run_ts=T1, track_max=["d"])
    monkeypatch.undo()
    assert t.read().count() == 12 and t.read().select("k").distinct().count() == 12      # each key once, old or new
    assert M.table_max(t, "d") == t.read().agg({"d": "max"}).first()[0]                  # not the value of before
    merge_into(t, later, ["k"], run_ts=T2, track_max=["d"])
    assert sorted(map(tuple, t.read().select("k", "d").collect())) == sorted(map(tuple, later.collect()))
    assert M.table_max(t, "d") == datetime(2024, 3, 1)


def test_tracked_maximum_that_goes_down_is_scanned(spark, area):
    """The row that held it is changed to an older value: other parts must be looked at."""
    from datetime import datetime

    t = Table(spark, f"{area}/t")
    schema = "k INT, d TIMESTAMP"
    merge_into(t, spark.createDataFrame([(i, datetime(2024, 1, 1 + i)) for i in range(20)], schema), ["k"], rows_per_part=5, run_ts=T0,
               track_max=["d"])
    merge_into(t, spark.createDataFrame([(19, datetime(2020, 1, 1))], schema), ["k"], run_ts=T1, track_max=["d"])
    assert M.table_max(t, "d") == datetime(2024, 1, 19) == t.read().agg({"d": "max"}).first()[0]
    merge_into(t, spark.createDataFrame([(i, None) for i in range(20)], schema), ["k"], run_ts=T2, track_max=["d"])
    assert M.table_max(t, "d") is None


def test_columns_widen_on_merge(spark, area):
    t = Table(spark, f"{area}/t")
    merge_into(t, spark.createDataFrame([(1, 5, 1.5), (2, 6, 2.5)], "k INT, n INT, x FLOAT"), ["k"], rows_per_part=1, run_ts=T0)
    merge_into(t, spark.createDataFrame([(2, 1 << 40, 0.1), (3, 7, 0.2)], "k INT, n BIGINT, x DOUBLE"), ["k"], run_ts=T1)
    assert dict(t.read().dtypes)["n"] == "bigint" and dict(t.read().dtypes)["x"] == "double"
    assert sorted((r.k, r.n, r.x) for r in t.read().collect()) == [(1, 5, 1.5), (2, 1 << 40, 0.1), (3, 7, 0.2)]


def test_composite_and_text_keys(spark, area):
    t = Table(spark, f"{area}/t")
    schema = "a STRING, b INT, v STRING"
    merge_into(t, spark.createDataFrame([("x", 1, "1"), ("x", 2, "2"), ("y", 1, "3"), ("y", None, "4")], schema), ["a", "b"], rows_per_part=2, run_ts=T0)
    merge_into(t, spark.createDataFrame([("x", 2, "new"), ("z", 9, "5"), ("y", None, "6")], schema), ["a", "b"], run_ts=T1)
    got = sorted(((r.a, r.b, r.v) for r in t.read().collect()), key=repr)
    assert got == sorted([("x", 1, "1"), ("x", 2, "new"), ("y", 1, "3"), ("y", None, "4"), ("y", None, "6"), ("z", 9, "5")], key=repr)


def test_empty_source_changes_nothing(spark, area):
    t = Table(spark, f"{area}/t")
    merge_into(t, spark.createDataFrame([], SCHEMA), ["k"], run_ts=T0)
    assert t.read().count() == 0 and t.read().columns == ["k", "v", "w", "update_ts"]
    merge_into(t, spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k"], run_ts=T0)
    before = part_files(t)
    merge_into(t, spark.createDataFrame([], SCHEMA), ["k"], run_ts=T1)
    assert part_files(t) == before
