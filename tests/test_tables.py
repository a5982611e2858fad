import pytest
from pyspark.sql import types as T

from landfall.tables import SchemaConflict, Table, evolve_schema
from landfall.streaming.loads import publish, write_batch


def test_evolve_schema_adds_new_columns_at_the_end(spark):
    a = T.StructType.fromDDL("x INT, y STRING")
    b = T.StructType.fromDDL("Y STRING, z DOUBLE")
    assert [f.name for f in evolve_schema(a, b).fields] == ["x", "y", "z"]
    assert evolve_schema(None, b) == b


def test_evolve_schema_rejects_type_change(spark):
    for old, new in (("x INT", "x STRING"), ("x BIGINT", "x DOUBLE"), ("x TIMESTAMP", "x DATE"), ("x DECIMAL(38,2)", "x DECIMAL(38,10)")):
        with pytest.raises(SchemaConflict):
            evolve_schema(T.StructType.fromDDL(old), T.StructType.fromDDL(new))


WIDER = [("TINYINT", "BIGINT", "BIGINT"), ("BIGINT", "INT", "BIGINT"), ("FLOAT", "DOUBLE", "DOUBLE"), ("INT", "DOUBLE", "DOUBLE"),
         ("DECIMAL(5,2)", "DECIMAL(10,4)", "DECIMAL(10,4)"), ("DECIMAL(10,1)", "DECIMAL(6,4)", "DECIMAL(13,4)"), ("INT", "DECIMAL(4,2)", "DECIMAL(12,2)"),
         ("STRUCT<a: INT>", "STRUCT<a: BIGINT>", "STRUCT<a: BIGINT>"), ("ARRAY<INT>", "ARRAY<BIGINT>", "ARRAY<BIGINT>")]


@pytest.mark.parametrize("old, new, wide", WIDER)
@pytest.mark.parametrize("replace", [True, False])
def test_a_feed_that_widens_reads_back_all_rows(spark, area, old, new, wide, replace):
    """Files written with either type are read with the wider one."""
    t = Table(spark, f"{area}/t")
    value = {"TINYINT": "7", "BIGINT": "5000000000", "INT": "7", "FLOAT": "1.5", "DOUBLE": "0.1", "STRUCT<a: INT>": "named_struct('a', 3)",
             "STRUCT<a: BIGINT>": "named_struct('a', 5000000000)", "ARRAY<INT>": "array(1)", "ARRAY<BIGINT>": "array(5000000000)"}
    frames = [spark.sql(f"SELECT CAST({value.get(x, '3.25')} AS {x}) AS x") for x in (old, new)]
    expect = []
    for df in frames:
        run = t.new_run()
        write_batch(df, f"{t.path(run)}/batch-0")
        publish(t, run, df.schema, replace=replace)
        if replace:
            assert t.read().count() == 1
    expect = [df.selectExpr(f"CAST(x AS {wide}) AS x") for df in frames]
    want = expect[1] if replace else expect[0].union(expect[1])
    assert t.read().schema["x"].dataType == T.StructType.fromDDL(f"x {wide}")["x"].dataType
    assert sorted(map(str, t.read().collect())) == sorted(map(str, want.collect()))


def test_nested_fields_are_added_and_widened(spark, area):
    t = Table(spark, f"{area}/t")
    for value in ("named_struct('a', 3)", "named_struct('a', 5000000000L, 'b', 'x')"):
        df = spark.sql(f"SELECT {value} AS s, array({value}) AS l")
        run = t.new_run()
        write_batch(df, f"{t.path(run)}/batch-0")
        publish(t, run, df.schema, replace=False)
    assert sorted((r.s.a, r.s.b, r.l[0].a, r.l[0].b) for r in t.read().collect()) == [(3, None, 3, None), (5000000000, "x", 5000000000, "x")]


def test_publish_read_truncate_and_add_columns(spark, area):
    for replace in (True, False):
        t = Table(spark, f"{area}/t{replace}")
        assert not t.exists()
        run = t.new_run()
        write_batch(spark.createDataFrame([(1, "a"), (2, "b")], "x INT, y STRING"), f"{t.path(run)}/batch-0")
        publish(t, run, T.StructType.fromDDL("x INT, y STRING"), replace=replace)
        assert sorted(r.x for r in t.read().collect()) == [1, 2]
        t.add_columns(T.StructType.fromDDL("z STRING, `an odd name` STRUCT<`a b`: INT>"))
        assert t.read().columns == ["x", "y", "z", "an odd name"]
        assert {r.z for r in t.read().collect()} == {None}
        t.truncate()
        assert t.read().count() == 0 and t.read().columns == ["x", "y", "z", "an odd name"]


def test_a_snapshot_of_several_batches_moves_at_once(spark, area):
    import os

    t = Table(spark, f"{area}/t", "landfall.moved_" + os.path.basename(area).replace("-", "_"))
    schema = T.StructType.fromDDL("x INT")
    places = []
    for i in range(3):
        run = t.new_run()
        for b in range(3):
            write_batch(spark.createDataFrame([(10 * i + b,)], schema), f"{t.path(run)}/batch-{b}")
        publish(t, run, schema, replace=True)
        assert sorted(r.x for r in spark.table(t.name).collect()) == [10 * i, 10 * i + 1, 10 * i + 2]
        places.append(t.whole_location().removeprefix("file:"))
    assert [os.path.exists(p) for p in places] == [False, True, True]       # the last replaced run waits for the next publish


def test_an_append_published_twice_is_there_once(spark, area):
    from landfall.streaming.loads import published

    t = Table(spark, f"{area}/t")
    schema = T.StructType.fromDDL("x INT")
    runs = [t.new_run() for _ in range(3)]
    for i, run in enumerate(runs):
        write_batch(spark.createDataFrame([(i,)], schema), f"{t.path(run)}/batch-0")
    assert not published(t, runs[0])
    for run in (runs[0], runs[1], runs[0]):
        publish(t, run, schema, replace=False)
    assert [published(t, run) for run in runs] == [True, True, False]
    assert sorted(r.x for r in t.read().collect()) == [0, 1]


def test_many_parts(spark, area):
    t = Table(spark, f"{area}/t")
    schema = T.StructType.fromDDL("x INT")
    run = t.new_run()
    df = spark.range(60).selectExpr("CAST(id AS INT) AS x")
    for i in range(60):                                     # more roots than the parallel-listing threshold
        write_batch(df.where(f"x = {i}").coalesce(1), f"{t.path(run)}/batch-{i}")
    publish(t, run, schema, replace=False)
    assert t.read().count() == 60 and t.read().agg({"x": "sum"}).first()[0] == sum(range(60)) and len(t.parts()) == 60


def test_names_and_modes_that_clash_are_refused(spark, area):
    import os

    name = "landfall.clash_" + os.path.basename(area).replace("-", "_")
    schema = T.StructType.fromDDL("x INT")
    t = Table(spark, f"{area}/a", name)
    t.prepare(schema, parts=True)
    with pytest.raises(ValueError, match="elsewhere"):
        Table(spark, f"{area}/b", name).prepare(schema, parts=True)
    with pytest.raises(ValueError, match="keeps its mode"):
        t.prepare(schema, parts=False)


from hypothesis import given, settings
from hypothesis import strategies as st

_prims = st.sampled_from([T.StringType(), T.IntegerType(), T.TimestampType()])
_names = st.sampled_from(["a", "b", "c", "d"])


def _structs(depth=2):
    leaf = _prims
    inner = st.deferred(lambda: _structs(depth - 1)) if depth > 0 else leaf
    field_type = st.one_of(leaf, inner, st.builds(lambda t: T.ArrayType(t, True), inner)) if depth > 0 else leaf
    return st.lists(st.tuples(_names, field_type), max_size=4, unique_by=lambda f: f[0]).map(
        lambda fs: T.StructType([T.StructField(n, t, True) for n, t in fs]))


@settings(max_examples=60, deadline=None)
@given(a=_structs(), b=_structs())
def test_evolve_schema_properties(a, b):
    try:
        out = evolve_schema(a, b)
    except SchemaConflict:
        return                                                  # a real type clash
    assert out.names[:len(a.names)] == a.names                  # existing columns keep their place
    assert set(out.names) == set(a.names) | set(b.names)        # every new column is added
    for f in a.fields:                                          # existing primitive types are kept
        if not isinstance(f.dataType, (T.StructType, T.ArrayType)):
            assert out[f.name].dataType == f.dataType
    assert evolve_schema(out, b) == out                         # applying the same rows again changes nothing
    assert evolve_schema(out, a) == out
