"""Whitening: exact sums against Python integers, the query against numpy's eigenvectors, odd rows."""

import math

import numpy as np
import pytest
from fixtures_llm import SF, empty, package  # noqa: F401
from hypothesis import given, settings, strategies as st

from landfall.llm import queries, whitening

LONG = (1 << 63) - 1


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda d: st.lists(st.lists(st.one_of(
    st.integers(-300, 300), st.integers(-LONG - 1, LONG)), min_size=d, max_size=d), min_size=1, max_size=150)))
def test_scatter_is_exact(rows):
    total, products = whitening.scatter(np.array(rows, np.int64))
    dims = len(rows[0])
    assert total.tolist() == [sum(r[j] for r in rows) for j in range(dims)]
    for i in range(dims):
        for j in range(i, dims):
            assert products[i, j] == sum(r[i] * r[j] for r in rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(1 << 150), 1 << 150), min_size=1, max_size=20))
def test_limbs_add(values):
    sums = [sum(x) for x in zip(*map(whitening.limbs, values))]
    assert sum(s << whitening.LIMB_BITS * k for k, s in enumerate(sums)) == sum(values)


def brute(vectors, components=4):
    """(key, component) rows of vectors of one length: n, deviation, |whitened|, explained."""
    good = [(k, v) for k, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(k, [math.floor(256 * c) for c in v]) for k, v in good]
    fit = sorted({tuple(x) for _, x in xs})
    n, dims = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(dims)]
    centred = [[n * x[j] - s[j] for j in range(dims)] for x in fit]
    v = np.array([[sum(c[i] * c[j] for c in centred) / n ** 3 for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(v)
    out = []
    for k, x in xs:
        d = [n * x[j] - s[j] for j in range(dims)]
        for c in range(min(components, dims)):
            e = values[-1 - c]
            w = abs(sum(d[j] / n * axes[j, -1 - c] for j in range(dims))) / math.sqrt(e)
            out.append((k, c + 1, n, sum(y * y for y in d), w, e / np.trace(v)))
    return out


def compare(got, expect):
    order = lambda r: (repr(r[0]), r[1], r[3], round(r[4], 6))
    got, expect = sorted(got, key=order), sorted(expect, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in expect]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in expect], rtol=1e-9, atol=1e-9)


def test_query_equals_numpy(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = queries.QUERIES["op12_embedding_whitening"](spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(out.dtypes)["component"] == "int" and dict(out.dtypes)["n"] == "bigint" and dict(out.dtypes)["deviation"] == "bigint"
    rows = out.collect()
    compare([(r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in rows], brute(vectors))
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def flat(out):
    return [(r["k"], c + 1, r["n"], int(r["deviation"]), abs(w), e) for r in out.collect()
            for c, (w, e) in enumerate(zip(r["whitened"], r["explained"]))]


def test_odd_rows(spark):
    """Copies, null keys, bad vectors, a clashing column; -0.0 and values that one x stands for."""
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    data += [data[3], (100, data[3][1]), (None, data[4][1]), (7, None), (8, [1.0, None, 2.0]), (9, [1.0, float("nan"), 0.0]),
             (10, [float("inf"), 0.0, 0.0]), (11, [-0.0, 0.0, 0.001]), (12, [0.0, 0.003, 0.0]), (13, [1.0, 2.0, -5000.25])]
    df = spark.createDataFrame([(k, v, "a", 1) for k, v in data], "k long, v array<double>, x string, n int")
    out = whitening.whiten(spark, df, "k", "v")
    assert out.columns == ["k", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(flat(out), brute(data))


def test_lengths_are_whitened_apart(spark):
    rng = np.random.default_rng(6)
    two, three = [(i, rng.normal(size=2).tolist()) for i in range(20)], [(i, rng.normal(size=3).tolist()) for i in range(20, 50)]
    df = spark.createDataFrame([*two, *three, (77, [])], "k long, v array<float>")
    near = lambda rows: [(k, [float(np.float32(c)) for c in v]) for k, v in rows]
    compare(flat(whitening.whiten(spark, df, "k", "v")), brute(near(two)) + brute(near(three)))


def test_no_variance_and_dependent_dimensions(spark):
    one = whitening.whiten(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "k long, v array<double>"), "k", "v").collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, [None, None], [None, None], None)] * 2
    line = [(i, [float(i), 2.0 * i, -float(i)]) for i in range(9)]
    out = whitening.whiten(spark, spark.createDataFrame(line, "k long, v array<double>"), "k", "v").collect()
    assert all(r["whitened"][0] is not None and r["whitened"][1:] == [None, None] for r in out)
    assert out[0]["identity_error"] < 1e-12 and out[0]["explained"][0] == pytest.approx(1)


def test_ends_of_the_range(spark):
    """Entries beyond long are its ends, and every sum stays exact."""
    data = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.5, 1e17]), (3, [3.25, -7.0])]
    out = {r["k"]: r for r in whitening.whiten(spark, spark.createDataFrame(data, "k long, v array<double>"), "k", "v").collect()}
    x = {k: [max(-LONG - 1, min(LONG, math.floor(256 * c))) for c in v] for k, v in data}
    n, s = 4, [sum(v[j] for v in x.values()) for j in range(2)]
    for k, v in x.items():
        exact = sum((n * v[j] - s[j]) ** 2 for j in range(2))
        assert out[k]["deviation"] == (exact if exact < 10 ** 38 else None)
    assert out[0]["identity_error"] < 1e-6


def test_no_rows(spark, empty):
    out = queries.QUERIES["op12_embedding_whitening"](spark, empty)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
