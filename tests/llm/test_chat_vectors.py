"""Chat formatting and embeddings."""

import random

import duckdb
import numpy as np
import pytest
from brute import links
from fixtures_llm import empty, package  # noqa: F401

from landfall.llm import chat, nearvec, queries
from landfall.llm.components import connected_components
from landfall.llm.common import Workspace

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    rows = lambda it, names: sorted((tuple(r[names.index(c)] for c in sorted(cols)) for r in it), key=repr)
    assert rows(map(tuple, df.collect()), df.columns) == rows(res.fetchall(), cols)


def test_native_plan(spark):
    plan = queries.QUERIES["op1_chat_format"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


MESSAGES = "conv_id long, msg_id long, parent_id long, role string, text string, score double, extra string"


def test_best_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0, ""), (1, 2, 1, "assistant", "bad", 1.0, ""), (1, 3, 1, "assistant", "good", 2.0, ""),
            (1, 4, 2, "user", "more", 0.5, ""), (1, 5, 3, "user", "thanks", 0.0, ""), (1, 6, 5, "assistant", "welcome", -0.25, ""),
            (2, 7, 99, "user", "orphan", 0.0, ""), (2, 8, 7, None, None, None, ""), (3, 9, 10, "user", "later parent", 0.0, ""),
            (3, 10, 9, "assistant", "x", 0.0, ""), (None, 1, None, "user", "no id", 0.0, ""), (4, 1, None, "user", "tie", 1.0, ""),
            (4, 2, 1, "assistant", "first", 1.0, ""), (4, 3, 1, "assistant", "second", 1.0, "")]
    out = chat.read_back(chat.format_branches(spark, spark.createDataFrame(rows, MESSAGES), branches=2)).collect()
    texts = {(r["conv_id"], r["branch"]): [t["text"] for t in r["turns"]] for r in out}
    assert texts[1, 1] == ["q", "good", "thanks", "welcome"] and texts[1, 2] == ["q", "bad", "more"]
    assert {r["conv_id"]: r["branch_score"] for r in out if r["branch"] == 1}[1] == 1.75
    assert texts[2, 1] == ["orphan", ""] and texts[3, 1] == ["later parent", "x"] and texts[None, 1] == ["no id"]
    assert texts[4, 1] == ["tie", "first"] and texts[4, 2] == ["tie", "second"]
    assert [r["loss_texts"] for r in out if (r["conv_id"], r["branch"]) == (1, 1)] == [["good", "welcome"]]


def test_escaping_is_reversible_and_complete(spark):
    rng = random.Random(1)
    bits = ["\\", "<|", "|>", "<", "|", "s>", "</s>", "<s>", "[INST]", "[/INST]", "[", "<<SYS>>", "<</SYS>>", chat.START, chat.SEP, chat.END, "\n", "é", "x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape("t").alias("e"))
    for r in df.select("t", "e", chat.unescape(df["e"]).alias("back")).collect():
        assert r["back"] == r["t"]
        assert not any(x in r["e"] for x in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_long_conversation_and_repeated_turns(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(300)] + [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, None, None, None)]
    out = chat.read_back(chat.format_branches(spark, chat.link_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    turns = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in out.collect()}
    assert turns[1] == [f"t{i}" for i in range(300)] and turns[2] == ["", "same", "same"]


def test_empty_chat(spark, empty):
    out = queries.QUERIES["op1_chat_format"](spark, empty).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in out] == [(-7, 2)]


def vectors(seed=0, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(n // 2)]
    while len(rows) < n:  # chains of near copies, some right at the threshold
        x = rows[rng.integers(0, len(rows))]
        rows.append(x / np.linalg.norm(x) + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.1, 0.12]))
    out = [(int(i), [float(np.float32(v)) for v in x]) for i, x in enumerate(rows)]
    bad = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [1.0] * 3, [2.0] * 3, [1e-30] * dim, [1e30] * dim]
    return out + [(1000 + i, x) for i, x in enumerate(bad)] + [(5000, out[0][1]), (5000, out[0][1])]


def test_links_exact_in_one_cell_and_blocks(spark):
    """With every cell visited the result is exact whatever the cells and blocks."""
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expect = sorted((d, n, c, d == c) for d, n, c in links(rows, 0.9))
    for cell_rows, block_rows in ((10_000, 64), (50, 2048), (40, 16)):
        out = nearvec.near_duplicates(spark, df, margin=3.0, cell_rows=cell_rows, block_rows=block_rows)
        assert sorted(map(tuple, out.collect())) == expect


def test_recall_of_default_margin(spark):
    rows = vectors(seed=2, n=1500, dim=64)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sum(r["n_links"] for r in nearvec.near_duplicates(spark, df, cell_rows=60).collect())
    assert found >= 0.99 * sum(n for _, n, _ in links(rows, 0.9))


def test_components(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)]
    from brute import groups
    top = groups({v for e in edges for v in e}, edges)
    out = connected_components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark, "test"))
    assert {r["u"]: r["component"] for r in out.collect()} == {v: t for v, t in top.items() if v != t}
