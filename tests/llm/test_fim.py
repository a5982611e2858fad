"""Fill-in-the-middle: against plain Python, exact round trips, nasty rows."""

import hashlib
import re

import duckdb
import pytest
from fixtures_llm import empty, nasty, package  # noqa: F401
from hypothesis import given, settings, strategies as st

from landfall.llm import fim, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(key, text, seed=7, rate=100, spm=50):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha(f"{seed}:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_query_equals_plain_python_and_sql(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op13_fill_in_middle"](spark, top)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = sorted(map(tuple, out.collect()), key=repr)
    expect = []
    for d, t, *_ in rows:
        *front, output = brute(d, t)
        expect.append((d, *front, sha(output), sha(t or "")))
    assert got == sorted(expect, key=repr)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS FROM '{top}/documents.parquet'")
    assert sorted((tuple(r) for r in db.sql(fim.SQL).fetchall()), key=repr) == got


def test_no_rows(spark, empty):
    assert queries.QUERIES["op13_fill_in_middle"](spark, empty).count() == 0


TEXTS = ["", None, "\n", "\n\n\n", "one line", "a\nb", "a\r\nb\r\n", "has <P> in it\nx", "<M>", "< P>\n<S", "<", ">\n<", "日本\n語\n😀\n", "x\x00y\nz",
         "line <\nS>\nP>" * 30, "long line " * 300_000, "y\n" * 700_000]


@pytest.fixture(scope="module")
def made(spark):
    """All texts under several keys, with columns that clash; keys repeat."""
    data = [(k, t, "mine", 5) for t in TEXTS for k in (1, 1, 2, None)]
    df = spark.createDataFrame(data, "k string, body string, FORM string, n int").withColumnRenamed("n", "extra")
    return data, fim.transform(df, "k", "body", seed=3, rate=80, spm_share=30)


def test_texts_and_round_trip(made):
    data, out = made
    assert out.columns == ["k", "extra", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    back = fim.restore(out).collect()
    key = lambda r: repr(r)[:300] + sha(repr(r))
    got = [(r["k"], r["extra"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["output_sha256"], r["restored"]) for r in back]
    expect = []
    for k, t, _, extra in data:
        *front, output = brute(k, t, 3, 80, 30)
        expect.append((None if k is None else str(k), extra, *front, output, sha(output), t or ""))
    assert sorted(got, key=key) == sorted(expect, key=key)
    assert all(r["restored_sha256"] == sha(r["restored"]) for r in back)
    assert {"plain", "psm", "spm"} == {r["form"] for r in back}


def test_hashes_without_texts(made):
    _, out = made
    hashed = fim.restore(out, texts=False)
    assert "output" not in hashed.columns and "restored" not in hashed.columns
    assert sorted(r["restored_sha256"] for r in hashed.collect()) == sorted(r["restored_sha256"] for r in fim.restore(out).collect())


def test_a_broken_output_is_an_error():
    with pytest.raises(ValueError, match="without its sentinels"):
        fim.opened(b"<P>a<S>b", "psm", fim.sentinels(fim.MARKS))


@pytest.mark.parametrize("marks", [("", "a", "b"), ("a", "a", "b"), ("<P>", "<P>x", "c"), ("ab", "bc", "x"), ("aa", "aba", "z")])
def test_ambiguous_sentinels_are_refused(marks):
    with pytest.raises(ValueError):
        fim.sentinels(marks)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.lists(st.integers(0, 60), max_size=6), st.randoms())
def test_cut_and_permute(text, places, random):
    places = sorted(min(p, len(text)) for p in places)
    doc = fim.PieceTable.over(memoryview(text)).cut(places)
    edges = [0, *places, len(text)]
    assert [bytes(x) for x in doc.stream()] == [text[a:b] for a, b in zip(edges, edges[1:])]
    order = list(range(len(edges) - 1))
    random.shuffle(order)
    moved = doc.arrange(tuple(order))
    assert moved.arrange(fim.inverse(tuple(order))).join() == text
    again = doc.cut(sorted(random.randint(0, len(text)) for _ in range(3)))
    assert again.join() == text and again.sha256() == hashlib.sha256(text).hexdigest()
