"""The pipeline, stage by stage against plain Python on nasty rows, and as a whole."""

import collections
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import hits, jaccard
from fixtures_llm import empty, nasty, package  # noqa: F401

import corpus_pipeline as P
from landfall.llm import bytebpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


@pytest.fixture(scope="module")
def outputs(spark, nasty, tmp_path_factory):
    top, _ = nasty
    area = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{top}/documents.parquet"), []
    out.append(docs)
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, top).write.parquet(f"{area}/{k}")
        docs = spark.read.parquet(f"{area}/{k}")
        out.append(docs)
    return out


def test_stages_and_columns(outputs):
    assert [n for n, _ in P.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "byte_bpe"]
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns          # extra columns too


def test_language_stage_rejects_what_has_no_language(outputs):
    before, after = rows(outputs[0]), rows(outputs[1])
    gone = collections.Counter(before) - collections.Counter((*r[:2], b[2], *r[3:]) for r in after for b in before if (r[:2], r[3:]) == (b[:2], b[3:]))
    assert all(t is None or not re.search(r"[^\W\d_]", t) for _, t, *_ in gone)
    assert all(lang is not None for _, _, lang, *_ in after)


def test_one_document_of_each_group_stays(outputs):
    """Rows of one id with the same text are one document, with different texts two."""
    before, after = rows(outputs[1]), rows(outputs[2])
    documents = sorted({r[:2] for r in before if r[0] is not None})
    components = collections.defaultdict(list)
    for i, _, c in jaccard([(i, t) for i, (_, t) in enumerate(documents)], P.SHINGLE_WORDS, *P.SIMILARITY):
        components[c].append(documents[i][0])
    assert collections.Counter(r[0] for r in after) == collections.Counter(
        [min(ids) for ids in components.values()] + [None for r in before if r[0] is None])
    assert set(after) <= set(before)
    assert {t for d, t, *_ in after if d == 1005} == {"one id but", "two texts of it"}


def by_id(df):
    """The rows of each id."""
    out = collections.defaultdict(list)
    for r in rows(df):
        out[r[0]].append(r)
    return out


def test_repeated_strings_are_cut(outputs):
    before, after = rows(outputs[2]), by_id(outputs[3])
    seen = collections.Counter()
    for r in before:
        raw = (r[1] or "").encode()
        seen.update(raw[i:i + P.REPEAT_BYTES] for i in range(len(raw) - P.REPEAT_BYTES + 1))
    for d, text, _, _, n in before:
        raw = (text or "").encode()
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - P.REPEAT_BYTES + 1):
            if seen[raw[i:i + P.REPEAT_BYTES]] > 1:
                mask[i:i + P.REPEAT_BYTES] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~mask]).decode("utf-8", "ignore")
        if mask.any() and not kept.strip():
            assert d not in after
        elif mask.any():
            assert (kept, len(kept)) in [(r[1], r[4]) for r in after[d]]
        else:
            assert (text, n) in [(r[1], r[4]) for r in after[d]]


def test_benchmark_spans_are_cut(outputs, nasty):
    top, _ = nasty
    items = [tuple(r.values()) for r in pq.read_table(f"{top}/benchmark.parquet").to_pylist()]
    before, after = rows(outputs[3]), by_id(outputs[4])
    found = hits([r[:2] for r in before], items, P.WINDOW)
    assert any(h[2] for h in found)
    for (d, text, _, _, n), (_, n_words, n_hit, *_) in zip(before, found):
        if n_hit > P.MAX_COVERAGE * n_words:
            assert d not in after
        elif n_hit:
            (row,) = after[d]
            assert hits([(d, row[1])], items, P.WINDOW)[0][1] == n_words - n_hit and row[4] == len(row[1])
        else:
            assert (text, n) in [(r[1], r[4]) for r in after[d]]


def test_token_ids(outputs):
    import public_tokenizers as vocab

    enc = bytebpe.encoding(vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN)
    expect = [(r[0], enc.encode_ordinary(r[1] or "")) for r in rows(outputs[4])]
    out = outputs[5].collect()
    assert all(r["round_trip"] for r in out)
    assert sorted(((r["doc_id"], r["token_ids"]) for r in out), key=repr) == sorted(expect, key=repr)
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in out)


def test_run_equals_the_stages(spark, nasty, outputs):
    top, _ = nasty
    key = lambda r: repr((r["doc_id"], r["token_ids"]))
    assert sorted(map(key, P.run(spark, top).collect())) == sorted(map(key, outputs[-1].collect()))


def test_empty_documents(spark, empty):
    assert P.run(spark, empty).count() == 0
