"""The queries over documents against plain Python, on nasty rows and on empty tables."""

import hashlib
import zlib

import numpy as np
import pytest
from brute import fold, hits, jaccard, lm, repeats
from fixtures_llm import empty, nasty, package  # noqa: F401

from landfall.llm import decontam, jaccard as jaccard_op, langid, packing, quality, queries, suffix


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_lm_counts_and_base(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op4_lm_scoring"](spark, top).collect()
    expect = lm([r[:2] for r in rows])
    key = lambda r: repr(tuple(r[:5])) + f"{r[5]:.6f}"
    for a, b in zip(sorted(map(tuple, out), key=key), sorted(expect, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5])
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_lm_probabilities_sum_to_one(spark, tmp_path):
    """Over a closed vocabulary, the model's probabilities after a context sum to 1 with the unknown word's."""
    train = [(i, t) for i, t in enumerate(["a b", "a a b", "b a", "c", "a b c", "b b", "c a", "a c b", "a b"] * 4)]
    probe = [(1000 + i, t) for i, t in enumerate(["a", "b", "c", "zzz", ""])]
    df = spark.createDataFrame(train + probe, "doc_id long, text string")
    from pyspark.sql import functions as F

    from landfall.llm.lm import score
    out = {r["doc_id"]: 10 ** r["score"] for r in score(spark, df, F.col("doc_id") < 1000, F.col("doc_id") % 5 == 0).collect()}
    # first word w then the end: P(w | begin) P(end | w); an empty text: P(end | begin)
    assert 0 < sum(out[1000 + i] for i in range(5)) < 1
    assert out[1003] < min(out[1000], out[1004])


def test_token_ids(spark, nasty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    top, rows = nasty
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = [t.encode(x or "", add_special_tokens=False).ids + [2] for _, x, *_ in rows]
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    out = queries.QUERIES["op5_token_ids"](spark, top).collect()
    assert want((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want((d, len(x), c) for (d, *_), x, c in zip(rows, ids, crc))
    order = sorted(out, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0] + [r["n_tokens"] for r in order]).tolist()[:-1]
    known = [r["doc_id"] for r in order if r["doc_id"] is not None]
    assert known == sorted(known)


@pytest.mark.parametrize("special_as_text", [False, True])
def test_units_are_encoded_like_whole_texts(special_as_text):
    import random

    import public_tokenizers as P
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    plain.encode_special_tokens = special_as_text
    w = packing.word_ids(P.path("word_bpe_49k.json"), special_as_text)
    rng = random.Random(5)
    texts = ["it's O'Neil's don't", "İSTANBUL ΟΔΥΣΣΕΥΣ", "ab—,cd x,—y", "abc'd,e 's't", "  x\t\ty z ", "A1b2,3.5%", "<|endoftext|> a", "",
             "it<|endoftext|>'s<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "Σ<|endoftext|>\u0338aΣ", "a\n<|startoftext|>\nB"]
    texts += ["".join(rng.choice("aB'é,.—1 \t\nΣßİ́漢<|") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(rng.choice(["<|endoftext|>", "<|startoftext|>", "a", "'s", " ", "Σ", "́", "<|", "|>", "\n"])
                      for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    for x, ids in zip(texts, w.ids([x.encode() for x in texts])):
        assert plain.encode(x, add_special_tokens=False).ids == ids.tolist(), x


def test_one_id_takes_many_shards(spark, tmp_path):
    import public_tokenizers as P
    from pyspark.sql import functions as F

    rows = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    where = str(tmp_path / "shards")
    packing.write_packed(rows, where, P.path("word_bpe_49k.json"), 2, 4)
    found = packing.read_packed(spark, where, packing.Workspace(spark, "test")).collect()
    assert len(found) == 400 and {r["doc_id"] for r in found} == {None}
    order = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0] + [r["n_tokens"] for r in order]).tolist()[:-1]
    files = spark.read.format("binaryFile").load(where).where("path like '%part-%'").select("length").collect()
    assert len(files) == 4 and max(r["length"] for r in files) < 0.5 * sum(r["length"] for r in files)


@pytest.mark.parametrize("bits", [1, 3, 9, 16, 17, 31])
def test_packing_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    blocks = packing.Blocks(bits, block_ids=100)
    docs = [(int(i), rng.integers(0, 1 << bits, n).astype(np.uint32)) for i, n in enumerate([0, 1, 99, 100, 101, 350, 7, 0])]
    data = b"".join(x + b"\n" for d, ids in docs for x in blocks.add(d, ids)) + b"".join(x + b"\n" for x in blocks.close())
    shard = packing.Shard(data)
    back = list(shard.documents())
    assert [(d, x.tolist()) for d, _, x in back] == [(d, x.tolist()) for d, x in docs]
    flat = np.concatenate([x for _, x in docs])
    assert [a for _, a, _ in back] == np.cumsum([0] + [len(x) for _, x in docs]).tolist()[:-1]
    for a, b in [(0, 5), (95, 205), (0, len(flat)), (len(flat), len(flat)), (650, 658)]:
        assert shard.ids(a, b).tolist() == flat[a:b].tolist()


def test_jaccard(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op6_jaccard_join"](spark, top)
    assert got(out, "doc_id", "n_shingles", "component_id") == want(jaccard([r[:2] for r in rows], 4, 85, 100))


def test_jaccard_random_sets(spark):
    """Chains of edited texts, many near the threshold, at another shingle size and threshold."""
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        words = [f"w{rng.integers(0, 300)}" for _ in range(rng.integers(3, 60))]
        for _ in range(8):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.integers(0, len(words))] = f"x{rng.integers(0, 300)}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_op.near_duplicates(spark, df, k=2, threshold=(7, 10))
    assert got(out, "doc_id", "n_shingles", "component_id") == want(jaccard(rows, 2, 7, 10))


@pytest.mark.parametrize("group", [suffix.GROUP, 1])
def test_repeats(spark, nasty, monkeypatch, group):
    """``group=1`` sends every beginning with several variants the way of the frequent ones."""
    monkeypatch.setattr(suffix, "GROUP", group)
    top, rows = nasty
    out = queries.QUERIES["op7_suffix_dedup"](spark, top)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(repeats([r[:2] for r in rows], 400))


def test_repeats_at_seams(spark, monkeypatch):
    """Passages at text ends, overlapping, one byte short, and across the pieces of a long text."""
    monkeypatch.setattr(suffix, "PIECE", 700)
    rng = np.random.default_rng(4)
    noise = lambda n: "".join(rng.choice(list("abcdefgh ")) for _ in range(n))
    p, q = noise(130), noise(99)
    rows = [(0, p), (1, p + noise(50)), (2, noise(70) + p), (3, noise(30) + p[20:] + noise(900) + p[:120]), (4, q + "x"), (5, q + "y"),
            (6, noise(2000) + p + noise(10)), (7, "ab" * 300), (8, noise(60) + p[:115] + noise(5) + p[10:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix.dedup(spark, df, length=100, batches=3)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(repeats(rows, 100))


def test_decontamination(spark, nasty):
    import pyarrow.parquet as pq

    top, rows = nasty
    items = [tuple(r.values()) for r in pq.read_table(f"{top}/benchmark.parquet").to_pylist()]
    out = queries.QUERIES["op8_decontamination"](spark, top)
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    expect = want(hits([r[:2] for r in rows], items, 10))
    assert got(out, *cols) == expect
    # in several automata, one for about each item
    docs, bench = spark.read.parquet(f"{top}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{top}/benchmark.parquet")
    parts = decontam.scan(spark, docs, bench, block_bytes=100).collect()
    assert want((r["doc_id"], r["n_words"], sum(b - a for a, b in r["spans"]), len(r["items"])) for r in parts) == want(x[:4] for x in expect)


def test_decontaminate_cuts_spans_and_drops_copies(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Before. {item.upper()}! After, " + "more words " * 10), (2, item), (3, "clean text"), (4, None)],
                                 "doc_id long, text string")
    out = dict(map(tuple, decontam.decontaminate(spark, docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()))
    assert out[1] == "Before. ! After, " + ("more words " * 10).strip()
    assert out[3] == "clean text" and out[4] is None and 2 not in out


def test_byte_bpe(spark, nasty):
    import public_tokenizers as P

    from landfall.llm import bytebpe
    top, rows = nasty
    enc = bytebpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expect = [(d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((x or "").encode()))
              for d, x, *_ in rows for ids in [enc.encode_ordinary(x or "")]]
    out = queries.QUERIES["op9_byte_bpe"](spark, top)
    assert got(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want(expect)
    docs = spark.read.parquet(f"{top}/documents.parquet").select("doc_id", "text")
    path = P.path("byte_bpe_50k.tiktoken")
    apart = bytebpe.decode(bytebpe.encode(docs, path, P.PATTERN), path, P.PATTERN)
    assert got(apart, "doc_id", "token_ids", "raw") == got(bytebpe.round_trip(docs, path, P.PATTERN), "doc_id", "token_ids", "raw")
    text = rows[-7][1] + "  \n\n it's 12 ab" * 50
    for size in (1, 7, 100):
        assert bytebpe.encode_text(enc, text, size).tolist() == enc.encode_ordinary(text)


def test_language(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op10_language_id"](spark, top).collect()
    assert len(out) == len(rows)
    texts = {d: (t, lang) for d, t, lang, *_ in rows}
    for r in out:
        assert r["held_out"] == (fold(r["doc_id"], 4) == 2)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (1000, 1001, 1002, 1003):
            assert r["lang_pred"] == "und"
    sure = [(r["lang_pred"], texts[r["doc_id"]][1]) for r in out if r["held_out"] and r["doc_id"] is not None and 0 <= r["doc_id"] < 1000]
    assert sum(a == b for a, b in sure) >= 0.95 * len(sure)


def test_language_sample_is_bounded_by_texts(spark, monkeypatch):
    """Copies of one text are one row of the sample, whatever share of the rows they are."""
    words = {"aa": ["kala", "mono", "tiri"], "bb": ["zwerg", "schrank", "pflug"]}
    some = [(f"{w} {i} {w[::-1]} {v}", x) for x, ws in words.items() for i in range(40) for w in ws for v in ws]
    # a text that the hash picks first, and for the fitting half
    place = "pmod(xxhash64(text), 1L << 40), pmod(xxhash64(text, 1), 2)"
    hot = spark.range(3000).selectExpr("concat('kala mono ', id) AS text").selectExpr("text", f"struct({place}) AS place")
    hot = hot.where("place.col2 = 0").orderBy("place.col1").first()["text"]
    rows = some + [(hot, "aa")] * 5000 + [("kala", None), (None, "aa")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    fitted = []
    monkeypatch.setattr(langid, "logistic", lambda x, y: fitted.append(len(x)) or (1.0, 0.0))
    model = langid.train(docs, rows_per_language=100)
    assert model.languages == ["aa", "bb"]
    # half of about 100 texts of each of two languages
    assert fitted and max(fitted) <= 160
    found = langid.identify(spark, docs.distinct(), model).where("lang IS NOT NULL AND text IS NOT NULL")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert len({tuple(w) for w in code}) == n
    least = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
    assert least >= (code.shape[1] + 1) // 2 if n <= 5 else least >= 0.25 * code.shape[1]


def test_quality_held_out_accuracy(spark):
    import duckdb
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES["op2_quality"](spark, sf).where("held_out").collect()
    labels = {d: x for d, *x in duckdb.sql(f"SELECT * FROM '{sf}/labels.parquet'").fetchall()}
    for j, k in enumerate(quality.KINDS):
        known = [(r[k] >= 0.5, labels[r["doc_id"]][j]) for r in out if r["doc_id"] in labels]
        assert sum(a == b for a, b in known) >= 0.97 * len(known)


def test_quality_nasty(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op2_quality"](spark, top).collect()
    assert len(out) == len(rows)
    assert all(0 <= r[c] <= 1 for r in out for k in quality.KINDS for c in (k, f"{k}_doc", f"{k}_host", f"{k}_path"))


def test_quality_posteriors(spark):
    """Against the same formulas in numpy: a group's mean shrinks to its parent's, each row left out of its own."""
    rng = np.random.default_rng(0)
    rows = [(h, f"{h}{p}", float(rng.random() < 0.2 + 0.6 * (h == "a")), float(rng.random()))
            for h, n in (("a", 60), ("b", 40), ("c", 1), (None, 3)) for p in range(2) for _ in range(n)]
    df = spark.createDataFrame(rows, "host string, path string, quality double, toxic double")
    out = quality.posteriors(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["host"], []).append(r["quality_host"])
    mean = np.mean([r[2] for r in rows])
    assert np.mean(by["a"]) > mean > np.mean(by["b"])
    assert abs(np.mean(by["c"]) - mean) < abs(np.mean(by["b"]) - mean)


NAMES = sorted(set(queries.QUERIES) - {"op1_chat_format"})


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_decontamination_holds_one_python_step_in_a_task(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "b c")], "item_id string, text string")
    out = decontam.decontaminate(spark, docs, items, window=2)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id != 3) == [(1, "a d"), (2, "x y")]
