"""Toxicity: the features against plain Python, held-out accuracy, odd labels, bounded sample."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from brute import fold
from fixtures_llm import SF, empty, nasty, package  # noqa: F401

from landfall.llm import queries, toxicity
from landfall.llm.common import Workspace, span_hashes, text_buffers

MID = "/root/testdata/sf0.01"


def hashed(word, prefix=0):
    raw = np.frombuffer(word.encode(), np.uint8)
    h = span_hashes(raw, np.array([0]), np.array([len(raw)]))
    if prefix:
        h = toxicity.mix(h + np.uint64(prefix))
    return int(h.view(np.int64)[0])


WORDS, FAMILIES = {"idiot": 3.0, "müll": 2.0}, {"schw": 1.5, "idio": 0.5}


def fold_case(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in text)


def plain(text):
    """The features again, with regular expressions over bytes."""
    raw, low = text.encode(), fold_case(text).encode()
    letter = rb"[a-z\x80-\xff]"
    words = list(re.finditer(letter + rb"+", low))
    strong = {w.encode(): s for w, s in WORDS.items()}
    start = {w.encode(): s for w, s in FAMILIES.items()}

    def look(word):
        family = max([start.get(word[:k], 0.0) for k in toxicity.PREFIXES if len(word) > k], default=0.0)
        return strong.get(word, 0.0), family

    found = [look(m.group()) for m in words]
    best = [max(f) for f in found]
    you = [m.group().decode(errors="replace") in toxicity.SECOND_PERSON for m in words]
    hits = [i for i, b in enumerate(best) if b]
    near = sum(any(you[max(i - toxicity.NEAR, 0):i + toxicity.NEAR + 1]) for i in hits)
    tokens = list(re.finditer(rb"[^\x20\x09-\x0D]+", low))
    mixed = hidden = 0
    reads = {k.encode(): v.encode() for k, v in toxicity.LOOKALIKES.items()}
    read = lambda b: b"".join(c if re.match(letter, c) else reads.get(c, b"") for c in (b[i:i + 1] for i in range(len(b))))
    for t in tokens:
        core = re.search(letter + rb"(.*" + letter + rb")?", t.group(), re.S)
        inner = core.group() if core else b""
        if len(re.findall(letter, inner)) >= 2 and re.search(rb"[^a-z\x80-\xff]", inner):
            mixed += 1
            opened = any(t.start() <= words[i].start() < t.end() for i in hits)
            hidden += not opened and (max(look(read(inner))) > 0 or max(look(read(t.group()))) > 0)
    n, k, letters = max(len(words), 1), max(len(tokens), 1), max(len(re.findall(letter, low)), 1)
    size = max(len(raw), 1)
    shouted = sum(len(m.group()) >= 2 and re.fullmatch(rb"[A-Z]+", raw[m.start():m.end()]) is not None for m in words)
    stretched = sum(low[i:i + 1] == low[i - 1:i] == low[i - 2:i - 1] and re.match(letter, low[i:i + 1]) is not None for i in range(2, len(low)))
    return [sum(f[0] > 0 for f in found) / n, sum(f[1] > 0 for f in found) / n, sum(best) / n, max(best, default=0.0), math.log1p(len(hits)),
            hidden / k, math.log1p(hidden), sum(you) / n, near / max(len(hits), 1), len(re.findall(rb"[A-Z]", raw)) / letters, shouted / n,
            len(re.findall(rb"[!?]", raw)) / n, len(re.findall(rb"[!-/:-@\[-`{-~]", raw)) / size, mixed / k, stretched / n,
            len(re.findall(rb"[0-9]", raw)) / size, math.log2(n)]


def test_features_equal_plain_python():
    texts = ["", "you are an IDIOT!! really", "an 1d1ot and an i.d.i.o.t, id!ot$$$ idiot### x-idiot 1diot", "MÜLL Müll müll schwester SCHWACH idiots", "???",
             "a b c d e f you g h i idiot", "you " + "word " * 6 + "idiot", "sooooo LOUD123 a1b2 <<>> 漢字漢字 😀😀😀", " \n\t ", "tú y idioten", "x" * 50,
             "don't e-mail me@home c'est l'idiot", "A", "1 2 3", "idiot", "ÀÉ×Þß ïd10t"]
    lexicon = toxicity.Lexicon([(hashed(w), s) for w, s in WORDS.items()], [(hashed(w, len(w.encode())), s) for w, s in FAMILIES.items()])
    for some in (texts, texts[::-1], texts[:1], texts * 3):
        got = toxicity.measure(*text_buffers(pa.array(some)), lexicon)
        for text, row in zip(some, got):
            assert dict(zip(toxicity.FEATURES, row)) == pytest.approx(dict(zip(toxicity.FEATURES, plain(text)))), text
    assert toxicity.measure(*text_buffers(pa.array([], pa.string())), lexicon).shape == (0, len(toxicity.FEATURES))


def test_held_out_accuracy(spark):
    out = {r["doc_id"]: r for r in queries.QUERIES["op11_toxicity"](spark, MID).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{MID}/documents.parquet").count()
    assert all(r["held_out"] == (fold(d, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for d, r in out.items())
    held = [(r["score"], r["predicted"], labels[d]) for d, r in out.items() if r["held_out"] and d in labels]
    bad, good = [h for h in held if h[2] == 1], [h for h in held if h[2] == 0]
    # some labels of the table are wrong on purpose; this many rows hold few toxic texts
    assert sum(p for _, p, _ in good) <= 0.02 * len(good)
    assert sum(p for _, p, _ in bad) >= 0.6 * len(bad)
    assert sum((a > b) + 0.5 * (a == b) for a, *_ in bad for b, *_ in good) / (len(bad) * len(good)) > 0.85


def test_nasty_rows(spark, nasty):
    top, rows = nasty
    out = queries.QUERIES["op11_toxicity"](spark, top).collect()
    assert sorted((r["doc_id"] for r in out), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in out)


def test_no_rows(spark, empty):
    out = queries.QUERIES["op11_toxicity"](spark, empty)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 0


def test_odd_labels_and_repeated_rows(spark):
    """Null, repeated and contradictory labels; labels of ids that aren't there; a text that is a third of all rows."""
    from pyspark.sql import functions as F

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("some plain words "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"),
        F.when(F.col("id") % 5 == 0, " scum").otherwise(" fine"), F.lit(" here")).alias("text"), F.lit(1).alias("y"))
    hot = spark.range(1500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text again and again").alias("text"), F.lit(1).alias("y"))
    docs = docs.unionByName(hot)
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")).unionByName(spark.createDataFrame(
        [(1, None), (2, 1), (2, 0), (3, 0), (3, 0), (3, 1), (None, 1), (999999, 1)], "doc_id long, toxic int"))
    ws = Workspace(spark, "test-toxicity")
    sample = toxicity.labelled_sample(spark, docs.select("doc_id", "text"), labels, 300, ws)
    assert 200 < sample.count() < 400  # the hot row counts once
    assert sample.groupBy("doc_id", "h").count().where("count > 1").count() == 0
    whole = {r["doc_id"]: r["y"] for r in toxicity.labelled_sample(spark, docs.select("doc_id", "text"), labels, 10**6, ws).collect()}
    assert whole[1] == 0 and whole[3] == 0 and len(whole) == 3000 and None not in whole
    model = toxicity.train(spark, docs, labels, F.col("doc_id") % 4 == 0)
    scored = model.score(docs, ["doc_id"])
    wrong = scored.where(F.col("doc_id") != 7).where((F.col("score") >= 0.5) != (F.col("doc_id") % 5 == 0)).count()
    assert wrong <= 3
    one = toxicity.train(spark, docs, labels.where("toxic = 0"), F.lit(False))
    assert one.trees is None and {r["score"] for r in one.score(docs, ["doc_id"]).collect()} == {0.0}


def letters(i):
    return str(i).translate(str.maketrans("0123456789", "abcdefghij"))


def test_copies_don_t_make_a_lexicon(spark):
    """A toxic text with hundreds of copies gives no entries; words of many toxic texts do."""
    from pyspark.sql import functions as F

    rows = [(i, " ".join(letters(i * k) for k in (3, 5, 7)) + (" scum" if i % 4 == 0 else "") + " end", float(i % 4 == 0)) for i in range(400)]
    rows += [(1000 + i, "copied passage of peculiar things", 1.0) for i in range(300)]
    sample = spark.createDataFrame([(i, t, y) for i, t, y in rows], "doc_id long, text string, y double").withColumn("h", F.xxhash64("text"))
    found = toxicity.learn_lexicon(sample, Workspace(spark, "test-lexicon"))
    words = set(found.kinds[0][0].view(np.int64).tolist())
    assert hashed("scum") in words and hashed("peculiar") not in words and hashed("copied") not in words
