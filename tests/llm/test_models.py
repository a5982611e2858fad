"""The models' numbers against plain Python: op4's interpolated score and its weights, op2's posteriors and
final odds, op10's n-gram rates, bit classifiers and decoding."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures_llm import package  # noqa: F401
from pyspark.sql import functions as F

from landfall.llm import langid, lm, quality

BEGIN, END = object(), object()


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def lm_counts(texts):
    one, two = Counter(), Counter()
    for t in texts:
        before = BEGIN
        one[BEGIN] += 1
        for w in words(t):
            one[w] += 1
            two[before, w] += 1
            before = w
    real = [c for w, c in one.items() if w is not BEGIN]
    return one, two, sum(real), len(real)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(n):
        at, out = rng.randrange(40), []
        for _ in range(rng.randint(0, 30)):
            at = (at * 7 + 3) % 40 if rng.random() < 0.6 else min(int(rng.expovariate(0.15)), 39)
            out.append(vocabulary[at].upper() if rng.random() < 0.1 else vocabulary[at])
        texts.append(" ".join(out))
    return texts + [None, "", "never seen words here", texts[0], texts[0]]


def test_lm_score_is_the_interpolated_probability(spark):
    rows = list(enumerate(corpus(3, 300)))
    train, held = (lambda i: i % 10 != 0), (lambda i: i % 10 == 9)
    one, two, n, v = lm_counts([t for i, t in rows if train(i)])
    r1, r2, rn, rv = lm_counts([t for i, t in rows if train(i) and not held(i)])
    quarter = lambda c, of: round(-4 * math.log2(c / of)) if c else -1
    bucket = lambda c: c.bit_length()
    cells = Counter()
    for i, t in rows:
        if held(i):
            before = BEGIN
            for w in words(t):
                cells[bucket(r1[before]), quarter(r2[before, w], max(r1[before], 1)), quarter(r1[w], rn)] += 1
                before = w
    weights = lm.expectation_maximisation(np.array([(*c, k) for c, k in cells.items()]), 1 / (rv + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = lm.score(spark, df, F.col("doc_id") % 10 != 0, F.col("doc_id") % 10 == 9, chunk_bytes=2000).collect()
    assert len(got) == len(rows)
    for r in got:
        total, before = 0.0, BEGIN
        for w in words(dict(rows)[r["doc_id"]]):
            a, b, c = weights[bucket(one[before])]
            total += math.log10(a * two[before, w] / max(one[before], 1) + b * one[w] / n + c / (v + 1))
            before = w
        assert r["score"] == pytest.approx(total, rel=1e-9), r["doc_id"]
        assert r["train_tokens"] == n


def test_lm_weights_are_the_most_likely(spark):
    """No other mixture gives the held-out counts a higher likelihood."""
    rng = np.random.default_rng(1)
    cells = np.array([(b, q2, q1, int(k)) for b in (0, 3, 5) for q2, q1, k in zip(
        rng.integers(-1, 30, 40) if b else [-1] * 40, rng.integers(-1, 50, 40), rng.integers(1, 60, 40))])
    floor = 1e-4
    weights = lm.expectation_maximisation(cells, floor, rounds=5000)
    np.testing.assert_allclose(weights.sum(1), 1)
    for b in (0, 3, 5):
        mine = cells[cells[:, 0] == b]
        p = np.stack([np.where(mine[:, k] >= 0, 2.0 ** (-mine[:, k] / 4), 0) for k in (1, 2)] + [np.full(len(mine), floor)], 1)
        likelihood = lambda w: (mine[:, 3] * np.log(p @ w)).sum()  # noqa: E731, B023
        best = likelihood(weights[b])
        for w in [*rng.dirichlet([1, 1, 1], 3000), *(0.99 * weights[b] + 0.01 * x for x in rng.dirichlet([1, 1, 1], 300))]:
            assert likelihood(w) <= best + 1e-3 * abs(best)
    # a bucket without held-out tokens has those of the next lower one
    np.testing.assert_array_equal(weights[4], weights[3])
    np.testing.assert_array_equal(weights[63], weights[5])


def strength(groups):
    """Method of moments over (n, sum, prior mean), written out."""
    noise = sum(m * (1 - m) for _, _, m in groups)
    between = (sum(n * (y / n - m) ** 2 for n, y, m in groups) - noise) / sum(n for n, _, _ in groups)
    if between <= 0:
        return 1e6
    return min(max(noise / len(groups) / between - 1, 1.0), 1e6)


def expected_posteriors(rows, k):
    """(global, host, path) of each row, itself left out."""
    mean = min(max(sum(r[k] for r in rows) / len(rows), 1e-6), 1 - 1e-6)
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(r[k])
        paths[r["host"], r["path"]].append(r[k])
    s = strength([(len(x), sum(x), mean) for x in hosts.values()])
    at_host = {h: (sum(x) + s * mean) / (len(x) + s) for h, x in hosts.items()}
    t = strength([(len(x), sum(x), at_host[h]) for (h, _), x in paths.items()])
    clip = lambda x: min(max(x, 1e-6), 1 - 1e-6)
    for r in rows:
        h, p = hosts[r["host"]], paths[r["host"], r["path"]]
        host = (sum(h) - r[k] + s * mean) / (len(h) - 1 + s)
        yield mean, clip(host), clip((sum(p) - r[k] + t * host) / (len(p) - 1 + t))


@pytest.mark.parametrize("seed", range(3))
def test_quality_posteriors_equal_the_formulas(spark, seed):
    rng = random.Random(seed)
    rows = []
    for host in [None, "", "a", "b", "big", "one"]:
        rate = rng.random()
        for i in range({"big": 400, "one": 1}.get(host, rng.randint(2, 40))):
            value = lambda: rng.choice([float(rng.random() < rate), rng.random()])  # noqa: E731, B023
            rows.append({"doc_id": len(rows), "host": host, "path": rng.choice([None, "x", "y", "z"]), "quality": value(), "toxic": value()})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, host string, path string, quality double, toxic double")
    got = {r["doc_id"]: r for r in quality.posteriors(df.repartition(4)).collect()}
    assert len(got) == len(rows)
    for k in quality.KINDS:
        for r, expect in zip(rows, expected_posteriors(rows, k)):
            assert [got[r["doc_id"]][f"{k}_{x}"] for x in ("global", "host", "path")] == pytest.approx(expect, rel=1e-9), r


def test_quality_final_odds(spark):
    """Without labels to fit on, classifier odds are 0 and the labels alone move host, path and final odds."""
    docs = [(i, f"text {i}", "good" if i % 3 else "bad", "p") for i in range(60)]
    labels = [(i, 1, 0) if i % 3 else (i, None, None) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, host string, path string")
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.classify(spark, df, lf, F.col("host"), F.col("path")).collect()}
    rows = [{"host": h, "path": p, "quality": 1.0 if i % 3 else 0.5} for i, _, h, p in docs]
    logit = lambda x: math.log(x / (1 - x))
    for (i, *_), (mean, host, path) in zip(docs, expected_posteriors(rows, "quality")):
        r = out[i]
        assert r["quality_doc"] == 0.5 and [r["quality_host"], r["quality_path"]] == pytest.approx([host, path], rel=1e-9)
        assert r["quality"] == pytest.approx(1 / (1 + math.exp(logit(mean) - logit(path))), rel=1e-9)


def grams(text):
    """Hashed n-grams of one text, by itself."""
    letters = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode())
    letters = re.sub(rb" +", b" ", letters).removeprefix(b" ")
    return [(int.from_bytes(letters[i:i + n], "big") * 2654435761 % 2 ** 32 >> 18) + k * langid.BUCKETS
            for k, n in enumerate(langid.ORDERS) for i in range(len(letters) - n + 1)]


def test_language_model_equals_the_formulas(spark):
    rng = random.Random(4)
    sounds = {"xa": ["ka", "to", "mi"], "xb": ["ka", "ru", "é"], "xc": ["zh", "to", "ü"], "xd": ["pe", "漢"], "xe": ["pe", "qu", "mi"],
              "xf": ["ß", "ru", "zh"]}
    rows = [(lang, " ".join("".join(rng.choices(s, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 25))) + rng.choice(["", ". ", "!"]))
            for lang, s in sounds.items() for _ in range(40)]
    rows = [(x, rng.choice(["", "  ", "12 "]) + t) for x, t in rows]
    df = spark.createDataFrame(rows + rows[:30], "lang string, text string").repartition(3)
    model = langid.train(df)
    assert model.languages == sorted(sounds)
    split = {r["t"]: r["fit"] for r in df.select(F.lower("text").alias("t")).distinct().withColumn(
        "fit", F.pmod(F.xxhash64("t", F.lit(1)), F.lit(2)) == 0).collect()}
    distinct = sorted({(x, t.lower()) for x, t in rows})
    rate = np.full((6, langid.N_FEATURES), 0.5)
    for x, t in distinct:
        if not split[t]:
            for g in grams(t):
                rate[model.languages.index(x), g] += 1
    for k in range(len(langid.ORDERS)):
        part = rate[:, k * langid.BUCKETS:(k + 1) * langid.BUCKETS]
        part /= part.sum(1, keepdims=True)
    weights = np.stack([np.log(rate[bit > 0].mean(0) / rate[bit < 0].mean(0)) for bit in model.code.T], 1)
    np.testing.assert_allclose(model.weights, weights, rtol=1e-4, atol=1e-6)

    def evidence(t):
        g = grams(t)
        return weights[g].sum(0) / math.sqrt(1 + len(g)) if g else np.zeros(weights.shape[1])

    fit = [(x, evidence(t)) for x, t in distinct if split[t]]
    truth = np.array([model.code[model.languages.index(x)] > 0 for x, _ in fit])
    e = np.array([v for _, v in fit])
    p = 1 / (1 + np.exp(-np.clip(model.slope * e + model.offset, -30, 30)))
    # the penalised likelihood is at its top: no slope where the weight is free
    free = model.slope > 1e-3
    assert np.abs(((p - truth) * e).sum(0) + 0.01 * model.slope)[free].max() < 0.01
    assert np.abs((p - truth).sum(0) + 0.01 * model.offset)[free].max() < 0.01
    np.testing.assert_allclose(model.worth, np.maximum(2 * ((p > 0.5) == truth).mean(0) - 1, 0.05))

    probe = [t for _, t in rows[::7]] + ["", "123", None, " to", "to ", "é", "x" * 5000]
    got = {r["id"]: r for r in langid.identify(spark, spark.createDataFrame(list(enumerate(probe)), "id int, text string").coalesce(1), model).collect()}
    for i, t in enumerate(probe):
        if not re.search(r"[^\W\d_]", t or ""):
            assert got[i]["lang_pred"] == "und"
            continue
        odds = np.clip(model.slope * evidence(t) + model.offset, -30, 30)
        loss = np.array([sum(w * math.log1p(math.exp(-c * o)) for w, c, o in zip(model.worth, word, odds)) for word in model.code])
        assert got[i]["lang_pred"] == model.languages[loss.argmin()], t
        assert got[i]["score"] == pytest.approx(1 / np.exp(loss.min() - loss).sum(), rel=1e-4)
