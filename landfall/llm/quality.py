"""Quality classification by hierarchical empirical Bayes.

A document classifier gives each text's log odds of being good and of being
toxic; the documents of a host, and of a path of a host, give posteriors of the
rate there; a document's final odds combine all three.

* Classifier: each distinct word of a text, each beginning of ``PREFIXES`` bytes of a
  longer word (for families of word forms), and each surface measure put into a bin,
  is a feature.  The ``FEATURES`` features of each kind with the largest
  z-scores are kept, if both halves of the sample agree on them; near copies of a text
  are in one half (split by the smallest word hash), so words of one much-copied text
  don't pass.  A logistic regression with a ridge penalty weighs the features kept.
* Hierarchy: rates are beta-binomial.  The global rate is the mean over all
  documents; a host's posterior mean is (its sum + s * global) / (its count + s) and
  a path's (its sum + t * host) / (its count + t), with s and t found by the method of
  moments from the spread between groups: where hosts hardly differ, sparse ones
  shrink all the way.  A document adds its label where it has one, else its
  classifier probability, and is left out of its own host and path (leave one out).
* Final odds: classifier odds times path odds over global odds.

Group sums are ordinary grouped aggregates (partial sums before the shuffle, so a
host with a third of all rows is no matter); only ids and probabilities are
shuffled, never texts.  The classifier is fitted on about ``sample_rows`` labelled
rows (default 20000, chosen by hash); everything else covers all documents.

Defined results: a null or empty text has its surface measures only; null hosts
and paths are groups of their own; several labels of a document are averaged and
a null label is none; without labels of a kind all classifier odds are 0; repeated
rows are scored each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, fold, mix, slices, span_hashes, table, text_buffers, word_spans
from landfall.llm.langid import LETTER

SAMPLE_ROWS = 20_000
#: Features of each kind, the z-score they must reach (half of it in each half), how many documents must have them; ridge.
FEATURES, MIN_Z, MIN_DOCS, RIDGE = 300, 4.0, 8, 0.3
KINDS = ("quality", "toxic")
PREFIXES = (4, 6)
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def surface(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, n_distinct: np.ndarray) -> Iterator[np.ndarray]:
    """A bin for each text and measure: shares of upper case, digits, symbols, bars, long words, repeats; length."""
    size = np.maximum(np.diff(offsets), 1)
    count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
    n_words = np.maximum(words, 1)
    for share in (count(UPPER[data]) / size, count(DIGIT[data]) / size, count(SYMBOL[data]) / size, count(data == 124) / n_words,
                  count(data == 10) / n_words, 1 - n_distinct / n_words):
        yield np.minimum(np.sqrt(np.maximum(share, 0)) * 20, 31).astype(np.int64)
    yield np.minimum(size / n_words, 31).astype(np.int64)
    yield np.log2(n_words).astype(np.int64)


def features(texts: pa.Array, lowered: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of the texts and the row of each; those of a word come as often as it does."""
    low, low_at = text_buffers(lowered)
    low = LETTER[low]
    begin, end = word_spans(low, low_at)
    owner = np.searchsorted(low_at, begin, "right") - 1
    n = len(low_at) - 1
    words = span_hashes(low, begin, end)
    order = np.lexsort((words, owner))
    new = np.ones(len(words), bool)
    new[1:] = (np.diff(words[order]) != 0) | (np.diff(owner) != 0)
    hashes, owners = [words], [owner]
    for length in PREFIXES:
        longer = end - begin > length
        hashes.append(mix(span_hashes(low, begin[longer], begin[longer] + length) + np.uint64(length)))
        owners.append(owner[longer])
    for k, b in enumerate(surface(*text_buffers(texts), np.bincount(owner, minlength=n), np.bincount(owner[new], minlength=n))):
        hashes.append(mix(np.uint64(k + 1) * np.uint64(1 << 32) + b.astype(np.uint64)))
        owners.append(np.arange(n))
    return np.concatenate(hashes), np.concatenate(owners)


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values, by row."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


class Weights:
    """Sorted feature hashes, their weights for each kind, and each kind's offset."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
        self.hashes, self.weights, self.offsets = hashes, weights, offsets

    def present(self, texts: pa.Array, lowered: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Positions among ``hashes`` of the texts' features, and the row of each."""
        found, owner = features(texts, lowered)
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        known = self.hashes[at] == found
        return distinct(at[known], owner[known])

    def evidence(self, texts: pa.Array, lowered: pa.Array) -> np.ndarray:
        """Log odds of each text and kind."""
        at, owner = self.present(texts, lowered)
        return np.stack([np.bincount(owner, weights=self.weights[at, k], minlength=len(texts)) + self.offsets[k]
                         for k in range(len(KINDS))], 1)


def ridge_regression(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and offset of a penalised logistic regression, by Newton's method with halved steps."""
    x = np.append(x, np.ones((len(x), 1), x.dtype), axis=1)
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    beta = np.zeros(x.shape[1])
    loss = lambda b: np.logaddexp(0, -(2 * y - 1) * (x @ b)).sum() + 0.5 * (penalty * b * b).sum()
    now = loss(beta)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = np.diag(penalty)
        for at in range(0, len(x), 2000):  # in blocks: the weighted rows are a copy
            block = x[at:at + 2000]
            hessian += (block * (p[at:at + 2000] * (1 - p[at:at + 2000]))[:, None].astype(x.dtype)).T @ block
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * beta)
        while loss(beta - step) > now + 1e-9 and np.abs(step).max() > 1e-8:
            step = step / 2
        beta, before = beta - step, now
        now = loss(beta)
        if before - now < 1e-6 * max(1.0, before):
            break
    return beta[:-1], float(beta[-1])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Weights:
    """``docs``: doc_id, text; ``labels``: doc_id, quality, toxic (0/1 or null)."""
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*(F.avg(F.col(k).cast("double")).alias(k) for k in KINDS))
    n = one.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # about sample_rows rows of three numbers: small by choice
    one = one.where(part < (sample_rows / n if n else 0.0))
    rows = docs.join(F.broadcast(one), "doc_id").select("text", F.lower("text").alias("low"), *KINDS)
    names = [f"{k}{v}{half}" for k in KINDS for v in "10" for half in "ab"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            found, owner = distinct(*features(batch.column("text"), batch.column("low")))
            least = np.full(batch.num_rows, np.iinfo(np.uint64).max)
            np.minimum.at(least, owner, found)
            second = (mix(least) & np.uint64(1)).astype(bool)[owner]
            each, where = np.unique(found, return_inverse=True)
            out = [pa.array(each.view(np.int64))]
            for k in KINDS:
                y = np.array([np.nan if v is None else v for v in batch.column(k).to_pylist()], float)[owner]
                for v in (y, 1 - y):
                    for half in (~second, second):
                        out.append(pa.array(np.bincount(where, weights=np.nan_to_num(v) * half, minlength=len(each))))
            yield pa.RecordBatch.from_arrays(out, names=["feature", *names])

    counted = rows.mapInArrow(count, "feature long, " + ", ".join(f"{x} double" for x in names)).groupBy("feature").agg(
        *(F.sum(x).alias(x) for x in names))
    totals = rows.agg(*(F.sum(F.col(k)).alias(f"{k}1") for k in KINDS), *(F.sum(1 - F.col(k)).alias(f"{k}0") for k in KINDS)).first()
    kept: set[int] = set()
    for k in KINDS:
        n1, n0 = totals[f"{k}1"] or 0.0, totals[f"{k}0"] or 0.0
        if not n1 or not n0:
            continue
        rate = n1 / (n1 + n0)
        z = lambda y1, y0: (y1 - (y1 + y0) * rate) / F.sqrt(F.greatest((y1 + y0) * rate * (1 - rate), F.lit(1e-9)))
        col = lambda v, half: F.col(f"{k}{v}{half}")
        whole = z(col(1, "a") + col(1, "b"), col(0, "a") + col(0, "b"))
        both = F.least(z(col(1, "a"), col(0, "a")) * F.signum(whole), z(col(1, "b"), col(0, "b")) * F.signum(whole))
        seen = sum((col(v, half) for v in "10" for half in "ab"), F.lit(0.0))
        good = counted.where((F.abs(whole) >= MIN_Z) & (both >= MIN_Z / 2) & (seen >= MIN_DOCS))
        kept |= {r["feature"] for r in good.orderBy(F.desc(F.abs(whole)), "feature").select("feature").limit(FEATURES).collect()}
    hashes = np.sort(np.array(sorted(kept), np.int64).view(np.uint64))
    model = Weights(hashes, np.zeros((len(hashes), len(KINDS))), np.zeros(len(KINDS)))
    if not len(hashes):
        return model
    shared = spark.sparkContext.broadcast(model)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            at, owner = shared.value.present(batch.column("text"), batch.column("low"))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KINDS), lists], names=[*KINDS, "at"])

    fit = rows.mapInArrow(matrix, f"{', '.join(f'{k} double' for k in KINDS)}, at array<int>").toPandas()
    for j, k in enumerate(KINDS):
        known = fit[fit[k].notna()] if len(fit) else fit
        if len(known) and known[k].nunique() > 1:
            x = np.zeros((len(known), len(hashes)), np.float32)
            for i, at in enumerate(known["at"]):
                x[i, at] = 1
            model.weights[:, j], model.offsets[j] = ridge_regression(x, known[k].to_numpy(float))
    return model


def _evidence(spark: SparkSession, model: Weights, keep: tuple[str, ...]):
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            e = shared.value.evidence(batch.column("text"), batch.column("low"))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(e.tolist(), pa.list_(pa.float64()))],
                                             names=[*keep, "e"])

    return run


def strength(groups: DataFrame, y: str, n: str, mean: Column) -> Column:
    """Method of moments over groups (size ``n``, sum ``y``, prior mean ``mean``): pseudo-counts of the prior, as an aggregate."""
    rate = F.col(y) / F.col(n)
    noise = F.sum(mean * (1 - mean))
    spread = F.sum(F.col(n) * (rate - mean) * (rate - mean)) - noise  # beyond what chance gives
    between = spread / F.sum(F.col(n))
    inner = noise / F.count("*")
    return F.when(between > 0, F.least(F.greatest(inner / between - 1, F.lit(1.0)), F.lit(1e6))).otherwise(F.lit(1e6))


def posteriors(rows: DataFrame) -> DataFrame:
    """Add, for each kind k with probability column k: k_global, k_host, k_path (leave one out), each a rate.

    ``rows``: host, path and a value in 0..1 for each kind, one row for each document.
    """
    sums = lambda: [F.sum(k).alias(f"{k}_y") for k in KINDS] + [F.count("*").alias("n")]
    paths = rows.groupBy("host", "path").agg(*sums())
    hosts = paths.groupBy("host").agg(*(F.sum(f"{k}_y").alias(f"{k}_hy") for k in KINDS), F.sum("n").alias("hn"))
    whole = hosts.agg(*((F.sum(f"{k}_hy") / F.sum("hn")).alias(k) for k in KINDS)).first()
    mean = {k: min(max(whole[k] if whole[k] is not None else 0.5, 1e-6), 1 - 1e-6) for k in KINDS}
    s = hosts.agg(*(strength(hosts, f"{k}_hy", "hn", F.lit(mean[k])).alias(k) for k in KINDS)).first()
    s = {k: s[k] if s[k] is not None else 1e6 for k in KINDS}
    at_host = lambda k: (F.col(f"{k}_hy") + s[k] * mean[k]) / (F.col("hn") + s[k])
    both = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    t = both.agg(*(strength(both, f"{k}_y", "n", at_host(k)).alias(k) for k in KINDS)).first()
    t = {k: t[k] if t[k] is not None else 1e6 for k in KINDS}
    both = both.withColumnsRenamed({"host": "h", "path": "p"})
    out = rows.join(both, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))).drop("h", "p")
    for k in KINDS:
        host = (F.col(f"{k}_hy") - F.col(k) + s[k] * mean[k]) / (F.col("hn") - 1 + s[k])
        path = (F.col(f"{k}_y") - F.col(k) + t[k] * host) / (F.col("n") - 1 + t[k])
        clip = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
        out = out.withColumns({f"{k}_global": F.lit(mean[k]), f"{k}_host": clip(host), f"{k}_path": clip(path)})
    return out.drop("n", "hn", *(f"{k}_{x}" for k in KINDS for x in ("y", "hy")))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, host: Column, path: Column, learn: Column | None = None,
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text and what host and path are made of): doc_id, host, path,
    quality_doc, quality_host, quality_path, quality, toxic_doc, toxic_host, toxic_path, toxic, keep.

    ``learn``: which labels (by doc_id) may be learned from; default all.
    """
    ws = Workspace(spark, "quality")
    known = labels.select("doc_id", *KINDS)
    if learn is not None:
        known = known.where(learn)
    model = train(spark, docs.select("doc_id", "text"), known, sample_rows)
    ready = docs.select("doc_id", "text", F.lower("text").alias("low"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = ready.mapInArrow(_evidence(spark, model, ("doc_id", "host", "path")),
                              f"doc_id {kind}, host string, path string, e array<double>")
    odds = {k: F.col("e")[j] for j, k in enumerate(KINDS)}
    scored = ws.keep(scored.select("doc_id", "host", "path", *(o.alias(f"{k}_odds") for k, o in odds.items())), "odds")
    one = known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*(F.avg(F.col(k).cast("double")).alias(f"{k}_label") for k in KINDS))
    rate = lambda o: 1 / (1 + F.exp(-o))
    rows = scored.join(one, "doc_id", "left").select(
        "doc_id", "host", "path", *(f"{k}_odds" for k in KINDS),
        *(F.coalesce(f"{k}_label", rate(F.col(f"{k}_odds"))).alias(k) for k in KINDS))
    logit = lambda c: F.log(c / (1 - c))
    out = posteriors(rows)
    final = {k: rate(F.col(f"{k}_odds") + logit(F.col(f"{k}_path")) - logit(F.col(f"{k}_global"))) for k in KINDS}
    return out.select(
        "doc_id", "host", "path", *(c for k in KINDS for c in (
            rate(F.col(f"{k}_odds")).alias(f"{k}_doc"), F.col(f"{k}_host"), F.col(f"{k}_path"), final[k].alias(k))),
        ((final["quality"] >= 0.5) & (final["toxic"] < 0.5)).alias("keep"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; host: source, path: language within the source; labels of fold 0 of 5 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = classify(spark, docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"), learn=fold(F.col("doc_id"), 5) != 0)
    return out.withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
