"""Language identification with error-correcting output codes.

Each language has a codeword; each bit of it is predicted by a binary classifier
over byte n-grams (naive Bayes: the log ratio of an n-gram's mean rate in the
languages whose bit is one and in those whose bit is zero, so that frequent
languages don't outweigh rare ones).  A one-dimensional logistic fit turns a
bit's evidence into log odds.  Decoding adds, for each language, the logistic
losses of its bits, each weighted by what the bit's classifier is worth on the
fitting rows, and picks the smallest; ``score`` is the soft minimum's share and
``ambiguous`` tells that the runner-up is close.

Up to five languages have the exhaustive code (every split into two sides), more
have the best of a number of seeded random codes.

Training reads text and language of a bounded sample of the labelled rows:
about ``rows_per_language`` (default 2000) different texts, chosen by their hash,
whole; copies of a text are one, so however often it is there the sample stays
bounded; half of them give the n-gram rates, half the logistic fits and weights.
What reaches the driver is bounded by languages x n-gram buckets and sample rows.

Defined results: a null text, or one with no letter, is ``und`` with score 0 and
ambiguous; with no labelled rows every text is ``und``; with one language every
text with a letter is that, score 1; rows with a null label are not learned from
but are predicted; repeated rows are predicted each; ties go to the language that
sorts first.  Other columns pass through; one with the name of an added column is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import SLICE_BYTES, fold, slices, table, text_buffers, without

ORDERS, BUCKETS = (2, 3, 4), 1 << 14
N_FEATURES = len(ORDERS) * BUCKETS
UNKNOWN = "und"
#: Letters of ASCII (lower-cased before) and all bytes from 0x80 count; other bytes are a space.
LETTER = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order and run of about SLICE_BYTES: hashed n-grams of the texts one after the other, and the row
    offsets among them."""
    clean = LETTER[data]
    # runs of spaces count as one
    space = clean == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    first = offsets[:-1][offsets[:-1] < len(clean)]
    keep[first] = ~space[first]  # whatever the text before ends with
    kept = np.concatenate([[0], np.cumsum(keep)])
    clean, offsets = clean[keep], kept[offsets]
    for k, n in enumerate(ORDERS):
        for at in range(0, max(len(clean) - n + 1, 0), SLICE_BYTES):
            part = clean[at:at + SLICE_BYTES + n - 1].astype(np.uint32)
            edges = np.clip(offsets - at, 0, len(part))
            gram = part[:len(part) - n + 1].copy()
            for j in range(1, n):
                gram = gram << np.uint32(8) | part[j:len(part) - n + 1 + j]
            hashed = (gram * np.uint32(2654435761)) >> np.uint32(18)
            inside = np.ones(len(gram), bool)  # not across two texts
            for j in range(1, n):
                edge = offsets[1:-1] - at - j
                inside[edge[(edge >= 0) & (edge < len(gram))]] = False
            rank = np.concatenate([[0], np.cumsum(inside)])
            yield hashed[inside].astype(np.int64) + k * BUCKETS, rank[np.minimum(edges, len(gram))]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row sums of ``values`` between the offsets."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of n languages as rows of +1 and -1."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 5:
        bits = [[1, *(1 if c >> (n - 2 - j) & 1 else -1 for j in range(n - 1))] for c in range((1 << (n - 1)) - 1)]
        return np.array(bits, float).T
    rng, width, best, apart = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        code = code[:, np.abs(code.sum(0)) < n]
        agree = code @ code.T - 2 * width * np.eye(n)
        least = (code.shape[1] - agree.max()) / 2
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # features x bits
    slope: np.ndarray
    offset: np.ndarray
    worth: np.ndarray

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x bits: summed log ratios over the square root of the number of n-grams."""
        total, count = np.zeros((len(offsets) - 1, self.weights.shape[1])), np.ones(len(offsets) - 1)
        for grams, at in features(data, offsets):
            total += sums(self.weights[grams], at)
            count += np.diff(at)
        return total / np.sqrt(count)[:, None]

    def decode(self, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest language's index, its score, and its lead over the runner-up."""
        odds = np.clip(self.slope * evidence + self.offset, -30, 30)
        loss = np.stack([(self.worth * np.logaddexp(0, -word * odds)).sum(1) for word in self.code], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        ranked = np.sort(share, 1)
        return loss.argmin(1), ranked[:, -1], ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of P(y) = 1 / (1 + exp(-(slope x + offset))), by Newton's method."""
    beta, X = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (p - y) + ridge * beta
        step = np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + ridge * np.eye(2), grad)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = 2000) -> Model:
    """Fit on about ``rows_per_language`` different texts of each language of ``labelled``."""
    rows = labelled.select(F.lower(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    languages = sorted(counts)
    if len(languages) < 2:
        return Model(languages, codewords(len(languages)), *np.zeros((4, 0)))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.coalesce(*(F.when(F.col("lang") == x, min(1.0, rows_per_language / n)) for x, n in counts.items()))
    sample = rows.where(place < share).dropDuplicates(["lang", "text"]).withColumn("fit", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {x: np.zeros(N_FEATURES) for x in languages}
        for batch in (part for whole in batches for part in slices(whole, "text")):
            names = np.array(batch.column("lang").to_pylist(), object)
            for grams, at in features(*text_buffers(batch.column("text"))):
                owner = np.repeat(names, np.diff(at))
                for x in set(names):
                    seen[x] += np.bincount(grams[owner == x], minlength=N_FEATURES)
        for x, n in seen.items():
            (f,) = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(f), pa.string()), pa.array(f, pa.int64()), pa.array(n[f])],
                                             names=["lang", "feature", "n"])

    found = sample.where("NOT fit").select("text", "lang").mapInArrow(count, "lang string, feature long, n double")
    found = found.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    rate = np.full((len(languages), N_FEATURES), 0.5)
    np.add.at(rate, (np.searchsorted(languages, found["lang"].to_numpy(str)) if len(found) else [],
                     found["feature"].to_numpy(int)), found["n"].to_numpy(float))
    for k in range(len(ORDERS)):
        part = rate[:, k * BUCKETS:(k + 1) * BUCKETS]
        part /= part.sum(1, keepdims=True)
    code = codewords(len(languages))
    weights = np.stack([np.log(rate[bit > 0].mean(0) / rate[bit < 0].mean(0)) for bit in code.T], 1).astype(np.float32)
    ones = np.ones(code.shape[1])
    draft = Model(languages, code, weights, ones, ones * 0, ones)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            e = draft.evidence(*text_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(e.tolist(), pa.list_(pa.float64()))], names=["lang", "e"])

    fit = sample.where("fit").select("text", "lang").mapInArrow(measure, "lang string, e array<double>").toPandas()
    if len(fit):
        e = np.stack(fit["e"].to_numpy())
        truth = code[np.searchsorted(languages, fit["lang"].to_numpy(str))] > 0
        lines = np.array([logistic(e[:, b], truth[:, b].astype(float)) for b in range(code.shape[1])])
        draft.slope, draft.offset = np.maximum(lines[:, 0], 1e-3), lines[:, 1]
        right = ((draft.slope * e + draft.offset > 0) == truth).mean(0)
        draft.worth = np.maximum(2 * right - 1, 0.05)
    return draft


def identify(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", min_lead: float = 0.2) -> DataFrame:
    """Add lang_pred, score and ambiguous to ``docs``."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("ambiguous", T.BooleanType())]
    docs = without(docs, [*(f.name for f in fields), "_lower", "_letters"])
    names, schema = docs.columns, T.StructType([*docs.schema.fields, *fields])
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in (part for whole in batches for part in slices(whole, "_lower")):
            n = batch.num_rows
            letters = np.asarray(batch.column("_letters").to_pylist(), bool)
            if len(m.languages) > 1:
                best, score, lead = m.decode(m.evidence(*text_buffers(batch.column("_lower"))))
            else:
                best, score, lead = np.zeros(n, int), np.ones(n), np.ones(n)
            letters &= bool(m.languages)
            pred = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(pred, pa.string()), pa.array(np.where(letters, score, 0.0)),
                 pa.array(~letters | (lead < min_lead))], names=schema.names)

    ready = docs.withColumn("_lower", F.lower(text)).withColumn(
        "_letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return ready.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(spark, docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
