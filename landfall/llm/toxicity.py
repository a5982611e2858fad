"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

* Lexicon: words, and beginnings of ``PREFIXES`` bytes of longer words (for families of
  word forms), that are the more frequent in toxic texts of the sample.  An entry is kept if
  its log-likelihood ratio beats what chance gives the best of all candidates
  (ln of their number, plus ``MARGIN``), so the list holds no more than the labels
  prove at any size of the sample; near copies of a text count once.
* Dense features (``FEATURES``): densities and strengths of lexicon words and families,
  hits that show only after look-alike symbols are read as letters (obfuscation),
  second-person words and their nearness to hits, capitals, punctuation, obfuscation
  rate, stretched letters, digits, length.
* Trees: Spark's GBTClassifier on the folds of the sample that the lexicon also learned
  from; isotonic regression (Spark's) on a fold that neither has seen turns their
  margins into probabilities.

The lexicon and the trees are fitted on about ``sample_rows`` (default 40,000) distinct
labelled (id, text) pairs, chosen by hash and counted before the choice, so repeated
rows don't make the sample larger; scoring is one pass over all rows without a shuffle
of texts.  Labels, language, source and id are never features.

Defined results: a null text is scored as an empty one; several labels of an id are
averaged and a half counts as toxic; a null label is none; labels of a null id are none;
if the trees' folds lack one of the classes every score is the share of toxic rows among
them (0 without any), and without both classes in the calibration fold the trees'
probability is the score; repeated rows are scored each; no rows give no rows; other
columns are ignored.  Letters fold case in ASCII and Latin-1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import LOWER, Workspace, fold, mix, slices, span_hashes, table, text_buffers, word_spans

SAMPLE_ROWS = 40_000
#: Entries of each kind at most; the log-likelihood ratio beyond that of the luckiest candidate; least documents.
ENTRIES, MARGIN, MIN_DOCS = 2000, 2.0, 3
PREFIXES = (4, 5, 6, 8)
#: Words on either side of a hit within which a second-person word is near.
NEAR = 5
TREES, DEPTH, STEP = 20, 3, 0.3
TURN = np.uint64(0x9FB21C651E98DF25)

#: Second-person words of four languages.
SECOND_PERSON = ("you your yours yourself yourselves u ya du dich dir dein deine deinen deinem deiner ihr euch euer eure "
                 "tu te toi ton ta tes vous votre vos tú ti tus contigo usted ustedes vosotros os").split()
#: Symbols that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}

FEATURES = ("word_density", "family_density", "strength_density", "strength_max", "hits", "hidden_density", "hidden_hits",
            "second_person", "near_second_person", "capitals", "capital_words", "exclamations", "punctuation", "obfuscated",
            "stretched", "digits", "length")

IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = IS_LETTER[128:] = True
ONLY_LETTERS = np.where(IS_LETTER, np.arange(256), 32).astype(np.uint8)
IS_UPPER = np.zeros(256, bool)
IS_UPPER[65:91] = True
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[48:58] = True
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: What a byte is read as inside a word: letters as they are, look-alikes as letters, 0 for the rest.
READ_AS = np.where(IS_LETTER, np.arange(256), 0).astype(np.uint8)
for _symbol, _letter in LOOKALIKES.items():
    READ_AS[ord(_symbol)] = ord(_letter)


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the letters À to Þ (bytes C3 80 to C3 9E but for the sign at 97)."""
    low = LOWER[data]
    if len(low) > 1:
        accented = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][accented] += 0x20
    return low


def entries_of(low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, word numbers, hashes): kind 0 the words, then the beginnings of each length of longer ones."""
    yield 0, np.arange(len(begin)), span_hashes(low, begin, end)
    for length in PREFIXES:
        (longer,) = np.nonzero(end - begin > length)
        yield length, longer, mix(span_hashes(low, begin[longer], begin[longer] + length) + np.uint64(length))


class Lexicon:
    """Sorted hashes of words and of beginnings, with their strengths (log odds)."""

    def __init__(self, words: list[tuple[int, float]], families: list[tuple[int, float]]):
        self.kinds = []
        for found in (words, families):
            hashes = np.array([h for h, _ in found], np.int64).view(np.uint64)
            order = np.argsort(hashes)
            self.kinds.append((hashes[order], np.array([s for _, s in found], float)[order]))

    def strengths(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Strength of each word as a word and as one of a family, 0 if it isn't in the list."""
        out = np.zeros((2, len(begin)))
        for kind, numbers, hashes in entries_of(low, begin, end):
            known, strength = self.kinds[kind > 0]
            if len(known) and len(hashes):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                np.maximum.at(out[int(kind > 0)], numbers, np.where(known[at] == hashes, strength[at], 0.0))
        return out[0], out[1]


def _second_person() -> np.ndarray:
    raw = [w.encode() for w in SECOND_PERSON]
    end = np.cumsum([len(w) for w in raw])
    return np.unique(span_hashes(np.frombuffer(b"".join(raw), np.uint8), end - [len(w) for w in raw], end))


SECOND_PERSON_HASHES = _second_person()


def hidden_words(low: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens between spaces with something else between their letters: the token numbers of all, begin and end of all tokens, and
    bytes, begins and ends of the two ways to read each (from first to last letter, and whole)."""
    begin, end = word_spans(data, offsets)
    (letters,) = np.nonzero(IS_LETTER[low])
    a, b = np.searchsorted(letters, begin), np.searchsorted(letters, end)
    (some,) = np.nonzero(b - a >= 2)
    first, last = letters[a[some]], letters[b[some] - 1] + 1
    mixed = last - first > (b - a)[some]
    tokens, first, last = some[mixed], first[mixed], last[mixed]
    inside = np.zeros(len(low) + 1, np.int8)
    inside[begin[tokens]] = 1
    inside[end[tokens]] -= 1
    read = READ_AS[low]
    keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) & (read != 0)
    moved = np.concatenate([[0], np.cumsum(keep)])
    return tokens, begin, end, read[keep], np.concatenate([moved[first], moved[begin[tokens]]]), np.concatenate([moved[last], moved[end[tokens]]])


def measure(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """FEATURES of each text."""
    n = len(offsets) - 1
    low = lowered(data)
    owner_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
    tally = lambda owner, weights=None: np.bincount(owner, weights=weights, minlength=n)
    begin, end = word_spans(ONLY_LETTERS[low], offsets)
    owner = owner_of(begin)
    word, family = lexicon.strengths(low, begin, end)
    strength = np.maximum(word, family)
    hit = strength > 0
    words = np.maximum(tally(owner), 1)
    # second-person words, and hits with one within NEAR words in the same text
    second = np.isin(span_hashes(low, begin, end), SECOND_PERSON_HASHES)
    so_far = np.concatenate([[0], np.cumsum(second)])
    first_word = np.searchsorted(begin, offsets)
    (at,) = np.nonzero(hit)
    low_word, high_word = np.maximum(at - NEAR, first_word[owner[at]]), np.minimum(at + NEAR + 1, first_word[owner[at] + 1])
    near = so_far[high_word] > so_far[low_word]
    # hits that show only when look-alikes are read as letters
    tokens, t_begin, t_end, read, r_begin, r_end = hidden_words(low, offsets, data)
    t_owner = owner_of(t_begin)
    n_tokens = np.maximum(tally(t_owner), 1)
    order = np.lexsort((r_end, r_begin))  # span hashes are taken in order
    found = np.zeros(len(r_begin))
    found[order] = np.maximum(*lexicon.strengths(read, r_begin[order], r_end[order]))
    found = found.reshape(2, -1).max(0) > 0
    open_hits = np.zeros(len(t_begin), bool)
    open_hits[np.searchsorted(t_begin, begin[hit], "right") - 1] = True
    hidden = tally(t_owner[tokens], (found & ~open_hits[tokens]).astype(float))
    upper = IS_UPPER[data]
    uppers = np.concatenate([[0], np.cumsum(upper)])
    shouted = (end - begin >= 2) & (uppers[end] - uppers[begin] == end - begin)
    stretched = np.zeros(len(low), bool)
    stretched[2:] = IS_LETTER[low[2:]] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    size, letters = np.maximum(np.diff(offsets), 1), np.maximum(per_text(IS_LETTER[low]), 1)
    hits, top = tally(owner, hit.astype(float)), np.zeros(n)
    np.maximum.at(top, owner, strength)
    return np.stack([
        tally(owner, (word > 0).astype(float)) / words, tally(owner, (family > 0).astype(float)) / words, tally(owner, strength) / words, top,
        np.log1p(hits), hidden / n_tokens, np.log1p(hidden), tally(owner, second.astype(float)) / words,
        tally(owner[at], near.astype(float)) / np.maximum(hits, 1), per_text(upper) / letters, tally(owner, shouted.astype(float)) / words,
        per_text((data == 33) | (data == 63)) / words, per_text(IS_SYMBOL[data]) / size, tally(t_owner[tokens]) / n_tokens,
        per_text(stretched) / words, per_text(IS_DIGIT[data]) / size, np.log2(words)], 1)


def densely(frame: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and x, the features of ``text`` (array of double)."""
    shared = frame.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in slices(whole, text)):
            x = measure(*text_buffers(batch.column(text)), shared.value)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], [*keep, "x"])

    schema = T.StructType([*(frame.schema[c] for c in keep), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return frame.select(*keep, text).mapInArrow(run, schema)


def learn_lexicon(sample: DataFrame, ws: Workspace) -> Lexicon:
    """``sample``: doc_id, h, text, y (0 or 1)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The two smallest hashes of three words in a row (of the words of shorter texts): near copies share them."""
        for batch in (piece for whole in batches for piece in slices(whole, "text")):
            data, offsets = text_buffers(batch.column("text"))
            low = lowered(data)
            begin, end = word_spans(ONLY_LETTERS[low], offsets)
            words, at = span_hashes(low, begin, end), np.searchsorted(begin, offsets)
            rows = mix(words[:-2] + TURN * mix(words[1:-1] + TURN * words[2:]))
            two = [np.unique(rows[a:b - 2] if b - a > 2 else words[a:b])[:2].view(np.int64).tolist() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), batch.column("y"), pa.array(two, pa.list_(pa.int64()))],
                                             names=["doc_id", "h", "y", "signature"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    signed = sample.mapInArrow(sign, f"doc_id {kind}, h long, y double, signature array<long>")
    one = signed.groupBy("signature", "y").agg(F.min(F.struct("doc_id", "h")).alias("one")).select("one.doc_id", "one.h")
    chosen = ws.keep(sample.join(one, ["doc_id", "h"]), "texts-once")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in slices(whole, "text")):
            data, offsets = text_buffers(batch.column("text"))
            low = lowered(data)
            begin, end = word_spans(ONLY_LETTERS[low], offsets)
            owner = np.searchsorted(offsets, begin, "right") - 1
            toxic = batch.column("y").to_numpy() > 0.5
            for k, numbers, hashes in entries_of(low, begin, end):
                order = np.lexsort((owner[numbers], hashes))
                h, o = hashes[order], owner[numbers][order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                each, where = np.unique(h[new], return_inverse=True)
                bad = np.bincount(where, weights=toxic[o[new]], minlength=len(each)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(each), k, np.int32)), pa.array(each.view(np.int64)), pa.array(bad),
                     pa.array(np.bincount(where, minlength=len(each)).astype(np.int64) - bad)], names=["kind", "entry", "a", "b"])

    counted = chosen.mapInArrow(count, "kind int, entry long, a long, b long").groupBy("kind", "entry").agg(
        F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b")).where(F.col("a") + F.col("b") >= MIN_DOCS)
    counted = ws.keep(counted, "counted")
    whole = chosen.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, n, candidates = float(whole["toxic"] or 0), whole["n"], counted.count()
    if not candidates or not 0 < toxic < n:
        return Lexicon([], [])
    rate, a, b = toxic / n, F.col("a"), F.col("b")
    part = lambda c, share: F.when(c > 0, c * F.log(c / ((a + b) * share))).otherwise(0.0)
    good = counted.withColumn("ratio", part(a, rate) + part(b, 1 - rate)).where(
        (a > (a + b) * rate) & (F.col("ratio") >= float(np.log(candidates)) + MARGIN))
    good = good.withColumn("strength", F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (n - toxic + 1)))
    lists = [good.where(which).orderBy(F.desc("ratio"), "entry").limit(ENTRIES).select("entry", "strength").collect()
             for which in (F.col("kind") == 0, F.col("kind") > 0)]
    return Lexicon(*([(r["entry"], r["strength"]) for r in rows] for rows in lists))


class Model:
    """The lexicon, the trees and the calibration; a constant where there is nothing to learn from."""

    def __init__(self, lexicon: Lexicon, trees: GBTClassificationModel | None, calibration: IsotonicRegressionModel | None, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def margin(self, dense: DataFrame) -> DataFrame:
        """``dense`` with the trees' probability as p instead of x."""
        scored = self.trees.transform(dense.withColumn("features", array_to_vector("x")))
        return scored.withColumn("p", vector_to_array("probability")[1]).drop("x", "features", "rawPrediction", "probability", "prediction")

    def score(self, frame: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """``keep`` and score."""
        if self.trees is None:
            return frame.select(*keep, F.lit(self.constant).alias("score"))
        out = self.margin(densely(frame, self.lexicon, keep, text))
        if self.calibration is None:
            return out.withColumnRenamed("p", "score")
        out = self.calibration.transform(out)
        return out.select(*keep, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))).alias("score"))


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int, ws: Workspace) -> DataFrame:
    """doc_id, h, text, y of about ``sample_rows`` distinct labelled (doc_id, text) pairs, written."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("toxic").cast("double")).alias("y"))
    known = known.select("doc_id", (F.col("y") >= 0.5).cast("double").alias("y"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    pairs = ws.keep(texts.select("doc_id", "h").join(known, "doc_id").groupBy("doc_id", "h").agg(F.first("y").alias("y")), "pairs")
    n = pairs.count()
    place = F.pmod(F.xxhash64("doc_id", "h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = pairs.where(place < (sample_rows / n if n else 0.0))
    # about sample_rows rows of three numbers: small by choice
    return ws.keep(texts.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]), "sample")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, calibrate: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic; ``calibrate``: which ids (by doc_id) are kept for the calibration."""
    ws = Workspace(spark, "toxicity")
    sample = labelled_sample(spark, docs, labels, sample_rows, ws).withColumn("held", calibrate)
    learn = sample.where("NOT held")
    totals = learn.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, n = float(totals["toxic"] or 0), totals["n"]
    if not 0 < toxic < n:
        return Model(Lexicon([], []), None, None, toxic / n if n else 0.0)
    lexicon = learn_lexicon(learn.select("doc_id", "h", "text", "y"), ws)
    dense = ws.keep(densely(sample, lexicon, ["y", "held"]), "dense")
    rows = dense.where("NOT held").select("y", array_to_vector("x").alias("features"))
    trees = GBTClassifier(labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=3, seed=11).fit(rows)
    model = Model(lexicon, trees, None, 0.0)
    unseen = model.margin(dense.where("held"))
    if unseen.agg(F.countDistinct("y")).first()[0] == 2:
        model.calibration = IsotonicRegression(featuresCol="p", labelCol="y", predictionCol="calibrated").fit(unseen)
    return model


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels of fold 0 of 5 are held out, fold 4 calibrates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    model = train(spark, docs, labels, fold(F.col("doc_id"), 5) == 4)
    out = model.score(docs, ["doc_id"])
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
