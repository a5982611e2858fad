"""Language-model scoring by deleted interpolation.

The model is P(w | h) = a_b f(w | h) + b_b f(w) + c_b / (V + 1): maximum-likelihood
bigram and unigram estimates and a uniform floor, mixed with weights that depend
on the bucket b = bit length of the context's count.  The weights are learned by
expectation-maximisation on counts held out of the estimates: the documents of
one fold of the training rows, predicted by the counts of the other folds.  The
estimates that score then use all training rows.

How it runs.  Documents are dealt into chunks of about ``chunk_bytes`` of text.

1. Each chunk sends its distinct n-gram hashes, sorted, with its counts, to hash
   buckets: an n-gram is there once for each chunk, however often it occurs.
2. Each bucket sums the counts and answers every chunk, in the order asked.
3. Each chunk meets its answers again and scores its documents.

So no n-gram's occurrences ever meet in one task, and nothing of the size of the
vocabulary reaches the driver or is broadcast.  The driver gets N, V and, for the
weights, a histogram of (bucket, both estimates on a quarter-bit scale), which
is bounded by its cells.  Hashes have 64 bits.

Defined results: a null or empty text is its end token only; repeated rows count
and are scored each; a row whose ``train`` flag is null isn't learned from; with
no training rows the score is that of the uniform floor; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, fold, mix, rows_of, slices, table, text_buffers, word_hashes

CHUNK_BYTES = 8 << 20
END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567696E)
ASK = "bucket long, chunk long, kind int, held boolean, hashes binary, counts binary"
ANSWER = "chunk long, kind int, bucket long, whole binary, rest binary, stat array<long>"


def shuffle_bytes(a: np.ndarray) -> bytes:
    """Bytes of an array by significance: sorted hashes and small counts then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unshuffle_bytes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def tokens(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of the chunk's documents, bigram hashes (with the token before), and the row of each token."""
    words, owners = [], []
    at = 0
    for batch in (part for whole in chunk.combine_chunks().to_batches() for part in slices(whole, "text")):
        h, offsets = word_hashes(*text_buffers(batch.column("text")))
        row = rows_of(offsets)
        words.append(np.insert(h, offsets[1:], END))
        owners.append(np.insert(row, offsets[1:], np.arange(batch.num_rows)) + at)
        at += batch.num_rows
    word = np.concatenate(words) if words else np.zeros(0, np.uint64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.flatnonzero(np.diff(owner, prepend=-1))] = BEGIN
    with np.errstate(over="ignore"):
        pair = mix(mix(before) * np.uint64(0x9FB21C651E98DF25) + word)
    return word, pair, owner


def ask(key: tuple, chunk: pa.Table, buckets: int, last: int) -> pa.Table:
    """Rows of ASK for one chunk; ``last``: chunks from this number are held out."""
    word, pair, owner = tokens(chunk)
    learn = np.asarray(chunk.column("train").to_pylist(), bool)
    rows = []
    me = key[0].as_py()
    single = np.concatenate([word, np.full(len(learn), BEGIN)])
    for kind, grams, used in ((1, single, np.concatenate([learn[owner], learn])), (2, pair, learn[owner])):
        distinct, where = np.unique(grams, return_inverse=True)
        counts = np.bincount(where, weights=used, minlength=len(distinct)).astype(np.uint32)
        shift = np.uint64(64 - int(buckets).bit_length() + 1) if buckets > 1 else None
        of = (distinct >> shift).astype(np.int64) if shift is not None else np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(of, np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = edges[b], edges[b + 1]
            if hi > lo:
                rows.append((b, me, kind, me >= last, shuffle_bytes(distinct[lo:hi]), shuffle_bytes(counts[lo:hi])))
    return pa.table(list(map(list, zip(*rows))) if rows else [[]] * 6, schema=pa.schema([
        ("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("held", pa.bool_()), ("hashes", pa.binary()),
        ("counts", pa.binary())]))


ANSWER_SCHEMA = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("whole", pa.binary()),
                           ("rest", pa.binary()), ("stat", pa.list_(pa.int64()))])


def answer(key: tuple, asked: pa.Table) -> pa.Table:
    """Sum a bucket's counts and answer each chunk; a row of chunk -1 has the bucket's [N, V] of all and of the rest."""
    rows = asked.to_pylist()
    out, stat, bucket = [], np.zeros(4, np.int64), key[0].as_py()
    for kind in (1, 2):
        mine = [r for r in rows if r["kind"] == kind]
        if not mine:
            continue
        hashes = [unshuffle_bytes(r["hashes"], np.uint64) for r in mine]
        counts = [unshuffle_bytes(r["counts"], np.uint32) for r in mine]
        distinct, where = np.unique(np.concatenate(hashes), return_inverse=True)
        whole = np.bincount(where, weights=np.concatenate(counts))
        rest = np.bincount(where, weights=np.concatenate([c * (not r["held"]) for r, c in zip(mine, counts)]))
        if kind == 1:
            real = distinct != BEGIN
            stat += [int(whole[real].sum()), int((whole[real] > 0).sum()), int(rest[real].sum()), int((rest[real] > 0).sum())]
        at = 0
        for r, h in zip(mine, hashes):
            of = where[at:at + len(h)]
            at += len(h)
            # answers grow with the corpus: 64 bits, whose high bytes compress away
            out.append((r["chunk"], kind, bucket, shuffle_bytes(whole[of].astype(np.uint64)),
                        shuffle_bytes(rest[of].astype(np.uint64)) if r["held"] else None, None))
    out.append((-1, 0, bucket, None, None, stat.tolist()))
    return pa.table(list(map(list, zip(*out))), schema=ANSWER_SCHEMA)


def counts_of(chunk: pa.Table, answers: pa.Table, column: str) -> tuple[np.ndarray, ...]:
    """For each token of the chunk: its count, its bigram's, its context's; and the row it is in."""
    word, pair, owner = tokens(chunk)
    got: dict[int, np.ndarray] = {}
    for kind in (1, 2):
        mine = sorted((r["bucket"], r[column]) for r in answers.select(["kind", "bucket", column]).to_pylist() if r["kind"] == kind)
        got[kind] = np.concatenate([unshuffle_bytes(x, np.uint64) for _, x in mine]) if mine else np.zeros(0, np.uint64)
    singles = np.unique(np.append(word, BEGIN))
    c1 = got[1][np.searchsorted(singles, word)].astype(float)
    pairs, where = np.unique(pair, return_inverse=True)
    c2 = got[2][where].astype(float)
    context = np.empty_like(c1)
    context[1:] = c1[:-1]
    context[np.flatnonzero(np.diff(owner, prepend=-1))] = float(got[1][np.searchsorted(singles, BEGIN)])
    return c1, c2, context, owner


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bit length of the context's count; 0: it was never seen."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def expectation_maximisation(cells: np.ndarray, floor: float, rounds: int = 100) -> np.ndarray:
    """Weights (64 buckets x bigram, unigram, floor) from rows (bucket, bigram bits, unigram bits, n).

    Bits are quarter-bits of -log2 of the estimate, -1 for an estimate of 0.  A
    bucket without held-out tokens has the weights of the next lower one.
    """
    out = np.zeros((64, 3))
    last = np.array([0.0, 0.5, 0.5])
    for b in range(64):
        mine = cells[cells[:, 0] == b]
        if len(mine):
            p = np.stack([np.where(mine[:, k] >= 0, 2.0 ** (-mine[:, k] / 4), 0.0) for k in (1, 2)]
                         + [np.full(len(mine), floor)], 1)
            n = mine[:, 3].astype(float)
            last = np.array([0.6, 0.3, 0.1]) if b else np.array([0.0, 0.7, 0.3])
            for _ in range(rounds):
                part = p * last
                share = (part / part.sum(1, keepdims=True) * n[:, None]).sum(0)
                # the floor keeps a trace, so that no text has probability 0
                new = np.maximum(share / n.sum(), [0, 0, 1e-6])
                new /= new.sum()
                done = np.abs(new - last).max() < 1e-7
                last = new
                if done:
                    break
        out[b] = last if b or len(mine) else [0.0, 0.5, 0.5]
    return out


def score(spark: SparkSession, docs: DataFrame, train: Column, held: Column, key: str = "doc_id", text: str = "text",
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Score every document of ``docs``: key, train, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` marks the rows to learn from, ``held`` those of them whose counts
    are held out to learn the weights.
    """
    ws = Workspace(spark, "lm")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"),
                       F.coalesce(train & held, F.lit(False)).alias("held"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1 + size // chunk_bytes, spark.sparkContext.defaultParallelism)
    apart = 1 + chunks // 9
    buckets = 1 << (chunks - 1).bit_length()
    place = F.xxhash64("key", "text")
    rows = rows.select("key", "text", "train", F.when(F.col("held"), F.pmod(place, F.lit(apart)) + chunks).otherwise(
        F.pmod(place, F.lit(chunks))).alias("chunk"))
    asked = rows.groupBy("chunk").applyInArrow(lambda k, t: ask(k, t, buckets, chunks), ASK)
    answers = ws.keep(asked.groupBy("bucket").applyInArrow(answer, ANSWER), "answers")
    stats = answers.where("chunk = -1").select("stat").collect()  # four numbers a bucket
    n_all, v_all, n_rest, v_rest = np.sum([[0] * 4, *(r["stat"] for r in stats)], axis=0).tolist()

    def estimate(chunk: pa.Table, got: pa.Table) -> pa.Table:
        cells = np.zeros((0, 3), np.int64)
        n = np.zeros(0, np.int64)
        if chunk.num_rows:
            c1, c2, context, _ = counts_of(chunk, got, "rest")
            with np.errstate(divide="ignore"):
                quarter = [np.where(c > 0, np.round(-4 * np.log2(np.maximum(c, 1e-9) / np.maximum(of, 1))), -1).astype(np.int64)
                           for c, of in ((c2, context), (c1, n_rest))]
            cells, n = np.unique(np.stack([bucket_of(context), *quarter], 1), axis=0, return_counts=True)
        return pa.table([pa.array(x, pa.int64()) for x in (*cells.T, n)], names=["b", "q2", "q1", "n"])

    held_rows = rows.where(F.col("chunk") >= chunks).groupBy("chunk")
    cells = held_rows.cogroup(answers.where(F.col("chunk") >= chunks).select("chunk", "kind", "bucket", "rest").groupBy("chunk")).applyInArrow(
        estimate, "b long, q2 long, q1 long, n long").groupBy("b", "q2", "q1").agg(F.sum("n").alias("n"))
    weights = expectation_maximisation(cells.toPandas().to_numpy(np.int64).reshape(-1, 4), 1 / (v_rest + 1))

    def evaluate(chunk: pa.Table, got: pa.Table) -> pa.Table:
        out = [chunk.column("key"), chunk.column("train")]
        n = chunk.num_rows
        c1, c2, context, owner = counts_of(chunk, got, "whole") if n else (np.zeros(0),) * 3 + (np.zeros(0, np.int64),)
        w = weights[bucket_of(context)]
        p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(n_all, 1) + w[:, 2] / (v_all + 1)
        base = np.log10((c1 + 0.1) / (n_all + 0.1 * (v_all + 1)))
        total = [np.bincount(owner, weights=x, minlength=n) for x in (np.ones_like(c1), c1 > 0, base, np.log10(p))]
        out += [pa.array(x.astype(np.int64)) for x in total[:2]] + [pa.array([n_all] * n, pa.int64())]
        out += [pa.array(x) for x in total[2:]]
        return pa.table(out, names=["key", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema[key].dataType.simpleString()
    done = rows.groupBy("chunk").cogroup(
        answers.where("chunk >= 0").select("chunk", "kind", "bucket", "whole").groupBy("chunk")).applyInArrow(
        evaluate, f"key {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnRenamed("key", key)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from those outside fold 0 of 10, weights from fold 9."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    of = fold(F.col("doc_id"), 10)
    done = score(spark, docs, of != 0, of == 9)
    return done.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
