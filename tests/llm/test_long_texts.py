"""Texts beyond the positions of one pass, next to short ones."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import package  # noqa: F401
from pyspark.sql import types as T

from landfall.llm import suffix


def test_argmin_refuses_positions_that_do_not_fit():
    assert suffix.sliding_argmin(np.zeros(1 << 24, np.uint64), 1 << 23)[-1] == 1 << 23
    with pytest.raises(ValueError):
        suffix.sliding_argmin(np.zeros((1 << 24) + 1, np.uint64), 1 << 23)


def test_repeats_beyond_16_mib_before_a_short_row(spark):
    rng = np.random.default_rng(16)
    noise = lambda n: rng.integers(97, 123, n, np.uint8).tobytes().decode()
    passages = [noise(n) for n in (400, 430, 600, 1500)]
    size = (16 << 20) + 30_000
    long = list(noise(size))
    for k, p in enumerate(passages):  # before, on and after the 16th MiB
        at = (16 << 20) - 3000 + k * 2000
        long[at:at + len(p)] = p
    df = spark.createDataFrame([(0, noise(50)), (1, "".join(long)), (2, noise(70))] + [
        (10 + k, noise(40) + p + noise(30)) for k, p in enumerate(passages)], "doc_id long, text string").coalesce(1)
    out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix.dedup(spark, df, length=400).drop("text", "kept").collect()}
    assert out.pop(1) == (size, sum(map(len, passages)), len(passages))
    assert out == {0: (50, 0, 0), 2: (70, 0, 0), **{10 + k: (70 + len(p), len(p), 1) for k, p in enumerate(passages)}}


def encoder():
    import public_tokenizers as P

    from landfall.llm import bytebpe
    return bytebpe, bytebpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_long_runs_of_white_space_are_the_library_s_ids():
    """With a small limit, so that the library itself can say what is right."""
    import random

    bytebpe, enc = encoder()
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice([" ", " ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "a", "the", "1", "!", "'s", "é"]) * rng.choice([1, 1, 2, 7])
                       for _ in range(rng.randint(0, 12)))
        assert bytebpe.encode_text(enc, text, 5, rng.choice([1, 2, 5])).tolist() == enc.encode_ordinary(text), repr(text)


def test_millions_of_blanks(spark):
    bytebpe, enc = encoder()
    import public_tokenizers as P

    n = 2_000_000
    rows = [(i, t) for i, t in enumerate([" " * n, "a" + " " * n + "b", "\n" * n, "x\n" + "\t" * n + "1", " \n" * n + " y", "  " * n + "\u3000z"])]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    back = bytebpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).selectExpr("doc_id", "CAST(raw AS STRING) = text AS same", "size(token_ids) AS n")
    got = sorted(tuple(r) for r in back.collect())
    assert [(i, same) for i, same, _ in got] == [(i, True) for i in range(6)]
    # a run's ids don't depend on its length beyond what the library's longest tokens make of it
    few = bytebpe.encode_text(enc, "a" + " " * 200_000 + "b").tolist()
    assert few == enc.encode_ordinary("a" + " " * 200_000 + "b")


class Caught:
    """In place of a frame: keeps the function that mapInArrow gets."""

    columns, schema = ["text"], T.StructType([T.StructField("text", T.StringType())])

    def select(self, *names):
        return self

    def drop(self, *names):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def peak_mb(run, batch):
    """Most memory that a step's arrays take, in MB, beside its input."""
    for _ in run(iter([batch.slice(0, 1)])):  # tables that are kept
        pass
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run(iter([batch])))
        return rows, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("length", [256, 400])
def test_suffixes_hold_arrays_over_a_small_piece_of_text(length):
    noise = np.random.default_rng(5).integers(97, 123, 3 << 20, np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array(range(1024)), pa.array([noise[k:k + 3072] for k in range(0, 3 << 20, 3072)])], names=["u", "text"])
    docs = Caught()
    suffix.suffixes(docs, length)
    rows, mb = peak_mb(docs.run, batch)
    assert rows > 10_000 and mb < 40


def test_encoder_hands_over_small_batches():
    import public_tokenizers as P

    from landfall.llm import bytebpe
    docs = Caught()
    bytebpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = pa.array(["word and word " * 200] * 1000 + [None, ""])
    out = list(docs.run(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    assert pa.concat_arrays([x.column("text") for x in out]).equals(texts)
    assert max(sum(len(r) for r in x.column("raw").to_pylist()) for x in out) < 1 << 20
