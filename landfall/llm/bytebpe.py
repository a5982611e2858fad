"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are encoded in Arrow batches inside Spark tasks.  A text longer than
``piece_chars`` is first cut at safe boundaries: places where the pattern must
end one match and start another whatever surrounds them, so that encoding the
pieces one after the other gives the ids of the whole.  Decoding concatenates
the ids' raw bytes, which never fails on a token that holds half a character.

The boundary used: before a space that stands between a character that isn't
white space and a letter.  No match of the pattern crosses it: a run of letters,
digits or other marks ends before white space, and a run of white space takes
the space only if it began before it.

A run of more than ``LONG_RUN`` white-space characters is too much for the pattern's
look-ahead, which backtracks over it (the library panics on about a million).  What
it matches there is known: all of the run at the end of the text, else all but its
last character.  That match goes to the library as one piece, past the pattern; the
last character belongs to what follows, and no match crosses the beginning of a run.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each; other columns pass through; one with the name of
an added column is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landfall.llm.common import slices, table, without

#: Characters up to which a text is encoded in one call.
PIECE_CHARS = 200_000
#: White-space characters in a row that the pattern's look-ahead is still given.
LONG_RUN = 100_000
#: A space between a non-space and a letter always starts a match (`` ?\\p{L}+``).
BOUNDARY = regex.compile(r"(?<=\S)(?= \p{L})")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; built once in a Python worker."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cuts(text: str, piece_chars: int) -> Iterator[str]:
    """The text in pieces of at least ``piece_chars``, cut at safe boundaries (in one piece if it has none)."""
    at = 0
    while len(text) - at > piece_chars:
        m = BOUNDARY.search(text, at + piece_chars)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def around_runs(text: str, long_run: int) -> Iterator[tuple[str, bool]]:
    """The text in parts, and whether each is one match of the pattern: all of a long run of white space but the
    character that what follows may begin with."""
    at = 0
    for m in regex.finditer(r"\s{%d,}+" % (long_run + 1), text) if len(text) > long_run else ():
        stop = m.end() if m.end() == len(text) else m.end() - 1
        yield text[at:m.start()], False
        yield text[m.start():stop], True
        at = stop
    yield text[at:], False


def encode_text(enc: tiktoken.Encoding, text: str | None, piece_chars: int = PIECE_CHARS, long_run: int = LONG_RUN) -> np.ndarray:
    parts = [np.zeros(0, np.uint32)]
    for part, one_match in around_runs(text or "", long_run):
        if one_match:
            parts.append(np.asarray(enc._encode_single_piece(part), np.uint32))
        elif part:
            parts += [np.asarray(enc.encode_ordinary(x), np.uint32) for x in cuts(part, piece_chars)]
    return np.concatenate(parts)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids",
           piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as an array of int."""
    docs = without(docs, [ids])
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            done = [encode_text(enc, x.as_py(), piece_chars) for x in batch.column(text)]
            ends = np.cumsum([0, *map(len, done)], dtype=np.int32)
            flat = np.concatenate(done).astype(np.int32) if done else np.zeros(0, np.int32)
            out = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), type=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", raw: str = "raw") -> DataFrame:
    """Add ``raw``: the bytes of ``ids`` (null ids: none)."""
    encoded = without(encoded, [raw])
    schema = T.StructType([*encoded.schema.fields, T.StructField(raw, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            out = [enc.decode_bytes(x.values.to_pylist()) if x.is_valid else b"" for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, raw])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids", raw: str = "raw",
               piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows: adds ``ids`` and ``raw``."""
    docs = without(docs, [ids, raw])
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
                           T.StructField(raw, T.BinaryType(), False)])
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in (part for whole in batches for part in slices(whole, text)):
            done = [encode_text(enc, x.as_py(), piece_chars) for x in batch.column(text)]
            back = pa.array([enc.decode_bytes(x.tolist()) for x in done], pa.binary())
            ends = np.cumsum([0, *map(len, done)], dtype=np.int32)
            flat = np.concatenate(done).astype(np.int32) if done else np.zeros(0, np.int32)
            out = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), type=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, out, back], names=schema.names)

    return docs.mapInArrow(run, schema)


def digest(decoded: DataFrame, key: str = "doc_id", ids: str = "token_ids", raw: str = "raw") -> DataFrame:
    """Per document: n_tokens, and sha256 of the ids (little-endian unsigned 32-bit) and of the decoded bytes."""
    schema = T.StructType([decoded.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.asarray(x.values, "<u4") for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array([len(x) for x in lists], pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in lists], pa.string()),
                pa.array([hashlib.sha256(x.as_py() or b"").hexdigest() for x in batch.column(raw)], pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return decoded.select(key, ids, raw).mapInArrow(run, schema)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, decoded again, and the digests of both."""
    import public_tokenizers as vocab

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = vocab.path("byte_bpe_50k.tiktoken")
    return digest(round_trip(docs, ranks, vocab.PATTERN))
