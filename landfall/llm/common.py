"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.fs import delete
from landfall.session import scratch

#: Rows up to which a set of ids or keys is broadcast (8 bytes a row); beyond it Spark shuffles.
BROADCAST_ROWS = 2_000_000
#: Bytes of text that one pass of a vectorised helper holds arrays for.
SLICE_BYTES = 1 << 19
#: Rows in an Arrow batch, where the session has Spark's default: whole texts are wide rows.
BATCH_ROWS, DEFAULT_BATCH_ROWS = "1000", "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Workspace:
    """Written tables that cut lineage, in the folder that ``spark.checkpoint.dir`` names.

    ``keep`` writes a frame as Parquet and returns a reader of it; a lost executor
    costs a re-read and not a recomputation.  ``drop`` deletes a table that nothing
    reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, scratch(spark, label), 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        where = self.path(name)
        schema = df.schema
        df.write.parquet(where, partitionBy=partition_by)
        back = self.spark.read.schema(schema).parquet(where)
        back._kept_at = where
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if getattr(df, "_kept_at", None):
                delete(self.spark, df._kept_at)


def without(df: DataFrame, added: list[str]) -> DataFrame:
    """``df`` without columns that have the name of one that an operator adds (names compare as Spark's do)."""
    lower = {x.lower() for x in added}
    return df.drop(*(c for c in df.columns if c.lower() in lower))


def semi(df: DataFrame, keys: DataFrame, on: str, bound: int = BROADCAST_ROWS, how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a set of keys: broadcast when a count proves it small, else shuffled."""
    keys = keys.select(on)
    return df.join(F.broadcast(keys) if keys.count() <= bound else keys, on, how)


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(0))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array and its n+1 offsets; a null is an empty text."""
    if not pa.types.is_large_string(texts.type) and not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_string() if pa.types.is_string(texts.type) else pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    sizes = np.diff(text_buffers(batch.column(text))[1])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task holds what it uses, not what it used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # the GNU C library's
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bijection of 64-bit integers (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random 64-bit value for each byte, and an odd multiplier with its inverse, for polynomial hashes mod 2^64.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; tables up to a few slices are kept."""
    kept = _POWERS.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.ones(max(n, SLICE_BYTES + 1), np.uint64)
    done, step = 1, np.uint64(base)
    while done < len(out):
        take = min(done, len(out) - done)
        out[done:done + take] = out[:take] * step
        done += take
        step = np.uint64(int(step) ** 2 & (1 << 64) - 1)
    if len(out) <= 4 * SLICE_BYTES:
        _POWERS[base] = out
    return out[:n]


_POWERS: dict[int, np.ndarray] = {}


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [begin, end) of some bytes, ascending by begin.

    Arrays over the bytes are held for about SLICE_BYTES of them at a time, so a
    long text takes no more memory than its words do.
    """
    out = np.zeros(len(begin), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(begin):
            base = begin[at]
            stop = max(at + 1, int(np.searchsorted(begin, base + SLICE_BYTES)))
            a, b = begin[at:stop] - base, end[at:stop] - base
            n = int(b.max())
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE_VALUES[data[base:base + n]] * powers(BASE, n), out=sums[1:])
            out[at:stop] = mix((sums[b] - sums[a]) * powers(INVERSE, n + 1)[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = stop
    return out


#: Tables for word scanning: A-Z to a-z, and which bytes belong to a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word ``[^\\x20\\x09-\\x0D]+`` of the texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = NOT_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    start[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased.

    Returns the hashes in order and the n+1 offsets of the texts' words among them.
    """
    begin, end = word_spans(data, offsets)
    return span_hashes(LOWER[data], begin, end), np.searchsorted(begin, offsets)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """For n+1 offsets, the row that each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def ship(spark: SparkSession) -> None:
    """Give Spark's Python workers this package, as ``--py-files`` does, once for each application."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == DEFAULT_BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="landfall-py-")) / "landfall.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(target))


_SHIPPED: set[str] = set()


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
