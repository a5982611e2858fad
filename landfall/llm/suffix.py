"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Texts are UTF-8 bytes; strings never cross documents.

Sparse suffix arrays.  Each string of ``length`` bytes (a window) has an anchor:
its 32-byte gram with the smallest hash, the leftmost of equals.  Equal windows have
equal anchors at equal offsets, and the windows of one anchor are a run of starts.
An anchor in the first half of its windows enters the array as the suffix that
starts at it, one in the second half as the suffix that starts half a window
before it, so that every window of the entry holds the first half window of the
suffix.  An array's order is that of a 64-bit fingerprint of this half window: all
that scanning needs is that equal beginnings are neighbours, and fingerprints spread
evenly over partitions whatever the texts begin with.

Index family.  ``SuffixIndex.add`` sorts a batch's entries into a suffix array, finds
beginnings that recur within it, merge-scans it against each level (sort-merge
semi-joins on the fingerprint), and puts it in as a level of rank 0; levels of equal rank merge
into one of the next, so n batches leave log2(n) levels and an entry is rewritten
log2(n) times.  In the end earlier documents learn of later repeats: all entries
whose beginning was found to recur are candidates.

Exact windows.  Entries that recur fall into variants (equal bytes over all their
windows).  All windows of a variant seen twice are repeats.  The windows of the
others are compared by fingerprint with those of the beginning's other variants:
in one group while there are at most ``GROUP`` of them, else a row for each window,
summed before the shuffle -- the same comparison, for beginnings of any frequency.
Fingerprints have 64 bits.

Passages.  With ``words``, a byte also goes if a passage of that many words (the
bytes from the first word's begin to the last one's end) that covers it is in two
places that don't overlap (one word sixty times over is not fifty words said twice).
Passages of ``length`` bytes or more are strings as above; only the shorter ones have
a row each, compared by fingerprint.

Passages reported.  With ``report``, no byte more goes, but n_passage_bytes and
n_passages say how many bytes, in how many runs, lie in a passage of that many words
(the bytes from the first word's begin to the last one's end) whose words also begin,
in the same order, at any other word of any text, whatever stands between them:
50 words and more are often shorter than ``length`` bytes.  Here a passage's anchor is
its gram of ``WORD_GRAM`` words with the smallest hash; passages of one anchor are one
entry, and only those of anchors that recur, in variants seen once, have a row each.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes (but for passages); rows that repeat id and text repeat each other's bytes; null ids are
allowed; no rows give no rows; other columns pass through ``dedup``, one with the
name of an added column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import (BASE, BROADCAST_ROWS, BYTE_VALUES, INVERSE, Workspace, mix, powers, semi, slices,
                                 rows_of, span_hashes, table, text_buffers, without, word_spans)

GRAM, PIECE, GROUP, BATCHES = 32, 1 << 18, 4096, 4
WORD_GRAM, PASSAGE_WORDS = 12, 51
ENTRY = "u long, key long, p long, s0 long, s1 long, vh long"


class Hashes:
    """Fingerprints of any substring of some units, given a 64-bit value for each (bytes: BYTE_VALUES)."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])
        self.back = powers(INVERSE, len(values) + 1)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64))

    def grams(self, width: int) -> np.ndarray:
        """``of`` of all runs of ``width`` units, without arrays of their places."""
        n = max(0, len(self.sums) - width)
        with np.errstate(over="ignore"):
            h = self.sums[width:] - self.sums[:n]
            h *= self.back[:n]
            h += np.uint64(width)
        return mix(h)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` neighbours, the leftmost of equals (by 40 bits, up to 2^24 values)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(values) > 1 << 24:
        raise ValueError(f"{len(values)} values: positions have 24 bits")
    low = np.uint64((1 << 24) - 1)
    x = np.full(-(-len(values) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    x[:len(values)] = values
    x[:len(values)] &= ~low
    x[:len(values)] |= np.arange(len(values), dtype=np.uint64)
    x = x.reshape(-1, width)
    least = np.minimum.accumulate(x, 1).ravel()[width - 1:width - 1 + n]
    np.minimum.accumulate(x[:, ::-1], 1, out=x[:, ::-1])
    np.minimum(x.ravel()[:n], least, out=least)
    least &= low
    return least.view(np.int64)


def entries_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Suffix array entries of some texts: row, key, p (suffix start), s0 and s1 (first and last window start), vh.

    Positions are relative to ``data``.
    """
    half = length // 2
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    h = Hashes(BYTE_VALUES[data])
    anchor = sliding_argmin(h.grams(GRAM), length - GRAM + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(anchor)]
    start = np.flatnonzero(np.arange(length, length + len(anchor)) <= ends)
    if not len(start):
        return none
    # windows of different rows have different anchors
    a = anchor[start]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    s0, s1, a = start[first], start[np.append(first[1:], len(start)) - 1], a[first]
    r = np.searchsorted(offsets, s0, "right") - 1
    parts = []
    for lo, hi, p, end, salt in ((np.maximum(s0, a - half + 1), s1, a, a + length - half, 0),
                                 (s0, np.minimum(s1, a - half), a - half, a + GRAM, 1)):
        ok = lo <= hi
        lo, hi, p, end = lo[ok], hi[ok], p[ok], end[ok]
        with np.errstate(over="ignore"):
            key = mix(h.of(p, end) + np.uint64(salt))
            shape = (p - lo).astype(np.uint64) * np.uint64(1 << 32) + (hi - lo).astype(np.uint64)
            vh = mix(h.of(lo, hi + length) + mix(shape + np.uint64(salt)))
        parts.append((r[ok], key.view(np.int64), p, lo, hi, vh.view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """Entries of the documents (u, text), with u carried along, taken in overlapping pieces whatever the rows' lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE)):
            data, offsets = text_buffers(batch.column("text"))
            u = batch.column("u").to_numpy(zero_copy_only=False)
            for at in range(0, len(data), PIECE):
                part = data[at:at + PIECE + length - 1]
                r, key, p, s0, s1, vh = entries_of(part, np.clip(offsets - at, 0, len(part)), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u[r]), pa.array(key), *(pa.array(x - offsets[r] + at) for x in (p, s0, s1)), pa.array(vh)],
                    names=["u", "key", "p", "s0", "s1", "vh"])

    return docs.select("u", "text").mapInArrow(run, ENTRY)


class SuffixIndex:
    """Levels of suffix arrays, and the beginnings found to recur.

    An array has a row for each variant (key, vh) with the number of its
    occurrences and one of their places, so text that repeats itself a million
    times is one row, summed before the shuffle.
    """

    def __init__(self, spark: SparkSession, ws: Workspace):
        self.spark, self.ws = spark, ws
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def add(self, entries: DataFrame) -> None:
        """Scan a batch's entries against all there are, and put them in."""
        array = self._sorted(entries.groupBy("key", "vh").agg(
            F.count("*").alias("c"), F.min(F.struct("u", "p", "s0", "s1")).alias("at")), "batch")
        again = array.groupBy("key").agg(F.sum("c").alias("c")).where("c > 1").select("key")
        for _, level in self.levels:
            again = again.union(level.select("key").join(array.select("key"), "key", "left_semi"))
        self.found.append(self.ws.keep(again.distinct(), "found"))
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, last = self.levels.pop()
            merged = self._sorted(self._merged([last, array]), f"level{rank + 1}")
            self.ws.drop(last, array)
            array, rank = merged, rank + 1
        self.levels.append((rank, array))

    def _merged(self, arrays: list[DataFrame]) -> DataFrame:
        out = arrays[0]
        for more in arrays[1:]:
            out = out.unionByName(more)
        return out.groupBy("key", "vh").agg(F.sum("c").alias("c"), F.min("at").alias("at"))

    def _sorted(self, array: DataFrame, name: str) -> DataFrame:
        # the aggregate has dealt the rows by (key, vh); each file is a sorted run
        return self.ws.keep(array.sortWithinPartitions("key", "vh"), name)

    def recurring(self) -> tuple[DataFrame, DataFrame]:
        """The beginnings that occur more than once so far (key), and their variants (key, vh, c, at)."""
        keys = self.found[0]
        for more in self.found[1:]:
            keys = keys.union(more)
        keys = self.ws.keep(keys.distinct(), "recurring")
        arrays = [x for _, x in self.levels]
        variants = arrays[0] if len(arrays) == 1 else self._merged(arrays)
        return keys, self.ws.keep(variants.join(keys, "key", "left_semi"), "variants")

    def drop(self) -> None:
        self.ws.drop(*(x for _, x in self.levels), *self.found)


WINDOWS = "key long, vh long, c long, p0 long, data binary"


def _window_hashes(rows: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of some variants: its row, its place against the suffix start, its fingerprint."""
    data, offsets = text_buffers(rows.column("data").combine_chunks() if isinstance(rows, pa.Table) else rows.column("data"))
    n = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + place
    h = Hashes(BYTE_VALUES[data])
    rel = place - rows.column("p0").to_numpy(zero_copy_only=False)[row]
    with np.errstate(over="ignore"):
        return row, rel, mix(h.of(start, start + length) + rel.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def _runs(key: np.ndarray, vh: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring places (sorted within a variant): key, vh, first and last place."""
    if not len(rel):
        return key, vh, rel, rel
    cut = np.flatnonzero((np.diff(rel, prepend=rel[0] - 2) != 1) | (np.diff(vh, prepend=vh[0]) != 0) | (np.diff(key, prepend=key[0]) != 0))
    return key[cut], vh[cut], rel[cut], rel[np.append(cut[1:], len(rel)) - 1]


def _repeated(rows: pa.Table, length: int) -> pa.Table:
    """Runs of windows of a group's once-seen variants that another variant of the group has too."""
    row, rel, wh = _window_hashes(rows, length)
    _, where, count = np.unique(wh, return_inverse=True, return_counts=True)
    once = (rows.column("c").to_numpy() == 1)[row] & (count[where] > 1)
    key, vh = rows.column("key").to_numpy()[row[once]], rows.column("vh").to_numpy()[row[once]]
    return pa.table([pa.array(x) for x in _runs(key, vh, rel[once])], names=["key", "vh", "r0", "r1"])


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int, batches: int, ws: Workspace) -> DataFrame:
    """(u, spans): for documents (u, text) with repeats, the runs of window starts [first, last] that recur."""
    entries = ws.keep(suffixes(docs, length).withColumn("batch", F.pmod("u", F.lit(batches))), "entries", ["batch"])
    index = SuffixIndex(spark, ws)
    for k in range(batches):
        index.add(entries.where(F.col("batch") == k).drop("batch"))
    keys, variants = index.recurring()
    hits = ws.keep(entries.drop("batch").join(keys, "key", "left_semi"), "hits")
    index.drop()
    ws.drop(entries, keys)
    mixed = variants.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("least")).where("n > 1 AND least = 1")
    wanted = ws.keep(variants.join(mixed.select("key", "n"), "key").select("key", "vh", "c", "n", "at.*"), "wanted")
    lists = wanted.groupBy("u").agg(F.collect_list(F.struct("key", "vh", "c", "n", "p", "s0", "s1")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for text, want in zip(batch.column("text"), batch.column("wanted")):
                raw = text.as_buffer()
                want = want.values.flatten()
                key, vh, c, n, p, s0, s1 = (x.to_numpy() for x in want)
                cut = [raw[a:b + length].to_pybytes() for a, b in zip(s0.tolist(), s1.tolist())]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (key, vh, c, p - s0)), pa.array(cut, pa.binary()), pa.array(n)],
                                                 names=["key", "vh", "c", "p0", "data", "n"])

    fetched = ws.keep(_with(docs, lists, "u").select("text", "wanted").mapInArrow(fetch, WINDOWS + ", n long"), "variant-bytes")
    small = fetched.where(F.col("n") <= GROUP).drop("n").groupBy("key").applyInArrow(
        lambda t: _repeated(t, length), "key long, vh long, r0 long, r1 long")
    runs = small
    hot = fetched.where(F.col("n") > GROUP).drop("n")
    if not hot.isEmpty():
        runs = runs.unionByName(_repeated_rows(hot, length, ws))
    whole = variants.where("c > 1").select("key", "vh", F.lit(None).cast("long").alias("r0"), F.lit(None).cast("long").alias("r1"))
    spans = hits.join(runs.unionByName(whole), ["key", "vh"]).groupBy("u").agg(F.collect_list(F.array(
        F.coalesce(F.col("p") + F.col("r0"), "s0"), F.coalesce(F.col("p") + F.col("r1"), "s1"))).alias("spans"))
    return ws.keep(spans, "spans")


def _repeated_rows(rows: DataFrame, length: int, ws: Workspace) -> DataFrame:
    """``_repeated`` for beginnings with many variants: a row for each window, counted by Spark."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "data", PIECE)):
            row, rel, wh = _window_hashes(batch, length)
            of = lambda c: batch.column(c).to_numpy()[row]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (of("key"), of("vh"), of("c"), rel, wh.view(np.int64))],
                                             names=["key", "vh", "c", "rel", "wh"])

    windows = ws.keep(rows.mapInArrow(explode, "key long, vh long, c long, rel long, wh long"), "windows")
    twice = windows.groupBy("key", "wh").agg(F.count("*").alias("n")).where("n > 1").select("key", "wh")
    found = windows.where("c = 1").join(twice, ["key", "wh"], "left_semi")
    return found.select("key", "vh", F.col("rel").alias("r0"), F.col("rel").alias("r1"))


def repeated_passages(docs: DataFrame, length: int, words: int, ws: Workspace) -> DataFrame:
    """(u, spans) as ``repeated_spans`` gives them, for passages of ``words`` words in fewer than ``length`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE)):
            data, offsets = text_buffers(batch.column("text"))
            u, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "row"))
            begin, end = word_spans(data, offsets)
            a, b = begin[:max(0, len(begin) - words + 1)], end[words - 1:]
            r = np.searchsorted(offsets, a, "right") - 1
            short = (b <= offsets[r + 1]) & (b - a < length)
            a, b, r = a[short], b[short], r[short]
            for at in range(0, len(a), PIECE):
                x, y, z = a[at:at + PIECE], b[at:at + PIECE], r[at:at + PIECE]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in (u[z], row[z], span_hashes(data, x, y).view(np.int64), x - offsets[z], y - offsets[z]))],
                    names=["u", "row", "h", "a", "b"])

    rows = docs.select("u", "text", F.monotonically_increasing_id().alias("row"))
    passages = ws.keep(rows.mapInArrow(run, "u long, row long, h long, a long, b long"), "passages")
    apart = "min(row) < max(row) OR max(a) >= min(b)"
    again = ws.keep(passages.groupBy("h").agg(F.expr(apart).alias("apart")).where("apart").select("h"), "passages-again")
    # those that touch are one span
    of = Window.partitionBy("u").orderBy("a")
    begins = (F.col("a") > F.lag("b").over(of)).cast("long")
    runs = semi(passages, again, "h").withColumn("begins", F.coalesce(begins, F.lit(0))).withColumn("run", F.sum("begins").over(of))
    runs = runs.groupBy("u", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs.groupBy("u").agg(F.collect_list(F.array("a", F.col("b") - length)).alias("spans"))


def passage_entries(values: np.ndarray, row: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """For words (value and row of each), runs of passages with one anchor: first and last passage's first word, key, vh."""
    gram = min(WORD_GRAM, words)
    start = np.flatnonzero(row[:max(0, len(row) - words + 1)] == row[words - 1:])
    if not len(start):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    h = Hashes(values)
    a = sliding_argmin(h.grams(gram), words - gram + 1)[start]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    s0, s1, a = start[first], start[np.append(first[1:], len(start)) - 1], a[first]
    with np.errstate(over="ignore"):
        shape = (a - s0).astype(np.uint64) * np.uint64(1 << 32) + (s1 - s0).astype(np.uint64)
        vh = mix(h.of(s0, s1 + words) + mix(shape))
    return s0, s1, h.of(a, a + gram).view(np.int64), vh.view(np.int64)


def passages_again(docs: DataFrame, words: int, ws: Workspace) -> DataFrame:
    """(u, a, b): spans of bytes that cover all passages of ``words`` words of the documents (u, text) that begin elsewhere too.

    In a document, spans that begin later end later.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE)):
            data, offsets = text_buffers(batch.column("text"))
            u = batch.column("u").to_numpy(zero_copy_only=False)
            begin, end = word_spans(data, offsets)
            values, row = span_hashes(data, begin, end), np.searchsorted(offsets, begin, "right") - 1
            for at in range(0, len(begin) - words + 1, PIECE):
                part = slice(at, at + PIECE + words - 1)
                s0, s1, key, vh = passage_entries(values[part], row[part], words)
                r = row[part][s0]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    u[r], key, vh, begin[part][s0] - offsets[r], end[part][s1 + words - 1] - offsets[r])], names=["u", "key", "vh", "a", "b"])

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE)):
            data, offsets = text_buffers(batch.column("text"))
            lists = batch.column("wanted")
            of = rows_of(np.append(0, np.cumsum(lists.value_lengths().to_numpy())))
            c, lo, hi = (x.to_numpy() for x in lists.flatten().flatten())
            u = batch.column("u").to_numpy(zero_copy_only=False)
            for at in range(0, len(of), GROUP):
                r, one, a, n = of[at:at + GROUP], c[at:at + GROUP] == 1, lo[at:at + GROUP], (hi - lo)[at:at + GROUP]
                edges = np.append(0, np.cumsum(n))
                part = data[np.repeat(offsets[r] + a - edges[:-1], n) + np.arange(edges[-1])]
                begin, end = word_spans(part, edges)
                k = np.searchsorted(edges, begin, "right") - 1
                start = np.flatnonzero(k[:max(0, len(k) - words + 1)] == k[words - 1:])
                ph, k = Hashes(span_hashes(part, begin, end)).of(start, start + words), k[start]
                shift = (a - edges[:-1])[k]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    u[r][k], one[k], ph.view(np.int64), begin[start] + shift, end[start + words - 1] + shift)], names=["u", "one", "ph", "a", "b"])

    found = ws.keep(docs.select("u", "text").mapInArrow(entries, "u long, key long, vh long, a long, b long"), "passage-entries")
    again = ws.keep(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "passage-keys")
    hits = ws.keep(semi(found, again, "key"), "passage-hits")
    ws.drop(found)
    variants = ws.keep(hits.groupBy("key", "vh").agg(F.count("*").alias("c"), F.min(F.struct("u", "a", "b")).alias("at")), "passage-variants")
    mixed = variants.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("least")).where("n > 1 AND least = 1").select("key")
    lists = ws.keep(variants.join(mixed, "key", "left_semi").select("c", "at.*").groupBy("u").agg(
        F.collect_list(F.struct("c", "a", "b")).alias("wanted")), "passage-lists")
    singles = ws.keep(_with(docs, lists, "u").select("u", "text", "wanted").mapInArrow(
        passages, "u long, one boolean, ph long, a long, b long"), "passage-rows")
    twice = singles.groupBy("ph").agg(F.count("*").alias("n")).where("n > 1")
    whole = hits.join(variants.where("c > 1").select("key", "vh"), ["key", "vh"], "left_semi")
    return whole.select("u", "a", "b").unionByName(semi(singles.where("one"), twice, "ph").select("u", "a", "b")).distinct()


def passage_counts(docs: DataFrame, words: int, ws: Workspace) -> DataFrame:
    """(u, n_passage_bytes, n_passages) of the documents (u, text) with passages of ``words`` words that begin elsewhere too."""
    before = F.lag("b").over(Window.partitionBy("u").orderBy("a"))
    spans = passages_again(docs, words, ws).select("u", (F.col("b") - F.greatest("a", before)).alias("fresh"),
                                                   F.coalesce(F.col("a") > before, F.lit(True)).cast("long").alias("begins"))
    return ws.keep(spans.groupBy("u").agg(F.sum("fresh").alias("n_passage_bytes"), F.sum("begins").alias("n_passages")), "passage-counts")


def _with(docs: DataFrame, lists: DataFrame, on: str, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Documents that have a list, with it: texts without one are left out before the shuffle if the ids are few enough."""
    ids = lists.select(on)
    few = docs.join(F.broadcast(ids), on, "left_semi") if ids.count() <= bound else docs
    return few.join(lists, on)


def _cut(raw: bytes, spans: list[list[int]], length: int) -> tuple[bytes, int, int]:
    """The bytes that stay, how many go, and in how many runs."""
    parts, at, gone, runs, end = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > end or not runs:
            parts.append(raw[at:a])
            runs += 1
            end = a
        end = max(end, b + length)
        at = end
    parts.append(raw[at:])
    kept = b"".join(parts)
    return kept, len(raw) - len(kept), runs


def dedup(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400,
          batches: int = BATCHES, words: int = 0, report: int = 0) -> DataFrame:
    """``docs`` without the repeats of ``length`` bytes (and of ``words`` words, unless 0): kept (the text that stays; half characters at its seams go), n_bytes, n_removed, n_spans and
    kept_sha256 (of all bytes that stay) added; with ``report``, also n_passage_bytes and n_passages, of passages of that many words."""
    ws = Workspace(spark, "suffix")
    added = [("kept", T.StringType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()),
             ("kept_sha256", T.StringType())]
    counted = ["n_passage_bytes", "n_passages"] if report else []
    docs = without(docs, [*(n for n, _ in added), *counted, "_u", "_spans"])
    names = docs.columns
    carried = ["_u"] if report else []
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in carried), *(T.StructField(n, t) for n, t in added)])
    marked = docs.withColumn("_u", F.xxhash64(key, text))
    texts = marked.select(F.col("_u").alias("u"), F.col(text).alias("text"))
    spans = repeated_spans(spark, texts.where(F.octet_length("text") >= length), length, batches, ws)
    if words:
        more = repeated_passages(texts.where(F.octet_length("text") >= 2 * words - 1), length, words, ws)
        spans = ws.keep(spans.unionByName(more).groupBy("u").agg(F.flatten(F.collect_list("spans")).alias("spans")), "all-spans")
    spans = spans.select(F.col("u").alias("_u"), F.col("spans").alias("_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text)):
            raw = [(x.as_py() or "").encode() for x in batch.column(text)]
            done = [_cut(x, s.as_py() or [], length) for x, s in zip(raw, batch.column("_spans"))]
            out = [pa.array([k.decode("utf-8", "ignore") for k, _, _ in done], pa.string()), pa.array([len(x) for x in raw], pa.int64()),
                   pa.array([n for _, n, _ in done], pa.int64()), pa.array([n for _, _, n in done], pa.int64()),
                   pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in done], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.select([*names, *carried]).columns, *out], names=schema.names)

    empty = F.lit(None).cast("array<array<bigint>>").alias("_spans")
    ids = spans.select("_u")
    if ids.count() <= BROADCAST_ROWS:
        hit = marked.join(F.broadcast(ids), "_u", "left_semi").join(spans, "_u")
        rest = marked.join(F.broadcast(ids), "_u", "left_anti").withColumn("_spans", empty)
        ready = hit.unionByName(rest)
    else:
        ready = marked.join(spans, "_u", "left")
    done = ready.select(*names, *carried, "_spans").mapInArrow(run, schema)
    if not report:
        return done
    counts = passage_counts(texts.where(F.octet_length("text") >= 2 * report - 1), report, ws).withColumnRenamed("u", "_u")
    return done.join(counts, "_u", "left").drop("_u").fillna(0, counted)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeats of 400 bytes; bytes and runs of repeated passages of over 50 words beside them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(spark, docs, length=400, report=PASSAGE_WORDS).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "n_passages")
