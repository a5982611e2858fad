"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents are sequences of normalised words.  The automaton accepts
every run of words of every item; streaming a document's words through it tracks
the longest run that ends at each word, so a window of ``window`` item words ends
wherever that length reaches ``window``.  An item of fewer words is one window.

* Items are read in blocks of about ``block_bytes`` of text (items have no size
  bound of their own); each block's automaton is broadcast and the documents are
  streamed through it.  Hits of earlier blocks travel in the row, so any number of
  blocks needs no shuffle and no join.
* ``decontaminate`` cuts every hit span out of the text, and drops a document when
  more than ``max_coverage`` of its words are hit.

Defined results: a null or empty text has no words and no hits; an item with a
null or wordless text is ignored; one with a null id marks words but isn't
listed; repeated ids are listed once; no items means no hits; other columns of
documents pass through; one with the name of an added column is replaced.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import Workspace, slices, table, text_buffers, without

#: Bytes of item text in one automaton.
BLOCK_BYTES = 512 << 10
#: A-Z to a-z; every other byte below 0x80 but digits and a-z parts words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.IntegerType()),
])


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, item in items:
            if item:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item]
                coded.append((name, ids))
                last = 0
                for t in ids:
                    last = self._extend(last, t)
        #: State of the whole window within a longer match (-1: the match is shorter than a window).
        self.top = [-1] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[v]
            self.top[v] = self.top[up] if self.length[up] >= window else v if self.length[v] >= window else -1
        self.names: dict[int, set[str | None]] = {}
        ends: dict[int, list[tuple[int, str | None]]] = {}
        self.least = window
        for name, ids in coded:
            v = 0
            for n, t in enumerate(ids, 1):
                v = self.next[v][t]
                if n >= window:
                    self.names.setdefault(self.top[v], set()).add(name)
            if len(ids) < window:
                ends.setdefault(v, []).append((len(ids), name))
                self.least = min(self.least, len(ids))
        #: Short items that end where a state's match ends, by length.
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        if ends:
            for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                found = ends.get(v, []) + self.short.get(self.link[v], [])
                if found:
                    self.short[v] = found

    def _extend(self, p: int, t: int) -> int:
        """State of the sequence that ends with ``t`` after state ``p``."""
        if t in self.next[p]:
            q = self.next[p][t]
            return q if self.length[q] == self.length[p] + 1 else self._clone(p, t, q)
        new = self._state(self.length[p] + 1, {})
        while p != -1 and t not in self.next[p]:
            self.next[p][t] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][t]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, t, q)
        return new

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, t: int, q: int) -> int:
        """Split off the shorter sequences of state ``q``."""
        c = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[c] = self.link[q]
        self.link[q] = c
        while p != -1 and self.next[p].get(t) == q:
            self.next[p][t] = c
            p = self.link[p]
        return c

    def scan(self, doc: list[bytes]) -> tuple[list[list[int]], set[str], int]:
        """Maximal hit spans [start, end) in words, the items hit, and the longest match."""
        spans: list[list[int]] = []
        found: set[str | None] = set()
        longest = 0
        known = bytes(map(self.vocabulary.__contains__, doc))
        run = b"\x01" * self.least
        at = known.find(run)  # a window needs as many known words in a row
        while at >= 0:
            end = known.find(b"\x00", at)
            end = len(doc) if end < 0 else end
            v = n = 0
            for i in range(at, end):
                t = self.vocabulary[doc[i]]
                while v and t not in self.next[v]:
                    v = self.link[v]
                    n = self.length[v]
                if t in self.next[v]:
                    v = self.next[v][t]
                    n += 1
                longest = max(longest, n)
                reach = 0
                if n >= self.window:
                    reach = self.window
                    found |= self.names[self.top[v]]
                for m, name in self.short.get(v, ()):
                    if m <= n:
                        reach = max(reach, m)
                        found.add(name)
                if reach:
                    start = i + 1 - reach
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append([start, i + 1])
            at = known.find(run, end)
        return spans, {x for x in found if x is not None}, longest


def union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of about ``block_bytes``; one block is on the driver at a time."""
    rows = items.select(F.col(key).cast("string").alias("name"), F.col(text).alias("text")).where("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 + size // block_bytes
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k).collect()
        yield [(r["name"], words(r["text"].encode())) for r in block]


def scan(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text",
         item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add n_words, spans (hit runs of words as [start, end)), items (ids as text) and longest (match) to ``docs``."""
    docs = without(docs, ADDED.names)
    plain, schema = docs.schema, T.StructType([*docs.schema.fields, *ADDED.fields])
    out = docs
    for k, block in enumerate(item_blocks(items, item_key, item_text, block_bytes)):
        shared = spark.sparkContext.broadcast(pickle.dumps(Automaton(block, window)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0) -> Iterator[pa.RecordBatch]:
            automaton: Automaton = pickle.loads(shared.value)
            for batch in (part for whole in batches for part in slices(whole, text)):
                data, offsets = text_buffers(batch.column(text))
                raw = data.tobytes().translate(WORD_BYTES)
                before = None if first else batch.select(ADDED.names).to_pylist()
                n_words, all_spans, all_items, longest = [], [], [], []
                for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                    doc = raw[a:b].split()
                    spans, found, best = automaton.scan(doc)
                    if before:
                        spans, found = union(spans, before[i]["spans"]), found | set(before[i]["items"])
                        best = max(best, before[i]["longest"])
                    n_words.append(len(doc))
                    all_spans.append(spans)
                    all_items.append(sorted(found))
                    longest.append(best)
                added = [pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(pa.list_(pa.int32()))),
                         pa.array(all_items, pa.list_(pa.string())), pa.array(longest, pa.int32())]
                yield pa.RecordBatch.from_arrays([*batch.select(plain.names).columns, *added], names=schema.names)

        out = out.mapInArrow(run, schema)
    return out


def cut_spans(text: str, spans: list[list[int]]) -> str:
    """The text without its words of ``spans`` and what lies between them; the cut is closed with one space."""
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"\S+", raw.translate(WORD_BYTES))]
    parts, at = [], 0
    for s, e in spans:
        parts.append(raw[at:places[s][0]])
        at = places[e - 1][1]
    parts.append(raw[at:])
    return b" ".join(p.strip() for p in parts if p.strip()).decode("utf-8", "replace")


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  text: str = "text", **options) -> DataFrame:
    """Documents with hit spans cut out, without those of which more than ``max_coverage`` of the words are hit.

    Columns are those of ``docs``; rows without hits are unchanged.
    """
    docs = without(docs, ADDED.names)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text)):
            new = [cut_spans(x.as_py(), s.as_py()) if s.is_valid and len(s) else x.as_py()
                   for x, s in zip(batch.column(text), batch.column("spans"))]
            columns = [pa.array(new, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    hits = F.aggregate("spans", F.lit(0), lambda n, s: n + s[1] - s[0])
    found = scan(spark, docs, items, window, text=text, **options)
    # written, so that a task doesn't hold the workers of both steps at once
    clean = Workspace(spark, "decontam").keep(found.where(hits <= F.lit(max_coverage) * F.col("n_words")).select(*names, "spans"), "clean")
    return clean.mapInArrow(run, docs.schema)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, window 10."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(spark, docs, table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s[1] - s[0]).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


_WORDS = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS g
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM win),
spot AS (
  SELECT r, p, m, array_to_string(list_slice(w, p, p + m - 1), ' ') AS g
  FROM d CROSS JOIN sizes, unnest(range(1, len(w) - m + 2)) AS u(p)),
hit AS (SELECT spot.r, spot.p, spot.m, win.item_id FROM spot JOIN win ON spot.g = win.g AND spot.m = win.m),
n AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT DISTINCT r, p, m FROM hit) h, unnest(range(p, p + m)) AS u(q) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) x GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
  sha256(coalesce(ids.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN ids USING (r)"""
