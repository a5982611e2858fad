"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Documents are sets of ``k``-word shingles; two link when their Jaccard similarity
reaches a threshold (a fraction of integers, so the test is exact).

Filter.  Order every set by ascending (estimated) document frequency.  A set of n
shingles that links with any other shares at least o = ceil(t n) of them, so two
linked sets share at least m shingles of their prefixes of n - o + m.  Each
document picks its own m: a longer prefix costs more postings, but demands more
shared ones; the choice minimises postings + candidates, where the candidates are
estimated by the frequencies of the prefix's shingles over m.  A pair is verified
if its shared prefix shingles reach the smaller m of the two and leave room for
the overlap that its sizes need.  Frequencies come from a count sketch of fixed size
over all documents; it only decides the order and m, so its errors cost time and
never a link.

Steps.
1. One pass gives each document's set size and signature, and the sketch.  Equal
   sets are one class, represented by the smallest id.
2. Class representatives emit their prefix postings (shingle, class).
3. A star round, and more while pairing out what is left would take more than ``WORK``
   rows for each posting and the last round helped: each posting meets one hub of its shingle's list (a row for each
   posting, however long the list), the class whose shingles are the most common,
   as the middle of a group of near copies is; after the first round one outside the
   list's largest component.  Verified links give provisional components.
4. The last round pairs postings of one shingle whose classes are in different
   components, taking those outside the shingle's largest component against all.
   Every link between components is among these, so the components become exact,
   while the inside of a large group of near copies is never paired out.

In all rounds a pair is sought only at shingles after which both prefixes still have
room for what they must share (see ``split``): that leaves out the frequent ones.

Verification fetches the sets of the classes that occur in pairs, again by hash
from the texts.  Shingles and signatures are 64-bit hashes.

Defined results: a null or wordless text is an empty set, links with nothing and is
its own component; a text of fewer than k words is one shingle, its whole sequence;
a null id gets a null component and links with nothing; rows that share an id are
one vertex; repeated rows stay; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, mix, rows_of, semi, slices, table, text_buffers, word_hashes
from landfall.llm.components import connected_components
from landfall.llm.lm import shuffle_bytes, unshuffle_bytes

#: Counters of the sketch (4 bytes each), in slices; the largest m; a candidate's cost in postings.
SKETCH, SLICE, MOST_MATCHES, CANDIDATE_COST = 1 << 22, 1 << 16, 8, 4.0
#: Star rounds at most, and pairs for each posting that need no more than the first.
ROUNDS, WORK = 4, 8.0
STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their n+1 offsets."""
    words, at = word_hashes(data, offsets)
    n = np.diff(at)
    with np.errstate(over="ignore"):
        run, parts, owners = words.copy(), [], []
        row = rows_of(at)
        left = at[1:][row] - np.arange(len(words))  # words from here to the end of the text
        for length in range(1, k + 1):
            if length > 1:
                run = mix(run[:len(words) - length + 1] * STEP + words[length - 1:]) if len(words) >= length else run[:0]
            if length < k:  # short texts, whole
                short = np.flatnonzero(n == length)
                parts.append(run[at[short]] if len(short) else run[:0])
                owners.append(short)
        whole = np.flatnonzero(left[:len(run)] >= k)
        parts.append(run[whole])
        owners.append(row[whole])
    s, row = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    s, row = s[first], row[first]
    return s, np.searchsorted(row, np.arange(len(n) + 1))


def signatures(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s + STEP), dtype=np.uint64)])
        return mix(total[at[1:]] - total[at[:-1]] + mix(np.diff(at).astype(np.uint64))).view(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, n, v) of documents, then (part, slice, at, counts) of the task's sketch."""
    sketch = np.zeros(SKETCH, np.uint32)
    names = ["id", "n", "v", "part", "slice", "at", "counts"]
    for batch in (piece for whole in batches for piece in slices(whole, "text")):
        s, at = shingle_sets(*text_buffers(batch.column("text")), k)
        np.add.at(sketch, (s >> np.uint64(42)).astype(np.int64), 1)
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(at)), pa.array(signatures(s, at)), pa.nulls(rows, pa.int64()),
             pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())], names=names)
    part = TaskContext.get().partitionId() // 256
    for j in range(SKETCH // SLICE):
        counts = sketch[j * SLICE:(j + 1) * SLICE]
        (at,) = np.nonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, pa.int64()) for _ in range(3)), pa.array([part], pa.int64()), pa.array([j], pa.int64()),
                 pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([shuffle_bytes(counts[at])], pa.binary())], names=names)


def _add_slices(key: tuple, rows: pa.Table) -> pa.Table:
    total = np.zeros(SLICE, np.int64)
    for at, counts in zip(rows.column("at"), rows.column("counts")):
        where = np.frombuffer(at.as_py(), np.uint16)
        total[where] += unshuffle_bytes(counts.as_py(), np.uint32)
    (at,) = np.nonzero(total)
    counts = np.minimum(total[at], 0xFFFFFFFF).astype(np.uint32)
    return pa.table([pa.array([key[0].as_py()]), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                     pa.array([shuffle_bytes(counts)], pa.binary())], names=["slice", "at", "counts"])


def _sketch(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' sketches, in two levels; SKETCH numbers on the driver."""
    kind = "slice long, at binary, counts binary"
    some = parts.groupBy("slice", "part").applyInArrow(_add_slices, kind)
    out = np.zeros(SKETCH, np.uint32)
    for r in some.groupBy("slice").applyInArrow(_add_slices, kind).toLocalIterator():
        out[r["slice"] * SLICE + np.frombuffer(r["at"], np.uint16).astype(np.int64)] = unshuffle_bytes(r["counts"], np.uint32)
    return out


def _prefixes(s: np.ndarray, at: np.ndarray, sketch: np.ndarray, noise: float, num: int, den: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Each set's prefix, its m and how common its shingles are (mean log frequency, in thousandths)."""
    freq = sketch[(s >> np.uint64(42)).astype(np.int64)]
    order = np.lexsort((s, freq, rows_of(at)))
    s, freq = s[order], freq[order]
    for a, b in zip(at.tolist(), at[1:].tolist()):
        n = b - a
        if not n:
            yield s[a:a], 1, 0
            continue
        need = -(-num * n // den)
        most = min(MOST_MATCHES, need)
        extra = np.concatenate([[0.0], np.cumsum(np.maximum(freq[a:a + n - need + most] - noise, 0.0))])
        m = np.arange(1, most + 1)
        cost = (n - need + m) + CANDIDATE_COST * extra[n - need + m] / m
        best = int(m[cost.argmin()])
        yield s[a:a + n - need + best], best, int(1000 * np.log2(freq[a:b] + 1.0).mean())


def _postings(batches: Iterator[pa.RecordBatch], k: int, sketch: np.ndarray, num: int, den: int) -> Iterator[pa.RecordBatch]:
    mean = float(sketch.mean())
    noise = mean + 3 * np.sqrt(mean) + 1  # what a bucket holds without a frequent shingle
    for batch in (piece for whole in batches for piece in slices(whole, "text")):
        s, at = shingle_sets(*text_buffers(batch.column("text")), k)
        v, n = signatures(s, at), np.diff(at)
        found = list(_prefixes(s, at, sketch, noise, num, den))
        size = np.array([len(p) for p, _, _ in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([p for p, _, _ in found]).view(np.int64)), pa.array(np.repeat(v, size)),
             pa.array((np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)),
             *(pa.array(np.repeat(x, size).astype(np.int32)) for x in (n, [m for _, m, _ in found], [q for _, _, q in found]))],
            names=["s", "v", "at", "n", "m", "q"])


def _least(n: Column, num: int, den: int) -> Column:
    """What a set of n shares at least with any that it links with: ceil(t n)."""
    return F.ceil(num * n / F.lit(den) - F.lit(1e-6))


def _need(n: Column, n2: Column, num: int, den: int) -> Column:
    """What sets of n and n2 share at least if they link: ceil(t (n + n2) / (1 + t))."""
    return F.ceil(num * (n + n2) / F.lit(num + den) - F.lit(1e-6))


def _room(c: Column, num: int, den: int) -> Column:
    """Whether a pair (n, m, n2, m2) with c shared prefix shingles may link: beyond the prefix
    that ends first, its set has t n - m shingles left to share."""
    n, m, n2, m2 = map(F.col, ("n", "m", "n2", "m2"))
    beyond = F.greatest(_least(n, num, den) - m, _least(n2, num, den) - m2)
    return (c >= F.least(m, m2)) & (c + beyond >= _need(n, n2, num, den))


def _any_room(num: int, den: int) -> Column:
    """Whether a posting (n, m, k) may be the first shingle shared with any set of a list with sizes from n_low
    to n_high, k being how many of its set's prefix shingles from this one on others have at all.  The room is
    least at the ends of the sizes."""
    n, m, k = map(F.col, ("n", "m", "k"))
    ends = (F.greatest("n_low", _least(n, num, den)), F.least("n_high", F.floor(den * n / F.lit(num))))
    short = [_need(n, e, num, den) - F.greatest(_least(n, num, den) - m, _least(e, num, den) - 1) for e in ends]
    return (k + 1 >= F.least(*short)) & (ends[0] <= ends[1])


def _alike(n: str, n2: str, num: int, den: int) -> Column:
    return F.lit(den) * F.least(n, n2) >= F.lit(num) * F.greatest(n, n2)


class Join:
    """One run over ``docs`` (id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, k: int, num: int, den: int):
        self.spark, self.docs, self.k, self.num, self.den = spark, docs, k, num, den
        self.ws = Workspace(spark, "jaccard")

    def verified(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """The pairs (v, v2) whose sets link."""
        k, num, den = self.k, self.num, self.den
        pairs = self.ws.keep(pairs.select("v", "v2"), f"{name}-pairs")
        used = pairs.select("v").union(pairs.select("v2")).distinct()
        ids = self.ws.keep(classes.join(used, "v").select(F.col("rep").alias("id")).distinct(), f"{name}-ids")

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (piece for whole in batches for piece in slices(whole, "text")):
                s, at = shingle_sets(*text_buffers(batch.column("text")), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signatures(s, at)), pa.array([s[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())], names=["v", "set"])

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = []
                for x, y in zip(batch.column("set"), batch.column("set2")):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(den * same >= num * (len(x) + len(y) - same))
                yield batch.select(["v", "v2"]).filter(pa.array(ok, pa.bool_()))

        mine = self.ws.keep(semi(self.docs, ids, "id").mapInArrow(sets, "v long, set binary").dropDuplicates(["v"]), f"{name}-sets")
        both = pairs.join(mine, "v").join(mine.select(F.col("v").alias("v2"), F.col("set").alias("set2")), "v2")
        links = self.ws.keep(both.select("v", "v2", "set", "set2").mapInArrow(check, "v long, v2 long"), f"{name}-links")
        self.ws.drop(pairs, ids, mine)
        return links

    def split(self, met: DataFrame, part: DataFrame | None) -> tuple[DataFrame, int, int]:
        """The postings (s, v, n, m, q, k) of lists with several components g, each with the list's largest (main); how
        many pairs they make, and how many postings there are.

        Two linked sets are found at the first shingle they share, in the common order; those they share besides come
        after it.  So a posting is left out if from it on its set has too few shingles that others have (k) to link
        with anything of the list's sizes -- as the most frequent shingles at the end of a prefix are."""
        ws = self.ws
        placed = met.withColumn("g", F.col("v"))
        if part is not None:
            placed = met.join(part.withColumnRenamed("u", "v"), "v", "left").withColumn("g", F.coalesce("component", "v")).drop("component")
        placed = ws.keep(placed, "placed")
        mixed = placed
        if part is not None:
            several = placed.groupBy("s").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a < b").select("s")
            mixed = ws.keep(placed.join(several, "s"), "mixed")
        onward = Window.partitionBy("v").orderBy(F.desc("at"))
        able = mixed.withColumn("k", F.row_number().over(onward)).where(_any_room(self.num, self.den))
        able = ws.keep(able.drop("n_low", "n_high", "at"), "able")
        counts = able.groupBy("s", "g").agg(F.count("*").alias("c"))
        main = ws.keep(counts.groupBy("s").agg(
            F.max_by("g", F.struct("c", "g")).alias("main"), F.max("c").alias("c"), F.sum("c").alias("n_all")).where("c < n_all"), "main")
        work = main.agg(F.coalesce(F.sum((F.col("n_all") - F.col("c")) * F.col("n_all")), F.lit(0))).first()[0]
        rows = met.count()
        split = ws.keep(able.join(main.select("s", "main"), "s"), "split")
        ws.drop(placed, mixed, able, main)
        return split, work, rows

    def pairs(self, rows: DataFrame, others: DataFrame, where: str, met: DataFrame, name: str) -> DataFrame:
        """Pairs (v, v2) of postings of one shingle that may link, by how many prefix shingles they share."""
        num, den = self.num, self.den
        may = _alike("n", "n2", num, den) & _room(F.least("k", "k2"), num, den)
        both = rows.join(others, "s").where(where).where(may)
        swap = F.col("v") > F.col("v2")
        both = both.select(*(F.when(swap, F.col(b)).otherwise(F.col(a)).alias(c) for a, b, c in (
            ("v", "v2", "v"), ("n", "n2", "n"), ("m", "m2", "m"), ("v2", "v", "v2"), ("n2", "n", "n2"), ("m2", "m", "m2"))))
        both = self.ws.keep(both.distinct(), f"{name}-met")
        used = both.select("v").union(both.select("v2")).distinct()
        # written, since both sides of a pair read it
        lists = self.ws.keep(semi(met, used, "v").groupBy("v").agg(F.collect_set("s").alias("list")), f"{name}-lists")
        both = both.join(lists, "v").join(lists.select(F.col("v").alias("v2"), F.col("list").alias("list2")), "v2")
        return both.where(_room(F.size(F.array_intersect("list", "list2")), num, den)).select("v", "v2")

    def stars(self, split: DataFrame, met: DataFrame, round_no: int) -> DataFrame:
        """Pairs of each posting and its list's hub that may link by the shingles they share with that hub."""
        hubs = (split if round_no == 0 else split.where("g != main")).groupBy("s").agg(
            F.max(F.struct("q", "v", "n", "m", "k", "g")).alias("h")).select(
            "s", *(F.col(f"h.{c}").alias(f"{c}2") for c in ("v", "n", "m", "k", "g")))
        return self.pairs(split, hubs, "g != g2", met, f"stars{round_no}")

    def run(self) -> DataFrame:
        """Per row of docs: id, n_shingles, component_id."""
        k, num, den, ws = self.k, self.num, self.den, self.ws
        scan = ws.keep(self.docs.mapInArrow(
            lambda b: _scan(b, k), "id long, n long, v long, part long, slice long, at binary, counts binary"), "scan")
        sets = scan.where("slice IS NULL").select("id", "n", "v")
        full = sets.where("n > 0 AND id IS NOT NULL")
        classes = ws.keep(full.groupBy("v").agg(F.min("id").alias("rep")), "classes")
        often = full.groupBy("id").agg(F.count("*").alias("rows"), F.first("v").alias("v"))
        copies = often.where("rows = 1").join(classes, "v").where("id != rep").select("id")
        copies = ws.keep(copies, "copies")
        sketch = _sketch(scan.where("slice IS NOT NULL").select("part", "slice", "at", "counts"))
        shared = self.spark.sparkContext.broadcast(sketch)
        first = semi(self.docs.where("id IS NOT NULL"), copies, "id", how="left_anti")
        postings = ws.keep(first.mapInArrow(
            lambda b: _postings(b, k, shared.value, num, den), "s long, v long, at int, n int, m int, q int"), "postings")
        # a shingle of one class, or of two whose sizes are too far apart, joins nothing; a class emitted twice (rows of
        # one id) has the same postings twice
        lists = postings.groupBy("s").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("c"), F.min("n").alias("n_low"),
                                          F.max("n").alias("n_high")).where("a < b").where((F.col("c") > 2) | _alike("n_low", "n_high", num, den))
        lists = lists.select("s", "n_low", "n_high")
        met = ws.keep(postings.join(lists, "s").dropDuplicates(["s", "v"]), "met")
        ws.drop(postings)
        near, round_no, before = None, 0, None
        split, work, rows = self.split(met, None)
        # a round that changes little is the last: what is left isn't near its hubs
        while before is None or WORK * rows < work < 0.8 * before and round_no < ROUNDS:
            before = work
            links = self.verified(self.stars(split, met, round_no), classes, f"stars{round_no}")
            near = links if near is None else ws.keep(near.unionByName(links), "near")
            part = connected_components(near.select(F.col("v").alias("u"), F.col("v2").alias("v")), ws)
            ws.drop(split)
            split, work, rows = self.split(met, part)
            round_no += 1
        stray = split.where("g != main").select("s", "v", "n", "m", "k", "g")
        rest = split.select("s", "main", *(F.col(c).alias(f"{c}2") for c in ("v", "n", "m", "k", "g")))
        pairs = self.pairs(stray, rest, "g != g2 AND (g2 = main OR v < v2)", met, "across")
        far = self.verified(pairs, classes, "across")
        ws.drop(split, met)
        name = lambda c: classes.select(F.col("v").alias(c), F.col("rep").alias(f"r{c}"))
        links = (far if near is None else near.unionByName(far)).join(name("v"), "v").join(name("v2"), "v2").select(F.col("rv").alias("u"), F.col("rv2").alias("v"))
        again = full.join(often.where("rows > 1").select("id"), "id").join(classes, "v").select(F.col("id").alias("u"), F.col("rep").alias("v"))
        found = connected_components(links.unionByName(again), ws)
        named = classes.join(found.withColumnRenamed("u", "rep"), "rep", "left").select("v", F.coalesce("component", "rep").alias("component"))
        linked = full.join(named, "v").select("id", "n", F.col("component"))
        alone = sets.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
        return linked.unionByName(alone).select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5,
                    threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links)."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return Join(spark, rows, k, *threshold).run().withColumnRenamed("id", key)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 4-word shingles, similarity 0.85."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))
