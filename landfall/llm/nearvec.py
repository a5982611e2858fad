"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

* Equal vectors are one vector with a weight, so copies cost nothing in the products.
* Spherical k-means, fitted on a bounded sample (``sample_rows``), gives cells of
  about ``cell_rows`` vectors.  Each vector has a home cell, and also visits every
  cell whose centroid is at most ``margin`` less similar to it than its home's.
* Within a cell, home vectors meet each other and the visitors in blocks of
  ``block_rows`` by one matrix product in double precision for each pair of blocks;
  a hot cell is more pairs of blocks, not a larger task.  A pair that meets in
  both its homes counts in the smaller one.
* A block pair gives, for each of its linked vectors, the number of links and the
  smallest vector of its local component: rows in proportion to vectors, not pairs.

Links are never below the threshold.  A link is missed only if neither vector
visits the other's home: for two vectors with cosine 0.9 that differ in a random
direction of 64 dimensions, the difference of similarities to two centroids varies
by about 0.08, so the default margin of 0.2 leaves about one in a thousand of the
links right at the threshold and practically none of the nearer ones; ``tests/llm``
measures recall against brute force.

Defined results: a vector that is null, empty, zero or holds a null or non-finite
component links with nothing and is kept; vectors of different lengths don't
link; repeated rows are vectors of their own, but rows of one id with different
vectors are one vertex, and their links are counted together; a component's id
is its smallest vec_id; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, table
from landfall.llm.components import connected_components

CELL_ROWS, BLOCK_ROWS, SAMPLE_ROWS, MARGIN = 1000, 2048, 20_000, 0.2


def unit_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # the largest component first, so that squares neither overflow nor vanish
    flat = flat / np.abs(flat).max(1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """k unit centroids of the unit rows of ``x``; a cell left empty takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        sims = x @ c.T
        home = sims.argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        empty = np.flatnonzero(norm < 1e-12)
        if len(empty):
            total[empty] = x[np.argsort(sims.max(1))[:len(empty)]]
            norm = np.linalg.norm(total, axis=1)
        c = total / norm[:, None]
    return c


def _local_components(a: np.ndarray, b: np.ndarray, n: int, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable from each of n vertices over links a-b."""
    label = ids.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            return label
        label = new


def _compare(unit: pa.Table, threshold: float, margin: float, centroids: np.ndarray) -> pa.Table:
    """Links of one pair of blocks: id, links (weighted), label (smallest id of the local component)."""
    side = unit.column("side").to_numpy()
    ids, weight, home, cell = (unit.column(c).to_numpy() for c in ("id", "weight", "home", "cell"))
    x = unit_rows(unit.column("embedding").combine_chunks(), centroids.shape[1])
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)  # 1: of a block that meets itself
    a, b = np.nonzero(x[left] @ x[right].T >= threshold)
    a, b = left[a], right[b]
    meets_itself = side[a] == 1
    ok = ~meets_itself | (a < b)
    # of a visitor's pairs: found in the visitor's home as well, if the other visits there
    guest = home[b] != cell[b]
    sim_there = np.einsum("ij,ij->i", x[a], centroids[home[b]])
    sim_here = np.einsum("ij,ij->i", x[a], centroids[home[a]])
    ok &= ~(guest & (sim_there >= sim_here - margin) & (home[b] < home[a]))
    a, b = a[ok], b[ok]
    n = len(ids)
    links = np.bincount(a, weights=weight[b], minlength=n) + np.bincount(b, weights=weight[a], minlength=n)
    label = _local_components(a, b, n, ids)
    has = links > 0
    return pa.table({"id": ids[has], "links": links[has].astype(np.int64), "label": label[has]})


def _dealt(assigned: DataFrame, block_rows: int) -> DataFrame:
    """Rows of each block pair (unit): side 0 left, 2 right, 1 both."""
    sizes = assigned.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("h")).join(
        assigned.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("g")), "cell", "left")
    blocks = lambda c: F.ceil(F.coalesce(F.col(c), F.lit(0)) / block_rows).cast("int")
    sizes = F.broadcast(sizes.select("cell", blocks("h").alias("nh"), blocks("g").alias("ng")))  # a row for each centroid
    own = assigned.withColumn("cell", F.col("home")).drop("visits").join(sizes, "cell")
    own = own.withColumn("i", F.pmod(F.xxhash64("id"), F.col("nh")).cast("int"))
    at_home = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))).select(
        "cell", F.lit(0).alias("kind"), F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"),
        F.when(F.col("i") == F.col("j"), 1).when(F.col("i") < F.col("j"), 0).otherwise(2).alias("side"), "id", "weight", "home", "embedding")
    hosts = own.where("ng > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ng") - 1))).select(
        "cell", F.lit(1).alias("kind"), F.col("i").alias("p"), F.col("j").alias("q"), F.lit(0).alias("side"), "id", "weight", "home", "embedding")
    guests = assigned.withColumn("cell", F.explode("visits")).join(sizes, "cell").withColumn(
        "j", F.pmod(F.xxhash64("id", F.lit(1)), F.col("ng")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nh") - 1)))
    guests = guests.select("cell", F.lit(1).alias("kind"), F.col("i").alias("p"), F.col("j").alias("q"), F.lit(2).alias("side"),
                           "id", "weight", "home", "embedding")
    return at_home.unionByName(hosts).unionByName(guests)


def _links(spark: SparkSession, distinct: DataFrame, dim: int, ws: Workspace, threshold: float, margin: float, cell_rows: int,
           block_rows: int, sample_rows: int) -> DataFrame:
    """id, links and label of the vectors of one length, a row for each block pair that has links of it."""
    n = distinct.count()
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = distinct.where(place < sample_rows / n).select("embedding").limit(2 * sample_rows).toArrow().column(0).combine_chunks()
    if not len(sample):
        sample = distinct.select("embedding").limit(1).toArrow().column(0).combine_chunks()
    x = unit_rows(sample, dim)
    centroids = spherical_kmeans(x, max(1, min(-(-n // cell_rows), len(x) // 8)))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, 4096) for whole in batches for a in range(0, whole.num_rows, 4096)):
            sims = unit_rows(batch.column("embedding"), dim) @ shared.value.T
            home = sims.argmax(1)
            best = sims[np.arange(len(home)), home]
            near = sims >= (best - margin)[:, None]
            near[np.arange(len(home)), home] = False
            ends = np.concatenate([[0], near.sum(1).cumsum()]).astype(np.int32)
            visits = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(near)[1].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), visits],
                                             names=[*batch.schema.names, "home", "visits"])

    assigned = ws.keep(distinct.mapInArrow(
        assign, "id long, weight long, embedding array<float>, home int, visits array<int>"), "assigned")
    units = _dealt(assigned, block_rows).groupBy("cell", "kind", "p", "q")
    return ws.keep(units.applyInArrow(lambda t: _compare(t, threshold, margin, shared.value), "id long, links long, label long"), "links")


def near_duplicates(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                    margin: float = MARGIN, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS,
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: key, n_links, component_id, kept."""
    ws = Workspace(spark, "nearvec")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).cast("array<float>").alias("embedding"))
    good = F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0),
        F.lit(False)) & F.col("id").isNotNull()
    distinct = ws.keep(rows.where(good).groupBy("embedding").agg(F.min("id").alias("id"), F.count("*").alias("weight")).select(
        "id", "weight", "embedding"), "distinct")
    found = None
    # a row for each length that occurs, one as a rule
    for (dim,) in distinct.groupBy(F.size("embedding").alias("d")).count().select("d").collect():
        part = _links(spark, distinct.where(F.size("embedding") == dim), dim, ws, threshold, margin, cell_rows, block_rows, sample_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"))
    # one id may stand for several different vectors; a link's ends are ids, and rows of one id are in one component
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("u"), F.col("label").alias("v")), ws)
    named = distinct.join(counts, "id", "left").join(components.withColumnRenamed("u", "id"), "id", "left").select(
        F.col("embedding"), F.lit(True).alias("good"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    flagged = rows.withColumn("good", good)
    linked = flagged.where("good").join(named, ["embedding", "good"]).select("id", "n_links", "component_id")
    alone = flagged.where("NOT good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.9."""
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))
