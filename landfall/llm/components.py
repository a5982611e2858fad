"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Workspace


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """``edges`` (u, v) to (u, component): the smallest vertex reachable, for each vertex that isn't it.

    Alternates the large-star and the small-star step until nothing changes: each
    links a vertex's larger (smaller) neighbours to its smallest neighbour.  A
    step is one aggregate and one join on the vertex; the number of rows never
    grows, each step's table is written, and no neighbourhood is collected, so a
    vertex with a third of all links is only a skewed join key.
    """
    edges = ws.keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = ws.keep(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        ws.drop(edges)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = ws.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        ws.drop(large)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select("u", F.col("v").alias("component"))
