"""Whitening of embeddings by a bit-sliced scatter matrix.

Each entry c becomes the integer x = floor(scale * c).  The fit list holds each distinct
x-vector once.

* Scatter: blocks of the fit list are shifted by each dimension's least value, and every
  bit plane of a dimension is packed across the rows into 64-bit words.  The sum of
  products of two dimensions is the sum over pairs of their planes of
  2^(a+b) * popcount(plane a AND plane b); undoing the shift is integer arithmetic, so
  the cross-products are exact whatever the values are.  A dimension has only as many
  planes as its range in the block needs.
* Sums of tasks: each is cut into ``LIMBS`` limbs of ``LIMB_BITS`` bits, which Spark adds
  as longs; a row for each pair of dimensions reaches the driver (dimensions squared,
  whatever the number of vectors).
* Covariance: n * sum(x y) - sum(x) sum(y), centred as integers, over n^2; then eigh.
* Projection: x - S/n as (x - S div n) - (S mod n)/n, in one pass over all rows.

Nothing but the distinct x-vectors is shuffled (copies go before the shuffle), and a
task holds one block.

Defined results: a vector that is null or holds a null or non-finite entry is dropped; an
x beyond the range of long is its end; vectors of different lengths are whitened apart,
each length by its own fit; an empty vector has no component; a null key is kept; repeated
rows are projected each and fitted once; a component whose eigenvalue is 0 to the
precision of a double (one distinct vector, dependent dimensions) has whitened null and does not count
for identity_error, which is null if there is no other; explained is null where all
variance is 0; a deviation of more than 38 digits is null; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import Workspace, table

SCALE, COMPONENTS = 256, 4
#: Entries (rows times dimensions) of a block.
BLOCK_ENTRIES = 1 << 20
#: A sum in limbs: 5 * 40 bits hold a product of two longs over 2^72 rows.
LIMBS, LIMB_BITS = 5, 40
KEPT_DIGITS = 10 ** 38


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Planes of the columns of ``x`` (int64), each packed across the rows into words; the column and
    bit of each plane; the columns' least values."""
    low = x.min(0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2^64, exact for any two longs
    width = np.array([int(v).bit_length() for v in y.max(0)], np.int64)
    column = np.repeat(np.arange(x.shape[1]), width)
    bit = np.arange(len(column)) - np.repeat(np.cumsum(width) - width, width)
    words = np.zeros((len(column), -(-len(x) // 64)), np.uint64)
    by_column = np.ascontiguousarray(y.T)
    packed = words.view(np.uint8)
    for p, (c, b) in enumerate(zip(column, bit)):
        bits = np.packbits((by_column[c] >> np.uint64(b)).astype(np.uint8) & np.uint8(1))
        packed[p, :len(bits)] = bits
    return words, column, bit, low


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over the rows of ``x``: of the columns, and of their products (upper triangle), as Python integers."""
    rows, dims = x.shape
    words, column, bit, low = bit_planes(x)
    exact = 2 * (int(bit.max(initial=0)) + 1) + rows.bit_length() < 63
    kind = np.int64 if exact else object
    weight = np.array([1 << int(b) for b in bit], kind)
    shifted, products = np.zeros(dims, kind), np.zeros((dims, dims), kind)
    for p in range(len(words)):
        both = np.bitwise_count(words[p] & words[p:])
        counts = both.sum(1, dtype=np.int64).astype(kind) * weight[p:]
        starts = np.flatnonzero(np.diff(column[p:], prepend=-1))
        c = column[p]
        sums = np.add.reduceat(counts, starts) * weight[p]
        # planes of the same column meet in both orders
        sums[0] = 2 * sums[0] - counts[0] * weight[p]
        products[c, column[p:][starts]] += sums
        shifted[c] += counts[0]
    shifted, products = shifted.astype(object), products.astype(object)
    low = low.astype(object)
    total = shifted + rows * low
    # (y + low)(y' + low') summed
    products = products + np.outer(low, shifted) + np.outer(shifted, low) + rows * np.outer(low, low)
    return total, np.triu(products)


def limbs(value: int) -> list[int]:
    return [value >> LIMB_BITS * k & (1 << LIMB_BITS) - 1 for k in range(LIMBS - 1)] + [value >> LIMB_BITS * (LIMBS - 1)]


def matrix_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


class Fit:
    """Exact n and S, and the leading components of the covariance."""

    def __init__(self, n: int, total: np.ndarray, products: np.ndarray, components: int):
        self.n, self.total, dims = n, total, len(total)
        centred = n * products - np.outer(total, total)
        v = np.array([[centred[min(i, j), max(i, j)] / (n * n) for j in range(dims)] for i in range(dims)], float)
        values, vectors = np.linalg.eigh(v)
        k = min(components, dims)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        trace = sum(centred[i, i] for i in range(dims)) / (n * n)
        self.explained = [float(e / trace) if trace > 0 else None for e in values]
        self.real = values > dims * np.finfo(float).eps * max(float(values[0]), 0.0)
        sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])  # the largest entry is positive
        self.axes = np.where(self.real, vectors * sign / np.sqrt(np.where(self.real, values, 1.0)), 0.0)
        self.whole = np.array([int(s) // n for s in total], object)
        self.rest = np.array([int(s) % n / n for s in total], float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        low, high = int(min(self.whole)), int(max(self.whole))
        if -(1 << 62) < min(low, int(x.min())) and max(high, int(x.max())) < 1 << 62:
            centred = (x - self.whole.astype(np.int64)).astype(float)
        else:
            centred = (x.astype(object) - self.whole).astype(float)
        return (centred - self.rest) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2 of each row, exact."""
        top = max(abs(int(x.min())), abs(int(x.max())), *(abs(int(s)) for s in self.total))
        wide = object if top * max(abs(int(x.min())), abs(int(x.max())), 1) * x.shape[1] >= 1 << 63 else np.int64
        y = x.astype(wide)
        squares, mixed = (y * y).sum(1), (y * self.total.astype(wide)).sum(1)
        constant = sum(int(s) ** 2 for s in self.total)
        return [self.n * self.n * int(q) - 2 * self.n * int(r) + constant for q, r in zip(squares, mixed)]


def fit(distinct: DataFrame, dim: int, components: int) -> Fit:
    """``distinct``: x (array of long, ``dim`` entries)."""
    block = max(64, BLOCK_ENTRIES // dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products, waiting = 0, 0, 0, []
        for batch in batches:
            waiting.append(matrix_of(batch.column("x"), dim))
            while sum(map(len, waiting)) >= block:
                x = np.concatenate(waiting)
                waiting = [x[block:]]
                s, p = scatter(x[:block])
                n, total, products = n + block, total + s, products + p
        x = np.concatenate(waiting) if waiting else np.zeros((0, dim), np.int64)
        if len(x):
            s, p = scatter(x)
            n, total, products = n + len(x), total + s, products + p
        if not n:
            return
        # i = -1: the count (j = -1) and the sums
        entries = [(-1, -1, n), *((-1, j, total[j]) for j in range(dim)), *((i, j, products[i, j]) for i in range(dim) for j in range(i, dim))]
        i, j, values = zip(*entries)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(part, pa.int64()) for part in zip(*(limbs(int(v)) for v in values)))],
            names=["i", "j", *(f"l{k}" for k in range(LIMBS))])

    kind = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    sums = distinct.mapInArrow(run, kind).groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).toArrow()
    n, total, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
    parts = [sums.column(f"l{k}").to_pylist() for k in range(LIMBS)]
    for i, j, *part in zip(sums.column("i").to_pylist(), sums.column("j").to_pylist(), *parts):
        value = sum(v << LIMB_BITS * k for k, v in enumerate(part))
        if i >= 0:
            products[i, j] = value
        elif j >= 0:
            total[j] = value
        else:
            n = value
    return Fit(n, total, products, components)


def identity_error(distinct: DataFrame, dim: int, model: Fit) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    (real,) = np.nonzero(model.real)
    if not len(real):
        return None
    pairs = [(a, b) for a in real for b in real if a <= b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(model.real), len(model.real)))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(matrix_of(batch.column("x"), dim))  # centred: x - S/n
                sums += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([float(sums[a, b])]) for a, b in pairs], names=[f"c{k}" for k in range(len(pairs))])

    found = distinct.mapInArrow(run, ", ".join(f"c{k} double" for k in range(len(pairs)))).agg(
        *(F.sum(f"c{k}").alias(f"c{k}") for k in range(len(pairs)))).first()
    return max(abs(found[k] / model.n - (a == b)) for k, (a, b) in enumerate(pairs))


def project(rows: DataFrame, key: T.StructField, dim: int, model: Fit) -> DataFrame:
    """``rows`` (key, x) to key, deviation, whitened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), dim)
            exact = [Decimal(v) if v < KEPT_DIGITS else None for v in model.deviations(x)]
            w = model.whitened(x)
            values = pa.array(w.ravel(), mask=np.tile(~model.real, len(w)))
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(key.name), pa.array(exact, pa.decimal128(38, 0)), pa.ListArray.from_arrays(ends, values)],
                                             names=[key.name, "deviation", "whitened"])

    schema = T.StructType([key, T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)


def fixed_point(embedding: str, scale: int) -> Column:
    return F.transform(F.col(embedding), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def whiten(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """Per remaining row: key, n, deviation (decimal), whitened and explained (arrays by component), identity_error."""
    ws = Workspace(spark, "whitening")
    good = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(good & (F.size(embedding) > 0)).select(F.col(key), fixed_point(embedding, scale).alias("x"))
    distinct = ws.keep(rows.select("x").distinct(), "distinct")
    out = None
    # a row for each length that occurs, one as a rule
    for (dim,) in distinct.groupBy(F.size("x").alias("d")).count().select("d").orderBy("d").collect():
        mine = distinct.where(F.size("x") == dim)
        model = fit(mine, dim, components)
        error = identity_error(mine, dim, model)
        part = project(rows.where(F.size("x") == dim), vectors.schema[key], dim, model).select(
            key, F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
            F.array(*(F.lit(e).cast("double") for e in model.explained)).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = vectors.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"{key} {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, "
                                         "identity_error double")
    return out


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, four components; a row for each vector and component (a deviation beyond the range of long is null)."""
    found = whiten(spark, table(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.explained").alias("explained"), "identity_error")
