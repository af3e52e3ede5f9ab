"""Centroid clustering with a LAESA pivot table: exact integer k-means that computes few of the distances.

- The distances of every vector to `PIVOTS` fixed vectors are computed once and stored with it. By the triangle inequality,
  |d(x, p) - d(c, p)| is at most d(x, c), whichever pivot p is, so the table bounds the distance of x to any centroid c from below.
- Each round, the centroid with the smallest bound is measured first. Only centroids whose bound does not exceed the smallest distance
  found so far are measured at all, in integers. The bounds are taken a little smaller than rounding could make them and ties stay
  in, so the assignment is the one that all distances would give.
- Each task adds up its vectors by cluster before anything is shuffled; `k` rows reach the driver in each round.

Vectors with another number of components, or with a null, NaN or infinite one, are left out, as are null vectors. Rows that repeat an id are vectors
of their own; of equal start hashes the smaller vector comes first, and a null id is hashed as `1:`. With fewer vectors than
`k` there are as many centroids as vectors; an empty table gives an empty result. A component beyond 2^27 after scaling has
squared distances that no long holds: it raises an error. Columns besides id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostpulse.llm.common import release, stored

#: Vectors that all distances are stored to, and the number of vectors that they are chosen from.
PIVOTS = 8
CANDIDATES = 256
#: Largest component whose squared distances stay within a long.
LARGEST = 1 << 27
#: Rows measured at a time.
ROWS = 8192


def kept(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """`id_col` and `v`, the components times `scale`, rounded down, of all usable vectors."""
    value = F.col(vector)
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where((F.size(value) == dims) & ~odd)
    large = F.exists(value, lambda x: F.abs(x.cast("double") * scale) > LARGEST)
    checked = F.when(large, F.raise_error(F.lit(f"a component times {scale} is beyond 2^27"))).otherwise(value)
    return usable.select(id_col, F.transform(checked, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _first(vectors: DataFrame, id_col: str, count: int) -> np.ndarray:
    """The `count` vectors with the smallest hashes of their ids."""
    text = F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    best = vectors.select(F.sha2(text, 256).alias("hash"), "v").orderBy("hash", "v").limit(count)
    return np.array([row.v for row in best.collect()], np.int64)


def _spread(candidates: np.ndarray, count: int) -> np.ndarray:
    """Pivots far apart: each is the candidate with the largest sum of distances to those before it."""
    chosen, total = [0], np.zeros(len(candidates))
    while len(chosen) < min(count, len(candidates)):
        total += np.sqrt(_squares(candidates, candidates[chosen[-1]]))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return candidates[chosen]


def _squares(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    gaps = vectors - one
    return np.einsum("ij,ij->i", gaps, gaps)


def _matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """Of each vector: its nearest centroid, the smaller number of equals, their squared distance; and how many were computed."""
    between = np.stack([np.sqrt(_squares(centroids, pivot)) for pivot in pivots], 1)
    bounds = np.zeros((len(vectors), len(centroids)))
    for pivot in range(len(pivots)):
        np.maximum(bounds, np.abs(to_pivots[:, pivot, None] - between[None, :, pivot]), out=bounds)
    # Far more than the rounding of two square roots and a difference.
    bounds = np.maximum(bounds - 1e-9 * (1 + to_pivots.max(1)[:, None] + between.max(1)[None, :]), 0) ** 2
    best = bounds.argmin(1)
    distance = np.empty(len(vectors), np.int64)
    for number in np.unique(best):
        rows = np.flatnonzero(best == number)
        distance[rows] = _squares(vectors[rows], centroids[number])
    measured, first = len(vectors), best.copy()
    for number in range(len(centroids)):
        rows = np.flatnonzero((bounds[:, number] <= distance) & (first != number))
        found = _squares(vectors[rows], centroids[number])
        measured += len(rows)
        closer = (found < distance[rows]) | ((found == distance[rows]) & (number < best[rows]))
        distance[rows[closer]], best[rows[closer]] = found[closer], number
    return best, distance, measured


def _pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their distances to all pivots."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column("v")) if batch.num_rows else np.empty((0, pivots.shape[1]), np.int64)
            gaps = np.stack([np.sqrt(_squares(found, pivot)) for pivot in pivots], 1)
            sizes = np.arange(len(found) + 1, dtype=np.int32) * len(pivots)
            yield batch.append_column("to_pivots", pa.ListArray.from_arrays(sizes, gaps.ravel()))

    schema = T.StructType([*vectors.schema.fields, T.StructField("to_pivots", T.ArrayType(T.DoubleType()))])
    return vectors.mapInArrow(measure, schema)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS):
        yield batch.slice(start, ROWS)


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: the centroids of the vectors nearest to each; empty ones stay."""
    count, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            for block in _blocks(batch):
                vectors = _matrix(block.column("v"))
                best, _, _ = nearest(vectors, _matrix(block.column("to_pivots"), float), centroids, pivots)
                sizes += np.bincount(best, minlength=count)
                for number in np.unique(best):
                    sums[number] += vectors[best == number].sum(0)
        numbers = np.flatnonzero(sizes)
        yield pa.record_batch(
            [pa.array(numbers, pa.int32()), pa.array(sizes[numbers]), pa.array(sums[numbers].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = table.mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    # At most a row for each task and cluster is shuffled, and one for each cluster is collected.
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[dim]) for dim in range(dims))).alias("sums")
    )
    moved = centroids.copy()
    for row in totals.collect():
        moved[row.cluster] = [value // row.n for value in row.sums]
    return moved


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, id_col: str) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                to_pivots = _matrix(block.column("to_pivots"), float)
                best, distance, measured = nearest(_matrix(block.column("v")), to_pivots, centroids, pivots)
                shares = np.zeros(block.num_rows, np.int64)
                shares[0] = measured
                yield pa.record_batch(
                    [block.column(id_col), pa.array(best, pa.int32()), pa.array(distance), pa.array(shares)],
                    names=[id_col, "cluster", "distance", "measured"],
                )

    names = [T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()), T.StructField("measured", T.LongType())]
    return table.mapInArrow(assign, T.StructType([table.schema[id_col], *names]))


def cluster(
    rows: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64
) -> DataFrame:
    """`id_col`, `cluster`, `distance`, `cluster_inertia`, `inertia` and `centroid_sha256` of every usable vector."""
    spark = rows.sparkSession
    vectors = kept(rows, id_col, vector, dims, scale)
    candidates = _first(vectors, id_col, max(k, CANDIDATES))
    if not len(candidates):
        fields = ", cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}{fields}")
    pivots = _spread(candidates, PIVOTS)
    table = stored(_pivot_table(vectors, pivots), "pivots")
    centroids = candidates[:k]
    for _ in range(rounds):
        centroids = _moved(table, centroids, pivots)
    found = stored(_assigned(table, centroids, pivots, id_col), "clusters")
    release(table)
    # One row for each cluster.
    inertia = {row.cluster: row.total for row in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    facts = [(n, total, sum(inertia.values()), digests[n]) for n, total in sorted(inertia.items())]
    names = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    joined = found.drop("measured").join(F.broadcast(spark.createDataFrame(facts, names)), "cluster")
    return joined.select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
