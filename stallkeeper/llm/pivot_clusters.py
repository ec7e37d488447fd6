"""Exact k-means in whole numbers with a LAESA pivot table.

Every component x becomes floor(scale * x).  The distances of all vectors to a few fixed pivots are taken once and stored beside the
vectors.  In each round the same few pivots are measured against the centroids; by the triangle inequality no centroid is nearer
to a vector than the largest difference of their pivot distances.  A vector first meets the centroid with the smallest bound; then
only centroids whose bound does not exceed the distance found get an exact distance in whole numbers.  The bounds are doubles and
are lowered by more than their rounding, so no centroid that could win or tie is left out.

A task reads its vectors with their stored distances and returns one row of sums for each cluster it met; Spark adds these up by cluster and
component, so a cluster with any share of the vectors costs each task one row, and the driver sees k centroids only.

How much the bounds save depends on the vectors: where all centroids are about as far as the nearest, as with the generated
embeddings, they leave 1.0 of 16 distances in the first round and 15.6 to 15.9 in the later ones.

Kept are vectors of ``size`` components of which none is null, NaN or infinite.  Components are held within +-2**62; distances
beyond a long are given as the largest long (the assignment itself is exact).  Rows repeating a vec_id are vectors of their own, ties of
the starting order are broken by the components; rows without vec_id are clustered but never start.  With fewer than k vectors there are
as many centroids as vectors; without any there are no rows.  Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stage

PIVOTS = 16
BOUND = 1 << 62
EASY = 1 << 26  # components below it have exact distances in 64 bits
TOP = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, size: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, x): the kept vectors in whole numbers."""
    e = F.col("embedding").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    hold = lambda c: F.greatest(F.least(F.floor(c), F.lit(BOUND)), F.lit(-BOUND))
    whole = lambda c: F.when(F.abs(c * scale) < float(BOUND), hold(c * scale)).otherwise(F.signum(c).cast("bigint") * BOUND)
    return vectors.filter((F.size("embedding") == size) & F.forall(e, finite)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(e, whole).alias("x"))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to the one vector ``c``, exact; Python numbers where 64 bits are too few."""
    if len(x) == 0 or max(abs(int(x.min())), abs(int(x.max())), *(abs(int(v)) for v in c)) < EASY:
        d = x - c
        return np.einsum("ij,ij->i", d, d)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(1)


def roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each row of ``x``, the smaller number on ties, and how many distances were taken."""
    k, n = len(centroids), len(x)
    bound = np.zeros((n, k))
    for p, pivot in enumerate(pivots):
        bound = np.maximum(bound, np.abs(to_pivots[:, p, None] - roots(distances(centroids, pivot))[None, :]))
    reach = to_pivots.max(1) if len(pivots) else np.zeros(n)
    bound = bound * (1 - 1e-9) - 1e-6 - reach[:, None] * 1e-9  # more than the rounding of the roots
    first = bound.argmin(1)
    best, near, taken = np.empty(n, object if _hard(x, centroids) else np.int64), first.copy(), n
    for c in range(k):
        rows = np.flatnonzero(first == c)
        best[rows] = distances(x[rows], centroids[c])
    for c in range(k):
        limit = roots(best)
        rows = np.flatnonzero((first != c) & (bound[:, c] <= limit * (1 + 1e-9)))
        taken += len(rows)
        d = distances(x[rows], centroids[c])
        wins = (d < best[rows]) | ((d == best[rows]) & (c < near[rows]))
        near[rows[wins]], best[rows[wins]] = c, d[wins]
    return near, best, taken


def _hard(x: np.ndarray, centroids: np.ndarray) -> bool:
    return any(len(a) and max(abs(int(a.min())), abs(int(a.max()))) >= EASY for a in (x, centroids))


def _matrix(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def start(vectors: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, pivots): the vectors with the smallest digests of ``1:<vec_id>``.

    The starting centroids are the first pivots, so that the bounds of the first round are the distances themselves.
    """
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).select(mark.alias("mark"), "x").orderBy("mark", "x").limit(max(k, pivots)).collect()
    pool = np.array([r["x"] for r in rows], np.int64)
    return pool[:k], pool[:pivots]


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, x, to_pivots), staged: the distance of every vector to each pivot."""
    width = pivots.shape[1]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), np.int64, width)
            d = np.stack([roots(distances(x, p)) for p in pivots], 1)
            ends = np.arange(0, d.size + 1, len(pivots), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(d.ravel()))],
                                             ["vec_id", "x", "to_pivots"])

    return stage(vectors.select("vec_id", "x").mapInArrow(measure, "vec_id long, x array<long>, to_pivots array<double>"), "pivots")


def assign(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance): every vector with its nearest centroid and exact squared distance."""
    width = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, best, _ = nearest(_matrix(batch.column(1), np.int64, width), _matrix(batch.column(2), np.float64, len(pivots)), centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.astype(np.int32)), pa.array([min(int(d), TOP) for d in best], pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    return table.select("vec_id", "x", "to_pivots").mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: componentwise exact floor of the mean of their vectors; empty ones stay."""
    k, width = centroids.shape

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, width), object), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch.column(1), np.int64, width)
            near, _, _ = nearest(x, _matrix(batch.column(2), np.float64, len(pivots)), centroids, pivots)
            hard = _hard(x, centroids)
            for c in np.unique(near).tolist():
                own = x[near == c]
                total[c] = total[c] + (own.astype(object) if hard else own).sum(0)
                count[c] += len(own)
        met = np.flatnonzero(count).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(count[met]), pa.array([[str(int(v)) for v in total[c]] for c in met], pa.list_(pa.string()))],
            ["cluster", "n", "sums"])

    parts = table.select("vec_id", "x", "to_pivots").mapInArrow(sums, "cluster int, n long, sums array<string>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    total = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in total.collect():  # one row for each component of a centroid
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, size, scale)
    centroids, fixed = start(kept, k, pivots)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    table = pivot_table(kept, fixed)
    for _ in range(rounds):
        centroids = moved(table, centroids, fixed)
    assigned = stage(assign(table, centroids, fixed), "assigned")
    return assigned.join(F.broadcast(_totals(spark, assigned, centroids)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _totals(spark: SparkSession, assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """A row for each cluster that has vectors; k of them at most."""
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = min(sum(sums.values()), TOP)
    mark = lambda c: hashlib.sha256(",".join(str(int(v)) for v in centroids[c]).encode()).hexdigest()
    return spark.createDataFrame([(c, min(d, TOP), whole, mark(c)) for c, d in sorted(sums.items())],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
