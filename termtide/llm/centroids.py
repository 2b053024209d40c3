"""Centroid clustering with a LAESA pivot table, in exact integers.

Every vector becomes integers. The first centroids are also the pivots: the distance of each
vector to each pivot is computed once and stored beside it. In a round the distances of the
centroids to the pivots are known too, so by the triangle inequality
|d(vector, pivot) - d(centroid, pivot)| is a lower bound of d(vector, centroid) for every pivot.
A vector first gets its exact distance to the centroid with the least bound; only centroids whose
bound does not exceed the best distance so far get theirs. Bounds are doubles and are lowered by
more than their rounding error, distances that decide are integers, so pruning changes no result.

A round is one pass over the stored table. Each task adds up its vectors by cluster, so what is
shuffled is a row per task and cluster, and what reaches the driver is the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
# Rows whose bounds and differences a task holds at once.
BLOCK_ROWS = 4_096
# Up to this size of an entry a squared distance of up to 2^8 dimensions fits 64 bits.
_PLAIN = 1 << 26
_LONG = 1 << 63
# Relative error allowed for in a bound; that of the roots and differences is some 1e-15.
_SLACK = 1e-9


def whole_numbers(vec: Column, scale: int) -> Column:
    """An array of longs, floor(scale * entry); null where that is not defined.

    It is not for a null array, null, infinite or undefined entries, and entries beyond a long.
    """
    scaled = F.transform(vec.cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    fits = F.forall(scaled, lambda c: F.coalesce((c >= -(2.0**63)) & (c < 2.0**63), F.lit(False)))
    # In Spark's order of doubles NaN is above all others, so the comparison excludes it.
    return F.when(fits, F.transform(scaled, lambda c: F.floor(c).cast("bigint")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, width)


def squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to a point."""
    gap = x - point
    return (gap * gap).sum(axis=1)


def exact_kind(*arrays: np.ndarray) -> type:
    """Machine integers where squares of differences fit them, else Python's."""
    small = all(not a.size or (a.min() > -_PLAIN and a.max() < _PLAIN) for a in arrays)
    return np.int64 if small and all(a.shape[-1] <= 256 for a in arrays) else object


def roots(distances: np.ndarray) -> np.ndarray:
    return np.sqrt(distances.astype(np.float64))


def nearest(
    x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and exact squared distance of each row, and how many were computed.

    Equal distances go to the smaller number.
    """
    kind = exact_kind(x, centroids)
    x, centroids = x.astype(kind), centroids.astype(kind)
    bounds = np.zeros((len(x), len(centroids)))
    for pivot in range(centroid_pivots.shape[1]):
        near, far = to_pivots[:, pivot, None], centroid_pivots[None, :, pivot]
        np.maximum(bounds, np.abs(near - far) - _SLACK * (near + far), out=bounds)
    bounds *= bounds
    first = bounds.argmin(axis=1)
    gap = x - centroids[first]
    best = (gap * gap).sum(axis=1)
    own = first.copy()
    computed = len(x)
    for number in range(len(centroids)):
        # Bounds are below the true distance, so equal distances survive too.
        left = np.nonzero((bounds[:, number] <= best.astype(np.float64) * (1 + _SLACK)) & (first != number))[0]
        found = squared(x[left], centroids[number])
        computed += len(left)
        better = (found < best[left]) | ((found == best[left]) & (number < own[left]))
        rows = left[better]
        best[rows], own[rows] = found[better], number
    return own, best, computed


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def _pivot_table(pivots: np.ndarray):
    width = pivots.shape[1]

    def run(batches):
        for batch in _blocks(batches):
            x = matrix(batch.column("x"), width)
            kind = exact_kind(x, pivots)
            own = x.astype(kind)
            table = np.stack([roots(squared(own, p)) for p in pivots.astype(kind)], axis=1)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
            near = pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("x"), near], names=["id", "x", "near"]
            )

    return run


class Centroids:
    """Centroids, with their distances to the pivots."""

    def __init__(self, points: list[list[int]], pivots: list[list[int]]):
        self.points = np.array(points, np.int64).reshape(len(points), -1)
        self.pivots = np.array(pivots, np.int64).reshape(len(pivots), -1)
        kind = exact_kind(self.points, self.pivots)
        points, pivots = self.points.astype(kind), self.pivots.astype(kind)
        self.near = np.stack([roots(squared(points, p)) for p in pivots], axis=1)

    def assign(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        x = matrix(batch.column("x"), self.points.shape[1])
        near = matrix(batch.column("near"), len(self.pivots))
        return x, *nearest(x, near, self.points, self.near)


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums that do not overflow: high and low halves are added up apart."""
    high, low = x >> 32, x & 0xFFFFFFFF
    sums = zip(high.sum(axis=0).tolist(), low.sum(axis=0).tolist())
    return [(a << 32) + b for a, b in sums]


def _sums(model: Centroids):
    def run(batches):
        counts, sums = {}, {}
        computed = rows = 0
        for batch in _blocks(batches):
            x, own, _, exact = model.assign(batch)
            computed, rows = computed + exact, rows + len(x)
            for number in np.unique(own).tolist():
                of = x[own == number]
                counts[number] = counts.get(number, 0) + len(of)
                before = sums.get(number, [0] * x.shape[1])
                sums[number] = [a + b for a, b in zip(before, exact_sums(of))]
        total = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array([sums[number] for number in counts], pa.list_(total)),
                # How often a distance was computed, against a distance for every pair.
                pa.array([computed if i == 0 else 0 for i in range(len(counts))], pa.int64()),
                pa.array([rows if i == 0 else 0 for i in range(len(counts))], pa.int64()),
            ],
            names=["cluster", "members", "sums", "computed", "rows"],
        )

    return run


def _assignments(model: Centroids):
    def run(batches):
        for batch in _blocks(batches):
            _, own, best, _ = model.assign(batch)
            distances = [d if d < _LONG else None for d in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(own, pa.int32()), pa.array(distances, pa.int64())],
                names=["id", "cluster", "distance"],
            )

    return run


class Clustering:
    """What a run leaves behind: assignments, final centroids, and distances computed a round."""

    def __init__(self, assigned: DataFrame, centroids: list[list[int]], computed: list[tuple[int, int]]):
        self.assigned, self.centroids, self.computed = assigned, centroids, computed


def _first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hash of `seed:id`; null ids last, equal ids by vector."""
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    order = [F.col("chosen").asc_nulls_last(), F.col("x")]
    first = vectors.withColumn("chosen", chosen).orderBy(*order).limit(clusters)
    return [row.x for row in first.select("x").collect()]


def _moved(stored: DataFrame, model: Centroids) -> tuple[list[list[int]], tuple[int, int]]:
    """The centroids after a round; those without vectors stay."""
    parts = stored.mapInArrow(
        _sums(model),
        "cluster int, members bigint, sums array<decimal(38,0)>, computed bigint, rows bigint",
    )
    work = F.struct("computed", "rows").alias("work")
    parts = parts.select("cluster", "members", work, F.posexplode("sums").alias("pos", "part"))
    # A row per task, cluster and dimension; the sums are added up before the shuffle as well.
    at_first = F.col("pos") == 0
    sums = parts.groupBy("cluster", "pos").agg(
        F.sum("members").alias("members"),
        F.sum("part").alias("total"),
        F.sum(F.when(at_first, F.col("work.computed"))).alias("computed"),
        F.sum(F.when(at_first, F.col("work.rows"))).alias("rows"),
    )
    points = model.points.tolist()
    computed = rows = 0
    for row in sums.collect():
        points[row.cluster][row.pos] = int(row.total) // row.members
        computed, rows = computed + (row.computed or 0), rows + (row.rows or 0)
    return points, (computed, rows * len(points))


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> Clustering:
    """Assign every vector to one of `clusters` centroids after `rounds` rounds.

    `assigned` holds `(id, cluster, distance)` per kept row, where the distance is squared and
    counts in units of 1 / scale. Vectors of another length, null ones, and those with null or
    non-finite entries or entries beyond a long are dropped. Repeated ids are rows of their own;
    null ids are the last to become centroids. With fewer vectors than clusters there are as many
    centroids as vectors, with none no rows. A distance beyond a long is null. Other columns are
    not read.
    """
    numbers = vectors.select(
        F.col(id_col).alias("id"), whole_numbers(F.col(vec_col), scale).alias("x")
    ).filter(F.size("x") == dimensions)
    pivots = _first_centroids(numbers, clusters, seed)
    kind = numbers.schema["id"].dataType.simpleString()
    result = f"id {kind}, cluster int, distance bigint"
    if not pivots:
        return Clustering(numbers.limit(0).selectExpr("id", "0 AS cluster", "0L AS distance"), [], [])
    table = numbers.mapInArrow(
        _pivot_table(np.array(pivots, np.int64)), f"id {kind}, x array<bigint>, near array<double>"
    )
    stored = cut(table, "centroids-pivots")
    model, computed = Centroids(pivots, pivots), []
    for _ in range(rounds):
        points, work = _moved(stored, model)
        model = Centroids(points, pivots)
        computed.append(work)
    assigned = cut(stored.mapInArrow(_assignments(model), result), "centroids-assigned")
    return Clustering(assigned, model.points.tolist(), computed)


def centroid_hash(point: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, point)).encode()).hexdigest()


def long_or_null(total: Column) -> Column:
    """An exact sum as a long, null beyond its range."""
    return F.when(total.between(-_LONG, _LONG - 1), total.cast("bigint"))


def cluster_report(found: Clustering) -> DataFrame:
    """`assigned` with `cluster_inertia`, `inertia` and `centroid_sha256`.

    Inertias are exact sums of squared distances, null where they or a distance do not fit a long.
    """
    spark = found.assigned.sparkSession
    hashes = [(number, centroid_hash(point)) for number, point in enumerate(found.centroids)]
    named = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    whole = F.col("distance").cast("decimal(38,0)")
    whole_sum = F.when(F.count("*") == F.count("distance"), F.sum(whole))
    # A row for each centroid, as many as the caller asked for.
    sums = found.assigned.groupBy("cluster").agg(whole_sum.alias("own"), F.count("*").alias("n"))
    sums = sums.join(F.broadcast(named), "cluster")
    total = sums.select(F.when(F.count("*") == F.count("own"), F.sum("own"))).scalar()
    report = sums.select(
        "cluster",
        long_or_null(F.col("own")).alias("cluster_inertia"),
        long_or_null(total).alias("inertia"),
        "centroid_sha256",
    )
    return found.assigned.join(F.broadcast(report), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
