"""Embedding whitening: exact moments on Spark, components by QDWH, one broadcast matrix.

Every entry c becomes the integer x = floor(256 * c). The model is fitted on the distinct vectors
x: exact sums first, then the covariance, centred before multiplying. Each task sends a sum and a
covariance, not vectors; covariances are added up by row, so no task or driver gets more than a
matrix of them per group. The components come from `qdwh.eigen`, and the model that travels to
the tasks holds a mean and a few components, whose size depends on the dimensions alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm import qdwh
from termtide.llm.centroids import exact_sums, matrix, whole_numbers
from termtide.llm.common import cut

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4_096
_LONG = 1 << 63
_EXACT_SUM = "decimal(38,0)"


@dataclass(frozen=True)
class Model:
    """What vectors of one length are whitened with."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles; the whole part of the mean is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], object)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        if _fits(x, whole):
            return (x - whole.astype(np.int64)).astype(float) - rest
        return (x.astype(object) - whole).astype(float) - rest

    def scales(self, count: int) -> list[float | None]:
        """Reciprocal deviations of the first components; None where there is no variance."""
        least = qdwh.EPSILON * len(self.sums) * max(self.trace, 0.0)
        return [1 / e**0.5 if e > least else None for e in self.values[:count].tolist()]

    def whitened(self, x: np.ndarray, count: int) -> list[np.ndarray | None]:
        centred = self.centred(x)
        return [
            None if scale is None else (centred @ self.components[:, k]) * scale
            for k, scale in enumerate(self.scales(count))
        ]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S)^2; None beyond a long."""
        sums = np.array(self.sums, object)
        reach = max([abs(s) for s in self.sums], default=0)
        reach += self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if reach * reach * max(1, x.shape[1]) < _LONG:
            gap = self.n * x - sums.astype(np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = self.n * x.astype(object) - sums
        return [d if d < _LONG else None for d in (gap * gap).sum(axis=1).tolist()]


def _fits(x: np.ndarray, point: np.ndarray) -> bool:
    limit = 1 << 61
    return all(-limit < v < limit for v in point) and bool(
        not x.size or (x.min() > -limit and x.max() < limit)
    )


def _lengths(batches):
    """Rows of equal length at a time: `(batch, length, matrix)`."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            sizes = np.diff(part.column("x").offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                rows = part.filter(pa.array(sizes == size)) if (sizes != size).any() else part
                yield rows, size, matrix(rows.column("x"), size)


def _partial_sums(batches):
    counts, sums = {}, {}
    for _, size, x in _lengths(batches):
        counts[size] = counts.get(size, 0) + len(x)
        sums[size] = [a + b for a, b in zip(sums.get(size, [0] * size), exact_sums(x))]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(counts), pa.int32()),
            pa.array(list(counts.values()), pa.int64()),
            pa.array(list(sums.values()), pa.list_(pa.decimal128(38, 0))),
        ],
        names=["length", "n", "sums"],
    )


def _partial_scatter(means: dict[int, Model]):
    """For each length and row of the matrix the sum over vectors of centred products."""

    def run(batches):
        scatter = {}
        for _, size, x in _lengths(batches):
            centred = means[size].centred(x)
            scatter[size] = scatter.get(size, 0) + centred.T @ centred
        keys = [(size, row) for size in scatter for row in range(size)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int32()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([scatter[size][row].tolist() for size, row in keys], pa.list_(pa.float64())),
            ],
            names=["length", "pos", "products"],
        )

    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the arrays of a group, batch by batch."""
    total = None
    for batch in batches:
        keys = batch.column("length")[0].as_py(), batch.column("pos")[0].as_py()
        part = matrix(batch.column("products"), keys[0]).sum(axis=0)
        total = part if total is None else total + part
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([keys[0]], pa.int32()),
            pa.array([keys[1]], pa.int32()),
            pa.array([total.tolist()], pa.list_(pa.float64())),
        ],
        names=["length", "pos", "products"],
    )


def numbers_of(vectors: DataFrame, vec_col: str, scale: int = SCALE, id_col: str | None = None) -> DataFrame:
    """`(id, x)` of the vectors that count: not null, without null or non-finite entries.

    Entries beyond a long after scaling, and vectors without entries, do not count either.
    """
    own = [F.col(id_col).alias("id")] if id_col else []
    made = vectors.select(*own, whole_numbers(F.col(vec_col), scale).alias("x"))
    return made.filter(F.size("x") > 0)


def fit_list(vectors: DataFrame, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Each distinct x vector once, stored. Repeats are joined before the shuffle as well."""
    return cut(numbers_of(vectors, vec_col, scale).distinct(), "whitening-fit")


def fit(distinct: DataFrame) -> dict[int, Model]:
    """A model for each length of vector in the fit list.

    The driver gets sums and covariances, whose size depends on the dimensions alone.
    """
    sums = distinct.mapInArrow(_partial_sums, f"length int, n bigint, sums array<{_EXACT_SUM}>")
    sums = sums.select("length", "n", F.posexplode("sums").alias("pos", "part"))
    sums = sums.groupBy("length", "pos").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
    means: dict[int, Model] = {}
    none = np.zeros(0)
    for row in sums.orderBy("length", "pos").collect():
        model = means.setdefault(row.length, Model(row.n, [], none, none, 0.0))
        model.sums.append(int(row.total))
    if not means:
        return {}
    kind = "length int, pos int, products array<double>"
    parts = distinct.mapInArrow(_partial_scatter(means), kind)
    # Partial sums of some tasks first, so that no group has a row of every task.
    some = F.pmod(F.spark_partition_id(), F.lit(64)).alias("some")
    first = parts.select("*", some).groupBy("length", "pos", "some").applyInArrow(
        _add_rows, kind
    )
    added = first.groupBy("length", "pos").applyInArrow(_add_rows, kind)
    scatter = {size: np.zeros((size, size)) for size in means}
    for row in added.collect():
        scatter[row.length][row.pos] = row.products
    models = {}
    for size, mean in means.items():
        covariance = scatter[size] / mean.n
        values, components = qdwh.eigen(covariance)
        models[size] = Model(mean.n, mean.sums, values, components, float(np.trace(covariance)))
    return models


def _whiten(models: dict[int, Model], count: int, kind: pa.DataType | None):
    def run(batches):
        for rows, size, x in _lengths(batches):
            model = models[size]
            made = model.whitened(x, count)
            repeats = len(made)
            values = np.stack([np.full(len(x), np.nan) if m is None else m for m in made], axis=1)
            missing = np.array([m is None for m in made])
            explained = [e / model.trace if model.trace > 0 else None for e in model.values[:repeats]]
            picked = np.repeat(np.arange(len(x)), repeats)
            columns = {
                "length": pa.array(np.full(len(picked), size, np.int32)),
                "component": pa.array(np.tile(np.arange(1, repeats + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(picked), model.n, np.int64)),
                "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(picked)),
                "whitened": pa.array(values.ravel(), mask=np.tile(missing, len(x))),
                "explained": pa.array(explained * len(x), pa.float64()),
            }
            if kind is not None:
                columns = {"id": rows.column("id").take(pa.array(picked))} | columns
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


_RESULT = "length int, component int, n bigint, deviation bigint, whitened double, explained double"


def whiten(
    vectors: DataFrame,
    models: dict[int, Model],
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    count: int = COMPONENTS,
) -> DataFrame:
    """`(id, length, component, n, deviation, whitened, explained)` per row and component.

    Rows that `numbers_of` drops have none, nor have lengths without a model. Repeated ids and
    vectors give rows of their own. A component without variance whitens to null, explains 0, and
    null if there is no variance at all. A deviation beyond a long is null. Other columns are not
    read.
    """
    numbers = numbers_of(vectors, vec_col, scale, id_col)
    numbers = numbers.filter(F.size("x").isin(list(models)))
    kind = numbers.schema["id"].dataType
    return numbers.mapInArrow(
        _whiten(models, count, kind), f"id {kind.simpleString()}, {_RESULT}"
    )


def identity_errors(
    distinct: DataFrame, models: dict[int, Model], count: int = COMPONENTS
) -> dict[int, float]:
    """For each length the largest entry of the fit list's whitened covariance minus identity.

    Components without variance are left out.
    """
    names = [f"w{k}" for k in range(count)]

    def run(batches):
        for _, size, x in _lengths(batches):
            made = models[size].whitened(x, count)
            made += [None] * (count - len(made))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), size, np.int32))]
                + [pa.nulls(len(x), pa.float64()) if m is None else pa.array(m) for m in made],
                names=["length", *names],
            )

    white = distinct.mapInArrow(run, "length int, " + ", ".join(f"{n} double" for n in names))
    # covar_pop updates means and centred products together, so it never multiplies raw values.
    gaps = [
        F.abs(F.covar_pop(a, b) - F.lit(float(i == j)))
        for i, a in enumerate(names)
        for j, b in enumerate(names[i:], i)
    ]
    largest = F.greatest(*gaps) if len(gaps) > 1 else gaps[0]
    found = white.groupBy("length").agg(largest.alias("error")).collect()
    return {row.length: row.error for row in found}


def whitened_embeddings(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    count: int = COMPONENTS,
) -> DataFrame:
    """`whiten` after fitting on the distinct vectors of the same table, with `identity_error`.

    Vectors of different lengths are fitted apart. An empty table gives no rows.
    """
    distinct = fit_list(vectors, vec_col, scale)
    models = fit(distinct)
    errors = identity_errors(distinct, models, count) if models else {}
    error = F.lit(None).cast("double")
    for size, found in errors.items():
        error = F.when(F.col("length") == size, F.lit(found)).otherwise(error)
    return whiten(vectors, models, id_col, vec_col, scale, count).withColumn("identity_error", error)
