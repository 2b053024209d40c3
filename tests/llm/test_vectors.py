"""Whitening and centroid clustering against brute force, with odd vectors."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from termtide.llm import centroids, qdwh, whitening
from termtide.llm.oracles import CENTROIDS
from termtide.llm.queries import op11_whitening, op13_centroids

VECTORS = "vec_id bigint, embedding array<float>, label int"


def made_vectors(dimensions, count=60, seed=3):
    """Vectors with repeats, repeated and null ids, null and undefined entries and odd lengths."""
    rng = np.random.default_rng(seed)
    points = np.float32(rng.normal(size=(count, dimensions)) * np.linspace(1, 0.2, dimensions))
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)]
    rows += [(7, points[7].tolist(), 2), (900, points[7].tolist(), 1), (None, points[3].tolist(), 1)]
    bad = points[0].tolist()
    rows += [(901, None, 1), (902, [], 1), (903, [None] + bad[1:], 1)]
    rows += [(904, [math.nan] + bad[1:], 1), (905, bad[:-1] + [math.inf], 1), (906, [-0.0] * dimensions, 1)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    def make(dimensions, extra=()):
        table = spark.createDataFrame(made_vectors(dimensions) + list(extra), VECTORS)
        for name in ("id", "x", "near", "n", "cluster", "length", "component", "pos"):
            table = table.withColumn(name, F.lit("clash"))
        return table.repartition(3)

    return make


def good(rows, scale):
    """`(id, integers)` of the vectors that count."""
    kept = []
    for vec_id, vector, _ in rows:
        if vector and all(v is not None and math.isfinite(v) for v in vector):
            kept.append((vec_id, tuple(math.floor(scale * float(np.float32(v))) for v in vector)))
    return kept


# ---------------------------------------------------------------- 11 whitening


def random_symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "a",
    [
        np.zeros((4, 4)),
        np.eye(5),
        np.diag([1.0, 1, 1, 0]),
        np.diag([0.0, 1, 2]),
        np.ones((9, 9)),
        random_symmetric(np.linspace(0.1, 5, 40)),
        random_symmetric([3.0] * 10 + [1.0] * 10 + [0.0] * 12),
        random_symmetric(np.logspace(0, -14, 30)),
        random_symmetric([1e6] + [1.0] * 20 + [1 + 1e-13] * 5),
        np.array([[2.0]]),
    ],
)
def test_eigen(a):
    values, vectors = qdwh.eigen(a)
    size = np.abs(a).max() or 1
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * size)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size


def test_polar_factor():
    a = np.random.default_rng(2).normal(size=(20, 20))
    u, _, v = np.linalg.svd(a)
    assert np.abs(qdwh.polar_factor(a) - u @ v).max() < 1e-12


def brute_whitening(rows, scale=256, count=4):
    kept = good(rows, scale)
    distinct = sorted({x for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[v - s / n for v, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = {}
    for _, x in kept:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        own = np.array([v - s / n for v, s in zip(x, sums)])
        for k in range(min(count, len(sums))):
            found[x, k + 1] = (n, deviation, own @ vectors[:, k] / values[k] ** 0.5,
                               values[k] / values.sum())
    return kept, found


@pytest.mark.parametrize("dimensions", [64, 3])
def test_whitening(spark, odd, dimensions):
    rows = made_vectors(dimensions)
    kept, want = brute_whitening(rows)
    got = whitening.whitened_embeddings(odd(dimensions)).collect()
    ids = sorted((r.id is None, r.id, r.component) for r in got)
    assert ids == sorted((i is None, i, k + 1) for i, _ in kept for k in range(min(4, dimensions)))
    by_id = {i: x for i, x in kept}
    signs = {}
    for r in got:
        n, deviation, white, explained = want[by_id[r.id], r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert math.isclose(r.explained, explained, rel_tol=1e-9)
        assert math.isclose(abs(r.whitened), abs(white), rel_tol=1e-7, abs_tol=1e-9)
        if abs(white) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * white > 0)
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], VECTORS)
    got = whitening.whitened_embeddings(one).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [
        (1, 0, None, None, None)
    ] * 4
    line = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [1.0, 1.0], 0)], VECTORS)
    got = {(r.id, r.component): r for r in whitening.whitened_embeddings(line).collect()}
    assert got[1, 2].whitened is None and abs(got[1, 2].explained) < 1e-12
    assert math.isclose(abs(got[1, 1].whitened), 1.0)


def test_whitening_lengths_and_empty(spark):
    rows = [(i, [float(i), float(i * i)], 0) for i in range(5)]
    rows += [(10 + i, [float(i), 1.0, float(i % 2)], 0) for i in range(4)]
    got = whitening.whitened_embeddings(spark.createDataFrame(rows, VECTORS)).collect()
    assert {(r.id, r.n) for r in got} == {(i, 5) for i in range(5)} | {(10 + i, 4) for i in range(4)}
    nothing = spark.createDataFrame([], VECTORS)
    assert whitening.whitened_embeddings(nothing).count() == 0


def test_whitening_large_entries(spark):
    big = 3.0e12
    rows = [(1, [big, 0.0]), (2, [big + 2.0, 1.0]), (3, [1e300, 0.0]), (4, [-big, 5.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = whitening.whitened_embeddings(table).filter("component = 1").collect()
    xs = {i: [math.floor(256 * v) for v in vector] for i, vector in rows if i != 3}
    sums = [sum(c) for c in zip(*xs.values())]
    want = {i: sum((3 * v - s) ** 2 for v, s in zip(x, sums)) for i, x in xs.items()}
    # These deviations are beyond a long; entries of 1e300 do not count.
    assert {r.id: r.deviation for r in got} == {i: None for i in want}
    assert min(want.values()) >= 1 << 63


def test_whitening_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    kept, want = brute_whitening(rows)
    got = op11_whitening(spark, small)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    by_id = dict(kept)
    got = got.collect()
    assert len(got) == 4 * len(kept)
    for r in got:
        n, deviation, white, explained = want[by_id[r.vec_id], r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert math.isclose(abs(r.whitened), abs(white), rel_tol=1e-7, abs_tol=1e-9)
        assert math.isclose(r.explained, explained, rel_tol=1e-9)


# ---------------------------------------------------------------- 13 centroids


def brute_clusters(rows, dimensions, clusters=16, rounds=3):
    kept = [(i, x) for i, x in good(rows, 64) if len(x) == dimensions]

    def order(row):
        named = hashlib.sha256(f"1:{row[0]}".encode()).hexdigest()
        return (row[0] is None, "" if row[0] is None else named, row[1])

    centres = [x for _, x in sorted(kept, key=order)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        centres = [
            tuple(sum(v) // len(members[k]) for v in zip(*members[k])) if k in members else c
            for k, c in enumerate(centres)
        ]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    own = {k: sum(d for _, j, d in found if j == k) for _, k, _ in found}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, k, d, own[k], sum(own.values()), hashes[k]) for i, k, d in found]


def null_last(row):
    return (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize("count", [0, 5, 60])
def test_clusters(spark, odd, count):
    rows = made_vectors(64)
    if count == 60:
        table = odd(64)
    else:
        rows = rows[:count]
        table = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r) for r in centroids.cluster_report(centroids.cluster(table)).collect()]
    assert sorted(got, key=null_last) == sorted(brute_clusters(rows, 64), key=null_last)


def test_clusters_of_any_size(spark):
    """Few dimensions give many equal distances; large entries need Python's integers."""
    rng = np.random.default_rng(5)
    for stretch in (1.0, 2.0**40):
        rows = [(i, (rng.integers(-3, 4, 3) * stretch / 64).tolist(), 0) for i in range(300)]
        schema = "vec_id bigint, embedding array<double>, label int"
        found = centroids.cluster(spark.createDataFrame(rows, schema), dimensions=3, clusters=7)
        got = [tuple(r) for r in found.assigned.collect()]
        points = [(i, tuple(math.floor(64 * v) for v in x)) for i, x, _ in rows]
        pool = sorted(points, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
        centres = [x for _, x in pool[:7]]
        for _ in range(3):
            members = {}
            for _, x in points:
                key = min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))
                members.setdefault(key[1], []).append(x)
            centres = [
                tuple(sum(v) // len(members[k]) for v in zip(*members[k])) if k in members else c
                for k, c in enumerate(centres)
            ]
        want = []
        for i, x in points:
            d, k = min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))
            want.append((i, k, d if d < 1 << 63 else None))
        assert sorted(got) == sorted(want)
        assert [tuple(c) for c in found.centroids] == centres


def test_bounds_save_distances(spark):
    """Vectors in tight groups far apart need little more than a distance each."""
    rng = np.random.default_rng(6)
    places = rng.normal(size=(16, 64)) * 10
    rows = [(i, (places[i % 16] + rng.normal(size=64) * 0.01).tolist(), 0) for i in range(800)]
    found = centroids.cluster(spark.createDataFrame(rows, VECTORS))
    assert all(exact < 0.3 * every for exact, every in found.computed)


def test_clusters_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = op13_centroids(spark, small)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                           "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_clusters(rows, 64))


def test_clusters_in_sql(spark, odd, tmp_path):
    path = str(tmp_path / "embeddings.parquet")
    table = odd(64).select("vec_id", "embedding", "label").coalesce(1)
    table.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    got = [tuple(r) for r in con.execute(CENTROIDS).fetchall()]
    want = [tuple(r) for r in op13_centroids(spark, str(tmp_path)).collect()]
    assert sorted(got, key=null_last) == sorted(want, key=null_last)
