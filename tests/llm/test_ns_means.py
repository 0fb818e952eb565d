"""Clustering with Ns-bounds against plain rounds over all distances."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm.ns_means import LARGEST, LONG, MeansParams, Round, cluster_vectors

SCHEMA = "vec_id long, embedding array<double>, cluster string, q int, seen int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], SCHEMA)


def whole(x, scale):
    if abs(x) * scale >= LARGEST:
        return LARGEST if x > 0 else -LARGEST
    return int(np.floor(scale * x))


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain(rows, p):
    kept = [
        (i, tuple(whole(x, p.scale) for x in v))
        for i, v in rows
        if i is not None and v and len(v) == p.dim and all(x is not None and np.isfinite(x) for x in v)
    ]
    drawn = sorted(kept, key=lambda r: (hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(q) for _, q in drawn[: p.k]]

    def nearest():
        return [min(range(len(centroids)), key=lambda j: (square(q, centroids[j]), j)) for _, q in kept]

    for _ in range(p.rounds):
        own = nearest()
        for j in set(own):
            members = [q for (_, q), c in zip(kept, own, strict=True) if c == j]
            centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = nearest()
    d = [square(q, centroids[c]) for (_, q), c in zip(kept, own, strict=True)]
    inertia = {c: sum(x for x, y in zip(d, own, strict=True) if y == c) for c in set(own)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    limit = lambda v: min(v, LONG)
    return sorted(
        (i, c, limit(x), limit(inertia[c]), limit(sum(d)), digest[c])
        for (i, _), c, x in zip(kept, own, d, strict=True)
    )


def rows_of(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def clustered(rng, n, dim, groups):
    centres = rng.standard_normal((groups, dim)) * 3
    return [(i, (centres[i % groups] + rng.standard_normal(dim) * 0.3).tolist()) for i in range(n)]


@pytest.mark.parametrize("params", [MeansParams(k=6, dim=5, rounds=4, scale=8), MeansParams(k=9, dim=5, rounds=1)])
def test_equals_plain_rounds(spark, params):
    rows = clustered(np.random.default_rng(1), 300, 5, 7)
    assert rows_of(cluster_vectors(frame(spark, rows), params)) == plain(rows, params)


def test_ties_copies_and_empty_clusters(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-1, 2, 3).astype(float).tolist()) for i in range(120)]
    rows += [(1000 + i, [1.0, 0.0, 0.0]) for i in range(200)] + [rows[5], rows[5]]
    for params in (MeansParams(k=12, dim=3, scale=1.0, rounds=5), MeansParams(k=400, dim=3, scale=1.0)):
        assert rows_of(cluster_vectors(frame(spark, rows), params)) == plain(rows, params)


def test_odd_rows(spark):
    p = MeansParams(k=3, dim=2)
    rows = [(i, [float(i), -float(i)]) for i in range(9)]
    odd = [(20, None), (21, []), (22, [1.0]), (23, [1.0, None]), (24, [float("nan"), 0.0])]
    odd += [(25, [float("-inf"), 0.0]), (None, [1.0, 1.0]), (26, [-0.0, 0.0])]
    assert rows_of(cluster_vectors(frame(spark, rows + odd), p)) == plain(rows + odd, p)
    huge = [(30, [1e300, -1e300]), (31, [3e10, 1.0]), (32, [1e15, 1e15]), (33, [1e15, 1e15 + 1])]
    assert rows_of(cluster_vectors(frame(spark, rows + huge), p)) == plain(rows + huge, p)
    few = rows[:2]
    assert rows_of(cluster_vectors(frame(spark, few), p)) == plain(few, p)
    none = cluster_vectors(frame(spark, odd[:6]), p)
    assert none.collect() == [] and none.columns == cluster_vectors(frame(spark, few), p).columns


def test_bounds_spare_most_distances(spark):
    rows = clustered(np.random.default_rng(4), 1200, 8, 6)
    p = MeansParams(k=6, dim=8, rounds=6, scale=32.0)
    found = cluster_vectors(frame(spark, rows), p)
    assert rows_of(found) == plain(rows, p)
    per_row = found.agg(F.avg("evaluated")).first()[0]
    assert per_row < 0.5 * p.k * (p.rounds + 1)


def test_displacement_is_taken_whole_not_summed():
    """A centroid that came back has moved by nothing, so nothing is evaluated."""
    at = [[[0, 0], [100, 0]], [[40, 0], [100, 0]], [[0, 0], [100, 0]]]
    x = np.array([[1, 0], [99, 0]])
    own, _, dist, seen, _ = Round(at[:1]).first(x)
    own, least, _, _, evaluated = Round(at).again(x, own, dist, seen)
    assert own.tolist() == [0, 1] and evaluated.tolist() == [0, 0] and least.tolist() == [None, None]
