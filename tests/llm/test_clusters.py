"""Operator 11 against every distance, in Python's integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from townvoice.llm import clusters


def plain(rows, count, rounds, dims, scale=64):
    """(vec_id, cluster, distance) and the final centroids, all distances worked out."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:count]
    centroids = [list(v) for _, v in start]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        owners = [near(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, owners) if o == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centroids


def test_nearest_equals_every_distance():
    rng = np.random.default_rng(5)
    for spread in (3, 50, 100_000):
        vectors = rng.integers(-spread, spread, (400, 7))
        centroids = np.concatenate([rng.integers(-spread, spread, (20, 7)), vectors[:3], vectors[:3]])
        owner, best = clusters.nearest(vectors, clusters.codebook(centroids))
        every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (owner == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_bounds_hold_at_the_widest_components():
    wide = clusters.widest(64) - 1
    rng = np.random.default_rng(6)
    vectors = rng.choice([-wide, wide, wide - 1, 0], (200, 64))
    owner, best = clusters.nearest(vectors, clusters.codebook(vectors[:40]))
    for row in range(0, 200, 7):
        every = [sum((int(a) - int(b)) ** 2 for a, b in zip(vectors[row], c)) for c in vectors[:40]]
        assert best[row] == min(every) and owner[row] == every.index(min(every))


@pytest.mark.parametrize("parts", [1, 5])
def test_cluster_equals_a_plain_loop(spark, parts):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 260)]  # a hot vector
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, [0.1, 0.2, 0.3, -0.4])]
    rows += [(300, None), (301, []), (302, [1.0]), (303, [1.0, None, 1.0, 1.0]), (304, [1.0, float("nan"), 1.0, 1.0]), (305, [1.0, float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, cluster string, label int").repartition(parts)
    want, centroids = plain(rows, 6, 3, 4)
    got = clusters.cluster(df, count=6, dims=4).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    assert {r.inertia for r in got} == {sum(d for _, _, d in want)} and {r.label for r in got} == {1}
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert clusters.cluster(spark.createDataFrame([], schema)).collect() == []
    few = clusters.cluster(spark.createDataFrame([(1, [0.5] * 64), (2, [-0.5] * 64)], schema)).collect()
    assert sorted((r.vec_id, r.distance) for r in few) == [(1, 0), (2, 0)]


def test_too_large_a_component_is_named(spark):
    with pytest.raises(Exception, match="64 bits"):
        clusters.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).collect()
