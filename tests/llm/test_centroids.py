"""Clusters against plain k-means in integers, and on unusable, repeated and tied vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from hostpulse.llm import centroids

NAMES = "vec_id long, embedding array<float>, label int, cluster string, distance int, v int, n int"


def expected(rows, k, rounds, dims):
    usable = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in usable)
    centres = [v for _, v in start[:k]]

    def assign():
        for _, v in usable:
            yield min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = [[] for _ in centres]
        for (_, v), (_, n) in zip(usable, assign()):
            members[n].append(v)
        centres = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centres)]
    found = list(assign())
    inertia = [sum(d for d, n in found if n == number) for number in range(len(centres))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, n, d, inertia[n], sum(inertia), digests[n]) for (i, _), (d, n) in zip(usable, found)]


def clustered(spark, rows, **options):
    table = [(i, v, 1, "x", 2, 3, 4) for i, v in rows]
    found = centroids.cluster(spark.createDataFrame(table, NAMES).repartition(3), **options)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.0, 0.3, 5.0])
def test_equals_plain_clustering(spark, spread):
    rng = random.Random(5)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, spread) for x in rng.choice(middles)]) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (1000, None), (1001, []), (1002, [1.0] * 7), (1003, [1.0] * 9)]
    rows += [(1004, [None] + [1.0] * 7), (1005, [math.nan] * 8), (1006, [math.inf] + [0.0] * 7), (1007, [-math.inf] * 8)]
    found = clustered(spark, rows, k=6, rounds=3, dims=8)
    assert found == sorted(expected(rows, 6, 3, 8), key=repr)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5] * 4), (2, [0.5] * 4), (3, [-0.01] * 4)]
    assert clustered(spark, rows, dims=4) == sorted(expected(rows, 16, 3, 4), key=repr)
    assert clustered(spark, [], dims=4) == []
    assert clustered(spark, [(1, None)], dims=4) == []


def test_components_out_of_range(spark):
    with pytest.raises(Exception, match="beyond 2\\^27"):
        clustered(spark, [(1, [1e30, 0.0])], dims=2)
    assert clustered(spark, [(1, [2.0**21, 0.0])], dims=2)[0][2] == 0


def test_bounds_spare_distances_and_lose_none():
    rng = np.random.default_rng(3)
    middles = rng.integers(-2000, 2000, (16, 64))
    vectors = middles[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 64))
    pivots = centroids._spread(vectors[:256], 8)
    to_pivots = np.stack([np.sqrt(centroids._squares(vectors, pivot)) for pivot in pivots], 1)
    best, distance, measured = centroids.nearest(vectors, to_pivots, middles, pivots)
    squares = ((vectors[:, None] - middles[None]) ** 2).sum(2)
    assert (best == squares.argmin(1)).all() and (distance == squares.min(1)).all()
    # All distances would be 48 000.
    assert 3000 <= measured < 12_000


def test_vectors_between_two_centroids_take_the_smaller_number():
    vectors = np.array([[0, 0], [5, 5]])
    centres = np.array([[3, 0], [-3, 0], [0, 3], [5, 6], [5, 4]])
    to_pivots = np.stack([np.sqrt(centroids._squares(vectors, pivot)) for pivot in centres], 1)
    best, distance, _ = centroids.nearest(vectors, to_pivots, centres, centres)
    assert best.tolist() == [0, 3] and distance.tolist() == [9, 1]
