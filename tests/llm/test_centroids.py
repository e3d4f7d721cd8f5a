"""Clustering against plain loops over Python numbers."""

import hashlib
import math
import random

import pytest

from ledgerlens.llm import centroids

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, cluster string"


def by_loops(rows, k, rounds, dimensions, scale=256, seed=2):
    kept = [
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v, _ in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [list(v) for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), c in zip(kept, found) if c == n]
            if own:
                centres[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [nearest(v) for _, v in kept]
    parts = {n: sum(d for d, c in found if c == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    total = sum(d for d, _ in found)
    return sorted(((i, c, d, parts[c], total, digest[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def results(frame):
    assert frame.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_clusters_equal_plain_loops(spark, k):
    draw = random.Random(k)
    exact = lambda: draw.randint(-512, 512) / 512  # noqa: E731  the same as float and as double
    rows = [(i, [exact() for _ in range(6)], "x") for i in range(80)]
    rows += [(100 + i, rows[3][1], None) for i in range(30)]  # copies
    rows += [(7, [exact() for _ in range(6)], "x"), (None, rows[5][1], "x"), (None, [exact() for _ in range(6)], "x")]
    rows += [(200, None, "x"), (201, [], "x"), (202, [0.5] * 5, "x"), (203, [0.5] * 5 + [None], "x")]
    rows += [(204, [0.5] * 5 + [NAN], "x"), (205, [0.5] * 5 + [-INF], "x")]
    got = results(centroids.clustered(table(spark, rows), k, 5, 6))
    assert got == by_loops(rows, k, 5, 6)


def test_equal_hashes_start_with_the_smaller_vector(spark):
    rows = [(1, [0.5, -0.25], "a"), (1, [-0.5, 0.75], "b"), (1, [-0.5, 0.25], "c"), (2, [3.0, 3.0], "d")]
    for k in (1, 2, 3):
        assert results(centroids.clustered(table(spark, rows), k, 0, 2)) == by_loops(rows, k, 0, 2)


def test_no_vectors_and_no_ids(spark):
    assert centroids.clustered(table(spark, [(1, None, "x")]), 3, 2, 2).count() == 0
    got = results(centroids.clustered(table(spark, [(None, [1.0, 2.0], "x")]), 3, 2, 2))
    assert got == [(None,) * 6]


def test_components_beyond_exact_arithmetic_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.clustered(table(spark, [(1, [1e30, 0.0], "x")]), 1, 1, 2).collect()
