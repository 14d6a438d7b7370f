"""Clusters next to Lloyd's rounds over Python integers."""

import hashlib
import math
import random

import pytest

from spanloom.llm import centroids
from tests.llm.data import sort_key

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance long"


def vectors(dims=10, n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = (i % 7) - 3
        rows.append((i, [centre + rng.gauss(0, 0.7) for _ in range(dims)], 1, "x", 0))
    same = rows[5][1]
    rows += [(1000 + i, same, None, None, None) for i in range(150)]  # one common vector
    rows += [rows[3], rows[3]]
    rows += [(3, rows[4][1], 1, "y", 1), (None, rows[9][1], 1, "y", 1), (None, same, 1, "y", 1)]
    left_out = [
        (2000, None, 1, "y", 1),
        (2001, [], 1, "y", 1),
        (2002, [0.5] * (dims - 1), 1, "y", 1),
        (2003, [0.5] * (dims + 1), 1, "y", 1),
        (2004, [0.5] * (dims - 1) + [None], 1, "y", 1),
        (2005, [float("nan")] + [0.5] * (dims - 1), 1, "y", 1),
        (2006, [0.5] * (dims - 1) + [float("inf")], 1, "y", 1),
        (2007, [float("-inf")] + [0.5] * (dims - 1), 1, "y", 1),
    ]
    return rows, left_out


def brute(rows, dims, k, rounds, scale=64, seed=1):
    most = centroids.bound(dims)
    whole = [[int(math.floor(max(-most, min(most, scale * x)))) for x in r[1]] for r in rows]

    def rank(i):
        label = f"{seed}:" + ("null" if rows[i][0] is None else str(rows[i][0]))
        return hashlib.sha256(label.encode()).hexdigest(), rows[i][1]

    means = [whole[i] for i in sorted(range(len(rows)), key=rank)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(means))

    for _ in range(rounds):
        found = [nearest(v)[1] for v in whole]
        for j in range(len(means)):
            own = [v for v, f in zip(whole, found) if f == j]
            if own:
                means[j] = [sum(c) // len(own) for c in zip(*own)]
    found = [nearest(v) for v in whole]
    inertia = {j: sum(d for d, f in found if f == j) for j in range(len(means))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return [
        (r[0], j, d, min(inertia[j], 2**63 - 1), min(sum(inertia.values()), 2**63 - 1), digests[j])
        for r, (d, j) in zip(rows, found)
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=sort_key)


@pytest.mark.parametrize(("block_dims", "k"), [(4, 9), (10, 5), (64, 16)])
def test_same_as_brute_force(spark, block_dims, k):
    rows, left_out = vectors()
    table = spark.createDataFrame(rows + left_out, SCHEMA).repartition(5)
    found = centroids.cluster_vectors(table, 10, k, 3, block_dims=block_dims)
    assert found.columns[:2] == ["vec_id", "cluster"]
    assert rows_of(found) == sorted(brute(rows, 10, k, 3), key=sort_key)


def test_small_groups_and_salted_slices(spark, monkeypatch):
    rows, _ = vectors()
    monkeypatch.setattr(centroids, "GROUP_BYTES", 8 * 10 * 7)  # seven rows a record
    monkeypatch.setattr(centroids, "MAX_BROADCAST_BYTES", 0)
    found = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 10, 6, 2, block_dims=3)
    assert rows_of(found) == sorted(brute(rows, 10, 6, 2), key=sort_key)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows, left_out = vectors()
    few = rows[:4]
    found = centroids.cluster_vectors(spark.createDataFrame(few + left_out, SCHEMA), 10, 16, 3)
    assert rows_of(found) == sorted(brute(few, 10, 16, 3), key=sort_key)
    for table in (left_out, []):
        assert centroids.cluster_vectors(spark.createDataFrame(table, SCHEMA), 10).count() == 0


def test_huge_components_are_held_exactly(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randrange(40) for _ in range(10)], 0, "", 0) for i in range(60)]
    found = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 10, 4, 2, block_dims=4)
    assert rows_of(found) == sorted(brute(rows, 10, 4, 2), key=sort_key)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    # Equal vectors: all go to centroid 0, the others stay where they began.
    rows = [(i, [0.25, -0.5], 0, "", 0) for i in range(20)]
    found = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 2, 5, 3, block_dims=1)
    assert {(r.cluster, r.distance, r.inertia) for r in found.collect()} == {(0, 0, 0)}
