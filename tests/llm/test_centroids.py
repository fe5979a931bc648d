"""Clusters against a plain version, and the products that are carried from round to round."""

import hashlib
import math

import numpy as np
import pytest
from saldomart.llm.centroids import cluster_vectors, nearest, updated_products

SCHEMA = "vec_id long, embedding array<float>, cluster int, v string, label int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, e, 9, "clash", 1) for i, e in rows], SCHEMA)


def _plain(rows, k, rounds, dims):
    """The same in exact Python numbers, every distance worked out anew."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in e]))
    named = [x for x in kept if x[0] is not None]
    named.sort(key=lambda x: (hashlib.sha256(f"1:{x[0]}".encode()).hexdigest(), x[1]))
    centroids = [v for _, v in named[:k]]
    if not centroids:
        return []

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (number, _) in zip(kept, found) if number == c]
            if members:
                centroids[c] = [sum(column) // len(members) for column in zip(*members)]
    found = assign()
    inertia = sum(d for _, d in found)
    return [
        (i, c, d, sum(x for n, x in found if n == c), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, found)
    ]


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *[x for x in r if x is not None]))


@pytest.mark.parametrize(("k", "rounds"), [(1, 1), (4, 3), (7, 0), (50, 2)])
def test_equals_plain_version(spark, k, rounds):
    random = np.random.default_rng(k)
    rows = [(i, [float(x) for x in random.normal(i % 3, 1.5, 5).astype(np.float32)]) for i in range(60)]
    rows += [(60 + i, rows[3][1]) for i in range(25)]  # one vector under many ids
    rows += [rows[5], rows[5], (5, rows[6][1])]  # repeated rows, and an id of two vectors
    rows += [(None, rows[7][1]), (None, rows[7][1])]
    rows += [(90, None), (91, []), (92, [1.0] * 4), (93, [1.0] * 6), (94, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(95, [math.nan] * 5), (96, [math.inf, 0.0, 0.0, 0.0, 0.0]), (97, [-0.0] * 5), (98, [-1e-9] * 5), (99, [1000.5] * 5)]
    got = [tuple(r) for r in cluster_vectors(_frame(spark, rows), k, rounds, 5).collect()]
    assert _sorted(got) == _sorted(_plain(rows, k, rounds, 5))


@pytest.mark.parametrize("rows", [[], [(None, [1.0] * 5)], [(1, [1.0] * 4)], [(1, [1e30] * 5)]])
def test_nothing_to_start_from(spark, rows):
    found = cluster_vectors(_frame(spark, rows), 4, 2, 5)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found.collect() == []


def test_products_are_carried_exactly():
    random = np.random.default_rng(3)
    v = random.integers(-(1 << 27), 1 << 27, (40, 64))
    centroids = random.integers(-(1 << 27), 1 << 27, (6, 64))
    products = updated_products(v, np.zeros((40, 6), np.int64), centroids)
    for _ in range(5):
        moved = np.where(random.random((6, 64)) < 0.1, random.integers(-(1 << 27), 1 << 27, (6, 64)), centroids)
        moved[2] = centroids[2]
        products = updated_products(v, products, moved - centroids)
        centroids = moved
        assert (products == v @ centroids.T).all()
    cluster, distance = nearest(v, products, centroids)
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in centroids] for x in v]
    assert cluster.tolist() == [d.index(min(d)) for d in plain] and distance.tolist() == [min(d) for d in plain]


def test_smaller_number_wins_a_tie():
    v, centroids = np.array([[0, 0]]), np.array([[5, 5], [1, 0], [0, 1], [0, -1]])
    assert nearest(v, v @ centroids.T, centroids)[0].tolist() == [1]


def test_too_many_centroids_are_refused(spark):
    with pytest.raises(ValueError, match="between"):
        cluster_vectors(_frame(spark, []), 1 << 20)
