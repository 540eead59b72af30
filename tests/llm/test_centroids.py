import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lateflow.llm import centroids as C

SCHEMA = "vec_id long, v array<long>, cluster int, inertia string"


def plain_nearest(x, c):
    d = ((x[:, None, :].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
    best = [min(range(len(c)), key=lambda j: (row[j], j)) for row in d]
    return best, [int(row[j]) for row, j in zip(d, best)]


def plain(vectors, count=16, rounds=3):
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v)
                   for i, v in vectors if i is not None)[:count]
    c = [list(v) for _, v in first]
    if not c:
        return []
    x = np.array([v for _, v in vectors], dtype=object)
    for _ in range(rounds):
        got, _ = plain_nearest(x, np.array(c, dtype=object))
        for k in set(got):
            own = [v for (_, v), g in zip(vectors, got) if g == k]
            c[k] = [sum(col) // len(own) for col in zip(*own)]
    got, d = plain_nearest(x, np.array(c, dtype=object))
    out = []
    for (i, _), k, dist in zip(vectors, got, d):
        out.append((i, k, dist, sum(b for a, b in zip(got, d) if a == k), sum(d),
                    hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia",
                                       "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize("spread, large", [(3, 1), (40, 1), (1000, 60_000)])
def test_search_equals_all_distances(spread, large):
    rng = np.random.default_rng(spread)
    c = rng.integers(-spread, spread, (23, 8)) * large
    c[5] = c[11]                       # equal centroids: the smaller number
    c[7] = c[8][::-1]                  # equal mean and deviation
    x = np.concatenate((rng.integers(-spread, spread, (400, 8)) * large, c,
                        np.full((3, 8), 7 * large), -c + 1))
    cluster, distance, exact = C.Search(c).nearest(x)
    assert (cluster.tolist(), distance.tolist()) == plain_nearest(x, c)
    assert exact <= len(x) * len(c)


def test_bounds_reject_most_centroids_of_spread_data():
    rng = np.random.default_rng(4)
    at = rng.integers(0, 64, 5000)
    c = np.arange(64)[:, None] * 50 + rng.integers(-9, 9, (64, 16))
    x = c[at] + rng.integers(-20, 20, (5000, 16))
    *_, exact = C.Search(c).nearest(x)
    assert exact < 3 * len(x)


def test_largest_components_stay_exact():
    m = C.LARGEST - 1
    x = np.array([[m] * 64, [-m] * 64, [m, -m] * 32])
    cluster, distance, _ = C.Search(np.array([[-m] * 64, [m - 1] * 64])).nearest(x)
    assert cluster.tolist() == [1, 0, 1]
    assert distance.tolist() == [64, 0, 32 + 32 * (2 * m - 1) ** 2]


@pytest.mark.parametrize("n, count", [(300, 16), (9, 16), (1, 16), (60, 1)])
def test_rounds_equal_plain_lloyd(spark, n, count):
    rng = random.Random(n)
    vectors = [(i % 250, [rng.randint(-6, 6) for _ in range(5)]) for i in range(n)]
    vectors += [(None, [1] * 5)] * (n > 1)
    df = spark.createDataFrame([(*v, 1, "x") for v in vectors], SCHEMA).repartition(5)
    got = rows(C.clustered(df.select("vec_id", "v"), count))
    assert got == plain(vectors, count)


def test_vectors_that_take_no_part(spark):
    good = [0.25] * 64
    raw = [(1, good), (2, None), (3, good[:63]), (4, good + [0.0]), (5, [None] + good[1:]),
           (6, [float("nan")] + good[1:]), (7, [float("inf")] + good[1:]), (8, []),
           (9, [1e30] + good[1:]), (None, good), (1, good), (10, [-0.01] + good[1:])]
    df = spark.createDataFrame([(i, v, 5) for i, v in raw],
                               "vec_id long, embedding array<float>, cluster int")
    kept = C.kept_vectors(df, "vec_id", "embedding")
    assert sorted((r["vec_id"] or 0, r["v"][0]) for r in kept.collect()) == [
        (0, 16), (1, 16), (1, 16), (10, -1)]
    found = C.clustered(kept)
    assert rows(found) == plain([(r["vec_id"], r["v"]) for r in kept.collect()])
    none = C.clustered(C.kept_vectors(df.filter("vec_id = 2"), "vec_id", "embedding"))
    assert none.collect() == [] and none.columns == found.columns
    only_null = C.clustered(kept.filter("vec_id is null"))
    assert only_null.collect() == []


def test_a_lost_cluster_keeps_its_centroid():
    c = np.array([[0, 0], [9, 9]])
    row = {"cluster": 0, "n": 2, "s0": -3, "s1": 5}
    assert C.moved(c, [row]).tolist() == [[-2, 2], [9, 9]]


def test_default_is_the_contract():
    assert (C.CENTROIDS, C.COMPONENTS, C.ROUNDS, C.SCALE) == (16, 64, 3, 64)
    assert F.floor is not None
