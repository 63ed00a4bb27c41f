import math
from hashlib import sha256

import numpy as np
import oracle_check
import pytest
from pyspark.sql import functions as F

from salesmart.llm import centroids
from salesmart.llm.queries import ORACLE, QUERIES


def brute(rows, size=4, scale=64, k=5, rounds=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) by plain integers."""
    def good(v):
        return v is not None and len(v) == size and all(x is not None and math.isfinite(x) and abs(x * scale) < centroids.largest(size) - 1 for x in v)

    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if good(v)]
    order = sorted(kept, key=lambda r: (sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(middle)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if members:
                middle[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {c: sum(d for _, d, e in found if e == c) for _, _, c in found}
    texts = [sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return [(i, c, d, total[c], sum(total.values()), texts[c]) for i, d, c in found]


def rows():
    rng = np.random.default_rng(5)
    normal = [(k, (rng.normal(0, 3, 4) + 4 * (k % 3)).tolist()) for k in range(400)]
    copies = [(1000 + k, [1.0, -2.0, 0.25, -0.01]) for k in range(200)]
    ties = [(2000 + k, [float(k % 2), 0.0, 0.0, float(-(k % 2))]) for k in range(40)]
    odd = [
        (3000, None), (3001, []), (3002, [1.0, 2.0, 3.0]), (3003, [1.0, 2.0, None, 4.0]), (3004, [1.0, 2.0, float("nan"), 4.0]),
        (3005, [float("inf"), 0.0, 0.0, 0.0]), (3006, [1e38, 0.0, 0.0, 0.0]), (3007, [1.0] * 9000), (None, [0.5, 0.5, 0.5, 0.5]), (5, [9.0, 9.0, 9.0, 9.0]),
        (3008, [1e6, -1e6, 1e6, 1e6]), (3009, [-1e6, 1e6, 3.0, 1e6]),
    ]
    return normal + copies + ties + odd


def frame(spark, data):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<double>, cluster string, v int")


@pytest.mark.parametrize("k", [1, 5, 40])
def test_against_brute_force(spark, k):
    got = centroids.cluster(frame(spark, rows()).repartition(7), size=4, k=k).collect()
    key = str
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(rows(), k=k), key=key)


def test_fewer_vectors_than_centroids(spark):
    few = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0, 2.0, 3.0, 4.0]), (3, [9.0, 2.0, 3.0, 4.0])]
    got = centroids.cluster(frame(spark, few), size=4).collect()
    assert sorted(map(tuple, got)) == sorted(brute(few, k=16))


def test_nothing_kept(spark):
    assert centroids.cluster(frame(spark, rows()).limit(0)).count() == 0
    assert centroids.cluster(frame(spark, rows())).count() == 0  # no vector has 64 components


def test_search_is_exact_and_saves_distances():
    rng = np.random.default_rng(9)
    means = rng.normal(0, 40, (300, 1)) + rng.normal(0, 5, (300, 64)) * rng.uniform(0.2, 4, (300, 1))
    middle = np.floor(means).astype(np.int64)
    vectors = middle[rng.integers(0, 300, 3000)] + rng.integers(-9, 10, (3000, 64))
    vectors[:50] = middle[:50] // 2
    search = centroids.Nearest(middle)
    number, distance = search.search(vectors)
    every = ((vectors[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert search.measured < search.met < every.size / 4


def test_query_against_sql(spark, sf):
    got = QUERIES["op12_centroid_clustering"](spark, sf)
    assert oracle_check.compare(got, oracle_check.duck(sf), ORACLE["op12_centroid_clustering"]) is None
    assert got.select(F.countDistinct("cluster")).first()[0] == 16
