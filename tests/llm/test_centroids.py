"""The search against plain Python over all centroids, with hard rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from patronage.llm.centroids import Search, cluster_report, cluster_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, distance double"


def brute(rows, k, rounds, size, scale):
    kept = []
    for i, v in rows:
        if v is None or len(v) != size or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(x) * scale + math.floor((x - math.floor(x)) * scale) for x in v]))
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in named[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))
    for _ in range(rounds if centers else 0):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centers = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centers)]
    if not centers:  # no start
        return sorted(((i, None, None, None, None, None) for i, _ in kept), key=repr)
    found = [(i, *near(v)) for i, v in kept]
    big = 2**63 - 1
    inertia = {}
    for _, d, j in found:
        inertia[j] = None if d > big or inertia.get(j, 0) is None else inertia.get(j, 0) + d
    whole = None if None in inertia.values() else sum(inertia.values())
    fit = lambda v: None if v is None or v > big else v
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, fit(d), fit(inertia[j]), fit(whole), digest[j]) for i, d, j in found), key=repr)


def check(spark, rows, k=16, rounds=3, size=64, scale=64):
    frame = spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA).repartition(3)
    # as the table holds them
    stored = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    clustering = cluster_vectors(frame, k, rounds, size, scale)
    got = cluster_report(clustering)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(stored, k, rounds, size, scale)
    return clustering


def test_against_brute_force(spark):
    pick = random.Random(3)
    rows = [(i, [pick.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(300)]
    clustering = check(spark, rows)
    measured = [r["measured"] for r in clustering.assigned.collect()]
    assert 0 < np.mean(measured) < 16  # the inequalities spare distances


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = cluster_report(cluster_vectors(table))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 16, 3, 64, 64)


def test_hard_rows(spark):
    """Nulls, wrong sizes, null ids, repeated ids and vectors, ties, one vector that most rows hold."""
    pick = random.Random(4)
    grid = [(i, [float(pick.randint(-1, 1)) / 2 for _ in range(4)]) for i in range(80)]
    hard = [
        (None, [0.0, 0.0, 0.0, 0.0]), (None, None), (900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5),
        (904, [1.0, None, 1.0, 1.0]), (905, [math.nan, 1.0, 1.0, 1.0]), (906, [math.inf, 0.0, 0.0, 0.0]),
        (907, [-0.001, 0.001, -0.0, 0.0]), (7, [0.5, 0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5, 0.5]), (7, [-0.5, 0.5, 0.5, 0.5]),
    ]
    check(spark, grid + hard + [(1000 + i, [0.25] * 4) for i in range(200)], k=6, size=4)


def test_components_of_any_size(spark):
    pick = random.Random(5)
    rows = [(i, [pick.choice([1e9, -1e9, 3e38, -3e38, 2.0**21, -(2.0**21), 0.3, 7.7]) for _ in range(3)]) for i in range(60)]
    check(spark, rows, k=5, size=3)
    check(spark, [(i, [pick.choice([2.0**20, -(2.0**20), 2.0**20 - 1]) for _ in range(3)]) for i in range(60)], k=5, size=3)


def test_few_and_no_vectors(spark):
    check(spark, [(1, [0.5, 1.5]), (2, [2.5, 3.0])], size=2)
    check(spark, [(None, [0.5, 1.5])], size=2)
    check(spark, [], size=2)
    check(spark, [(1, [0.5, 1.5])], size=3)


def test_search_alone():
    pick = np.random.default_rng(6)
    for spread, base in ((3, 0), (40, 5), (1 << 26, 0), (2, 1 << 26)):
        centroids = (pick.integers(-spread, spread + 1, (40, 8)) + base).tolist()
        x = pick.integers(-spread, spread + 1, (500, 8)) + base
        best, least, _ = Search(centroids).nearest(x)
        full = ((x[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
        assert best.tolist() == full.argmin(axis=1).tolist() and least.tolist() == full.min(axis=1).tolist()
        assert [Search(centroids).nearest_far(row) for row in x[:50].tolist()] == list(zip(best[:50].tolist(), least[:50].tolist()))


def test_too_many_components(spark):
    with pytest.raises(ValueError):
        cluster_vectors(spark.createDataFrame([], SCHEMA), size=128)
