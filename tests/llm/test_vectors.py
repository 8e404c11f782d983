"""Vantage-point search and centroid clustering against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatline.llm import centroids, vantage
from beatline.llm.registry import queries

VECTORS = "vec_id long, embedding array<float>, label int, Cluster string, DISTANCE int, __v string"


def clumps(n, dimensions=64, seed=5):
    """Points around a few centres, a third of them copies of one point."""
    random = np.random.default_rng(seed)
    points = random.normal(size=(12, dimensions))[random.integers(0, 12, n)] + 0.2 * random.normal(size=(n, dimensions))
    points[random.random(n) < 1 / 3] = points[0]
    return points.astype(np.float32)


def exact(ids, points, asked, k):
    found = {}
    for q in asked:
        away = vantage.distances(points[[q]], points)[0]
        order = np.lexsort((ids, away))
        found[int(ids[q])] = [(int(ids[i]), float(away[i])) for i in order if ids[i] != ids[q]][:k]
    return found


def test_distances_add_in_order():
    a, b = np.random.default_rng(1).normal(size=(2, 5, 7))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            total = 0.0
            for p, q in zip(x.tolist(), y.tolist()):
                total += (p - q) * (p - q)
            assert vantage.distances(a, b)[i, j] == math.sqrt(total)


@pytest.mark.parametrize("n", [1, 2, 9, 700])
def test_factor_one_is_exact(n):
    points, ids = clumps(n).astype(float), np.arange(n) * 3 + 1
    tree = vantage.build(points, ids, leaf=16)
    asked = np.arange(0, n, 7)
    named, score, _ = vantage.search(tree, ids[asked], points[asked], 10, 1.0)
    for row, (at, wanted) in enumerate(exact(ids, points, asked, 10).items()):
        got = [(int(i), float(s)) for i, s in zip(named[row], score[row]) if s < math.inf]
        assert got == wanted, at


def test_larger_factors_look_less_and_keep_recall():
    points, ids = clumps(6000, 16).astype(float), np.arange(6000)
    tree = vantage.build(points, ids)
    asked = np.arange(0, 6000, 100)
    wanted = exact(ids, points, asked, 10)
    looked, recall = {}, {}
    for factor in (1.0, 2.0, 8.0):
        named, score, looked[factor] = vantage.search(tree, ids[asked], points[asked], 10, factor)
        hits = sum((score[i] <= wanted[int(q)][-1][1]).sum() for i, q in enumerate(ids[asked]))
        recall[factor] = hits / sum(len(x) for x in wanted.values())
    assert recall[1.0] == 1.0 and recall[2.0] >= 0.9
    assert looked[8.0] < looked[2.0] < looked[1.0] < 0.5 * len(asked) * len(ids)


def test_bounds_hold():
    points = clumps(900).astype(float)
    tree = vantage.build(points, np.arange(900), leaf=20)
    asked = clumps(40, seed=8).astype(float)
    for node, least in vantage.least_distances(tree, asked).items():
        begin, end = tree.leaves[node]
        assert (least <= vantage.distances(asked, tree.points[begin:end]).min(axis=1) + 1e-9).all()
    assert sorted(x for b, e in tree.leaves.values() for x in range(b, e)) == list(range(900))


def odd_vectors(spark):
    points = clumps(300).tolist()
    rows = [(i, p, 0, "c", 1, "r") for i, p in enumerate(points)]
    rows += [
        (400, None, 0, "c", 1, "r"),
        (500, [0.0] * 64, 0, "c", 1, "r"),
        (600, [1.0] * 63 + [None], 0, "c", 1, "r"),
        (700, [1.0] * 63 + [math.nan], 0, "c", 1, "r"),
        (800, [1.0] * 63 + [math.inf], 0, "c", 1, "r"),
        (900, [], 0, "c", 1, "r"),
        (1000, [1.0, 2.0], 0, "c", 1, "r"),
        (1001, [1.0, 2.5], None, None, None, None),
        (1100, points[3], None, None, None, None),
        (1100, points[3], None, None, None, None),
        (None, points[3], 0, "c", 1, "r"),
    ]
    return points, spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("shards", [None, 1, 5])
def test_search_of_odd_rows(spark, shards):
    points, frame = odd_vectors(spark)
    rows = vantage.nearest(frame, F.col("vec_id") % 100 == 0, shards=shards).orderBy("query_id", "rank").collect()
    by_query = {}
    for r in rows:
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by_query) == {0, 100, 200, 1000, 1100}
    assert by_query[1000] == [(1001, 0.5)]
    everyone = np.array([*points, points[3], points[3]])
    ids = np.array([*range(300), 1100, 1100])
    wanted = exact(ids, everyone, [0, 100, 200], 10)
    assert all(by_query[q] == wanted[q] for q in wanted)
    assert len(by_query[1100]) == 20  # two rows ask, each for itself
    empty = frame.where("vec_id < 0")
    assert vantage.nearest(empty, F.col("vec_id") % 100 == 0).count() == 0


def test_search_query_against_brute_force(spark, sf_dir):
    rows = queries()["op11_vantage_point_search"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    points = np.array([r["embedding"] for r in table], dtype=float)
    wanted = exact(ids, points, np.flatnonzero(ids % 100 == 0), 10)
    assert sorted(tuple(r) for r in rows) == sorted(
        (q, rank, i, s) for q, found in wanted.items() for rank, (i, s) in enumerate(found, 1)
    )


def lloyd(points, first, rounds):
    """Plain rounds over whole numbers."""
    centres = [list(map(int, points[i])) for i in first]
    points = points.astype(object)

    def assign():
        away = np.array([[sum((x - y) ** 2 for x, y in zip(p, c)) for c in centres] for p in points], dtype=np.int64)
        return away.argmin(axis=1), away.min(axis=1)

    for _ in range(rounds):
        where, _ = assign()
        for c in range(len(centres)):
            own = points[where == c]
            if len(own):
                centres[c] = [int(x) // len(own) for x in own.sum(axis=0)]
    return (*assign(), centres)


@pytest.mark.parametrize("n, k, rounds, most_runs", [(400, 6, 12, 12), (400, 6, 12, 3), (3, 8, 2, 12), (1, 1, 3, 12)])
def test_clusters_are_those_of_plain_rounds(spark, monkeypatch, n, k, rounds, most_runs):
    monkeypatch.setattr(centroids, "MOST_RUNS", most_runs)
    points = clumps(n, 8, seed=n + k)
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id long, embedding array<float>")
    found = centroids.cluster(frame, k, rounds, F.col("vec_id"), dimensions=8)
    whole = np.floor(points.astype(float) * 1024).astype(np.int64)
    # equal IDs of the order do not occur, so the first rows are the first centroids
    where, away, centres = lloyd(whole, range(min(k, n)), rounds)
    rows = {r["vec_id"]: r for r in found.vectors.collect()}
    assert [rows[i]["cluster"] for i in range(n)] == where.tolist()
    assert [rows[i]["distance"] for i in range(n)] == away.tolist()
    assert found.centroids == centres
    assert sum(found.inertia) == int(away.sum())


def test_later_rounds_rescan_few(spark, sf_dir):
    points = clumps(2000, 8)
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id long, embedding array<float>")
    found = centroids.cluster(frame, 6, 10, F.col("vec_id"), dimensions=8)
    assert found.rescanned[0] == 2000 and sum(found.rescanned[1:]) < 0.7 * 2000 * 10
    assert len(found.rescanned) < 11 or found.rescanned[-1] < 1000


def test_clusters_of_odd_rows(spark):
    points, frame = odd_vectors(spark)
    huge = spark.createDataFrame([(2000, [3e38] * 64, 0, "c", 1, "r"), (2001, [-3e38] * 64, 0, "c", 1, "r")], VECTORS)
    found = centroids.cluster(frame.union(huge), 4, 3, F.col("vec_id"))
    rows = found.vectors.collect()
    assert found.vectors.columns == ["vec_id", "embedding", "label", "__v", "cluster", "distance"]
    assert {r["__v"] for r in rows} == {"r", None}
    # 300, the zero vector, the two repeated rows, the one without ID, the two huge ones
    assert len(rows) == 306 and all(r["distance"] >= 0 for r in rows)
    nothing = centroids.cluster(frame.where("vec_id < 0"), 4, 3, F.col("vec_id"))
    assert nothing.vectors.count() == 0 and nothing.centroids == []


def test_cluster_query_against_brute_force(spark, sf_dir):
    rows = {r["vec_id"]: r for r in queries()["op12_heap_clusters"](spark, sf_dir).collect()}
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids = [r["vec_id"] for r in table]
    points = np.floor(np.array([r["embedding"] for r in table], dtype=float) * 1024).astype(np.int64)
    first = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"3:{ids[i]}".encode()).hexdigest())[:8]
    where, away, centres = lloyd(points, first, 10)
    for i, vec_id in enumerate(ids):
        r, c = rows[vec_id], int(where[i])
        assert (r["cluster"], r["distance"]) == (c, away[i])
        assert r["cluster_inertia"] == away[where == c].sum() and r["inertia"] == away.sum()
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
