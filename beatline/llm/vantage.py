"""Nearest neighbours by vantage-point trees, one per shard of the vectors."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from beatline.session import staged

# Most vectors of a leaf, vectors of a shard, and queries that go through a tree side by side.
LEAF = 128
SHARD_VECTORS = 1 << 16
QUERY_BATCH = 512

_FOUND = "query long, vec_id long, score double"


@dataclass
class Tree:
    """A vantage-point tree over rows of a matrix, levels from the root down.

    ``vantage[i]`` is the row whose distances part node ``i``; its children's distances from it lie in ``[low, high]``.
    A node without children is a leaf of the rows ``rows[begin:end]``.
    """

    points: np.ndarray
    ids: np.ndarray
    vantage: list[int]
    children: list[tuple[int, int]]
    bounds: list[tuple[float, float, float, float]]
    leaves: dict[int, tuple[int, int]]


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components summed in order."""
    total = np.zeros((len(queries), len(points)))
    for a, b in zip(queries.T, points.T, strict=True):
        difference = a[:, None] - b[None, :]
        difference *= difference
        total += difference
    return np.sqrt(total, out=total)


def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
    """Nodes are halved by the distances from one of their points, so the tree is balanced whatever the distances are."""
    order = np.arange(len(points))
    tree = Tree(points, ids, [], [], [], {})
    waiting = [(0, len(points))]
    node = 0
    while node < len(waiting):
        begin, end = waiting[node]
        rows = order[begin:end]
        tree.vantage.append(-1)
        tree.children.append((-1, -1))
        tree.bounds.append((0.0, 0.0, 0.0, 0.0))
        if end - begin <= leaf:
            tree.leaves[node] = (begin, end)
        else:
            # of a few rows, the one that sees the others at the most different distances
            tried = rows[:: max(1, len(rows) // 8)][:8]
            seen = distances(points[tried], points[rows[:: max(1, len(rows) // 256)]])
            vantage = int(tried[seen.std(axis=1).argmax()])
            away = distances(points[[vantage]], points[rows])[0]
            sorting = np.argsort(away, kind="stable")
            order[begin:end], away = rows[sorting], away[sorting]
            half = len(rows) // 2
            tree.vantage[node] = vantage
            tree.children[node] = (len(waiting), len(waiting) + 1)
            tree.bounds[node] = (away[0], away[half - 1], away[half], away[-1])
            waiting += [(begin, begin + half), (begin + half, end)]
        node += 1
    tree.points, tree.ids = points[order], ids[order]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    tree.vantage = [int(place[v]) if v >= 0 else -1 for v in tree.vantage]
    return tree


def least_distances(tree: Tree, queries: np.ndarray) -> dict[int, np.ndarray]:
    """For each leaf the least distance that the triangle inequality leaves to its points, per query."""
    least = {0: np.zeros(len(queries))}
    found = {}
    for node, (near, far) in enumerate(tree.children):
        here = least.pop(node)
        if near < 0:
            found[node] = here
            continue
        away = distances(queries, tree.points[[tree.vantage[node]]])[:, 0]
        a, b, c, d = tree.bounds[node]
        least[near] = np.maximum(here, np.maximum(a - away, away - b))
        least[far] = np.maximum(here, np.maximum(c - away, away - d))
    return found


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, int]:
    """IDs and distances of the ``k`` nearest points found for each query, nearest first, ties to smaller IDs.

    Points with the query's own ID are no candidates; missing places have an infinite distance.  A leaf is left out where
    ``factor`` times its least distance is above the distance of the ``k``-th found so far: with factor 1 that loses nothing, a
    larger one looks into fewer leaves.  The last value is the number of distances taken in leaves.
    """
    least = least_distances(tree, queries)
    score = np.full((len(queries), k), math.inf)
    named = np.full((len(queries), k), np.iinfo(np.int64).max)
    numbers = sorted(least)
    bounds = np.array([least[node] for node in numbers])
    home = bounds.argmin(axis=0)
    # rounding must not cut off a point at just the k-th distance
    bounds = bounds * (factor * (1 - 1e-9)) - 1e-12
    looked = 0

    def look(leaf: int, active: np.ndarray) -> None:
        nonlocal looked
        begin, end = tree.leaves[numbers[leaf]]
        away = distances(queries[active], tree.points[begin:end])
        looked += away.size
        at = tree.ids[begin:end]
        away[ids[active][:, None] == at[None, :]] = math.inf
        better = np.flatnonzero(((away <= score[active, -1:]) & (away < math.inf)).any(axis=1))
        if not len(better):
            return
        rows = active[better]
        all_scores = np.concatenate([score[rows], away[better]], axis=1)
        all_named = np.concatenate([named[rows], np.broadcast_to(at, (len(rows), len(at)))], axis=1)
        first = np.lexsort((all_named, all_scores), axis=1)[:, :k]
        score[rows] = np.take_along_axis(all_scores, first, axis=1)
        named[rows] = np.take_along_axis(all_named, first, axis=1)

    for leaf in np.unique(home):
        look(int(leaf), np.flatnonzero(home == leaf))
    for leaf in range(len(numbers)):
        active = np.flatnonzero((bounds[leaf] <= score[:, -1]) & (home != leaf))
        if len(active):
            look(leaf, active)
    return named, score, looked


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dimensions)


def _answers(k: int, factor: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard and length, vectors before queries: the tree of one shard is built, then asked, then forgotten."""
    shard, parts, tree = None, [], None
    for batch in batches:
        keys = np.column_stack(
            [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "dimensions", "asks")]
        )
        edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        for begin, end in zip([0, *edges], [*edges, len(keys)]):
            if begin == end:
                continue
            where, dimensions, asks = keys[begin].tolist()
            if shard != (where, dimensions):
                shard, parts, tree = (where, dimensions), [], None
            for start in range(begin, end, QUERY_BATCH if asks else max(1, end - begin)):
                rows = batch.slice(start, min(end - start, QUERY_BATCH) if asks else end - begin)
                matrix = _matrix(rows.column("vector"), dimensions)
                ids = rows.column("vec_id").to_numpy(zero_copy_only=False)
                if not asks:
                    parts.append((matrix, ids))
                    continue
                if tree is None:
                    if not parts:
                        continue
                    tree, parts = build(*(np.concatenate(x) for x in zip(*parts, strict=True))), []
                named, score, _ = search(tree, ids, matrix, k, factor)
                asked = np.repeat(rows.column("query").to_numpy(zero_copy_only=False), k)
                known = np.isfinite(score.ravel())
                arrays = [asked[known], named.ravel()[known], score.ravel()[known]]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query", "vec_id", "score"])


def usable(vectors: DataFrame, vector: str = "embedding") -> Column:
    """Whether a vector is there, not zero, and without NULL and non-finite components."""
    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))

    return F.col(vector).isNotNull() & F.forall(vector, sound) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    asking: Column,
    k: int = 10,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shards: int | None = None,
    shard_vectors: int = SHARD_VECTORS,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): of each row where ``asking`` holds, the ``k`` nearest other rows found.

    Every vector is in one shard, by a digest of its row, so no shard is larger than others whatever the vectors are.  A shard
    is one stream of rows to one task: first its vectors, of which the tree is made, then all queries, some hundred at a time.
    A tree's nodes are halved by the distance to a vantage point; a leaf is passed over where the triangle inequality,
    times ``factor``, shows that its points are farther than the ``k``-th found.  Factor 1 is exact search.  The
    ``k`` best of each shard are then ranked per query.  ``shards`` grow with the vectors, ``shard_vectors`` at most in each; there
    are as many as the cluster has cores if that leaves 1 024 in each.  With factor 1 the result does not depend on them.

    Distances are Euclidean, in double precision on the given vectors, components summed in order; ties go to the smaller ID.
    Vectors that are NULL, zero, or hold a NULL or non-finite component, and rows without an ID take no part.  Only
    vectors with as many components as the query are its candidates.  Rows with the query's ID are not; of rows with
    one ID that ask, each asks for itself under that ID.  Without other rows a query has no result; an empty table gives an empty one.
    """
    kept = vectors.where(usable(vectors, vector) & F.col(key).isNotNull())
    # written once: the numbers of the rows must not change when a task is repeated
    kept = staged(
        kept.select(
            F.col(key).cast("long").alias("vec_id"),
            F.col(vector).alias("vector"),
            F.size(vector).alias("dimensions"),
            F.coalesce(asking, F.lit(False)).alias("asking"),
            F.monotonically_increasing_id().alias("query"),
        ),
        "vectors",
    )
    n = kept.count()
    if shards is None:
        cores = vectors.sparkSession.sparkContext.defaultParallelism
        shards = max(math.ceil(n / shard_vectors), min(cores, math.ceil(n / 1024)), 1)
    shard = F.pmod(F.xxhash64("query"), F.lit(shards)).cast("int")
    columns = ["vec_id", "vector", "dimensions", "query"]
    held = kept.select(*columns, shard.alias("shard"), F.lit(0).alias("asks"))
    asked = kept.where("asking").select(
        *columns, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks")
    )
    streams = held.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "dimensions", "asks", "query")
    found = streams.mapInArrow(lambda batches: _answers(k, factor, batches), _FOUND)
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    queries = kept.where("asking").select("query", F.col("vec_id").alias("query_id"))
    return ranked.join(queries, "query").select("query_id", "rank", "vec_id", "score")
