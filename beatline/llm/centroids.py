"""Exact centroid clustering in which each round rescans only the vectors whose bounds have run out."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beatline.session import Staging, staged

# Components beyond this are taken as this, so that squared distances and sums stay whole 64-bit numbers.
LARGEST = 1 << 27

# Runs of a queue that are read side by side before they are put together.
MOST_RUNS = 12


@dataclass
class Clustering:
    """The vectors with ``cluster`` and ``distance`` (squared), and of each cluster its centroid and sum of distances."""

    vectors: DataFrame
    centroids: list[list[int]]
    inertia: list[int]
    rescanned: list[int]


def whole_vectors(vectors: DataFrame, vector: str, dimensions: int, scale: int) -> DataFrame:
    """Rows whose ``vector`` has just ``dimensions`` components, none NULL or non-finite, with ``__v`` = floor(scale * x)."""

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))

    def whole(x: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
        return scaled.cast("int")

    kept = vectors.where((F.size(vector) == dimensions) & F.forall(vector, sound))
    return kept.withColumn("__v", F.transform(vector, whole))


def _matrix(rows: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return rows.column("__v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows.num_rows, dimensions)


def _nearest(matrix: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid (the first of equally near), and the next squared distance."""
    squared = np.empty((len(matrix), len(centroids)), dtype=np.int64)
    for c, centroid in enumerate(centroids):
        difference = matrix - centroid
        squared[:, c] = np.einsum("ij,ij->i", difference, difference)
    best = squared.argmin(axis=1)
    least = squared[np.arange(len(matrix)), best]
    if len(centroids) == 1:
        return best, least, np.full(len(matrix), np.iinfo(np.int64).max)
    squared[np.arange(len(matrix)), best] = np.iinfo(np.int64).max
    return best, least, squared.min(axis=1)


def _rescan(
    centroids: np.ndarray, drifted: np.ndarray, names: list[str], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Assign vectors anew; ``__key`` is the drift of its cluster at which a vector's bounds run out."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            rows = batch.slice(begin, 4096)
            best, least, second = _nearest(_matrix(rows, centroids.shape[1]), centroids)
            upper, lower, so_far = np.sqrt(least), np.sqrt(second), drifted[best]
            # the margin is above any rounding; a vector is never asked for again before the next drift
            key = so_far + (lower - upper) - 1e-9 * (lower + upper + so_far + 1.0)
            key = np.maximum(key, np.nextafter(so_far, np.inf))
            was = rows.column("__cluster")
            made = {"__was": was, "__cluster": pa.array(best.astype(np.int32)), "__key": pa.array(key)}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else rows.column(n) for n in names], names)


def _moves(k: int, dimensions: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the moved vectors of a task add to each cluster and take from it: components, then the count."""
    total = np.zeros((k, dimensions + 1), dtype=np.int64)
    for batch in batches:
        matrix = np.column_stack([_matrix(batch, dimensions), np.ones(batch.num_rows, dtype=np.int64)])
        now = batch.column("__cluster").to_numpy(zero_copy_only=False)
        was = batch.column("__was").to_numpy(zero_copy_only=False)
        np.add.at(total, now, matrix)
        np.subtract.at(total, was[was >= 0], matrix[was >= 0])
    for cluster in np.flatnonzero(total.any(axis=1)).tolist():
        at = pa.array(np.arange(dimensions + 1, dtype=np.int32))
        number = pa.array(np.full(dimensions + 1, cluster, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([number, at, pa.array(total[cluster])], ["cluster", "at", "value"])


def _between(low: np.ndarray | None, high: np.ndarray | None, k: int) -> Column:
    """Keys above ``low`` and up to ``high`` of their cluster; the scan skips files and pages by it."""
    found = F.lit(False)
    for c in range(k):
        part = F.col("__cluster") == c
        if low is not None:
            part = part & (F.col("__key") > F.lit(float(low[c])))
        if high is not None:
            part = part & (F.col("__key") <= F.lit(float(high[c])))
        found = found | part
    return found


def cluster(
    vectors: DataFrame, k: int, rounds: int, order: Column, vector: str = "embedding", dimensions: int = 64, scale: int = 1024
) -> Clustering:
    """Lloyd's algorithm on whole numbers: ``k`` clusters after ``rounds`` rounds and one more assignment.

    Vectors become floor(scale * x).  The first centroids are the ``k`` vectors that are first by ``order`` (all, if there are
    fewer).  A vector belongs to the nearest centroid by squared distance, of equally near ones to the first; a centroid
    becomes the floor of its vectors' mean, an empty one stays.

    A vector need not be looked at while the centroids have drifted less than the gap between its distances to the nearest and
    to the next centroid.  Each cluster has a queue of its vectors, ordered by the accumulated drift (its own and the
    largest other one, summed over the rounds) at which the gap closes.  So one number per cluster ages the whole queue,
    and a round takes only the vectors from its head whose gap has closed, computes their distances exactly, and
    puts them into the queues of their clusters again.  Sums of clusters change by the moved vectors only.

    A queue is a heap that outlives the tasks: runs in the shared folder, each written by one round and ordered by cluster and
    key (an ordered run is a heap with its head first), so that taking from the head is a range of keys in each run,
    which the scan cuts out by the statistics of files and pages; what was taken is below the accumulated drift and so
    gone.  When there are many runs, or more gone than left in them, what is left is written as one.  A lost task repeats its part of a round.
    Vectors are not shuffled, so it does not matter how large one cluster is.  To the driver come sums: ``k`` times
    ``dimensions`` numbers a round, and the first ``k`` vectors.

    Vectors of another length, or with a NULL or non-finite component, are left out; components beyond 2^27 after
    scaling count as that.  Repeated rows and rows without an ID are vectors as any other.  An empty table gives an empty one.
    ``cluster`` and ``distance`` replace columns of these names.
    """
    spark = vectors.sparkSession
    staging = Staging(spark)
    columns = [c for c in vectors.columns if c.lower() not in ("cluster", "distance")]
    # under names that clash with nothing until the end
    own = {f"c{i}": c for i, c in enumerate(columns)}
    plain = [F.col(f"`{c}`").alias(name) for name, c in own.items()]
    start = vectors.select(*plain, F.col(vector).alias("__vector"), order.alias("__order"))
    start = whole_vectors(start, "__vector", dimensions, scale).drop("__vector")
    first = start.select("__order", "__v").orderBy("__order", "__v").limit(k).collect()
    named = start.select(*own, "__v", F.lit(-1).alias("__cluster"))
    out = named.withColumn("__was", F.lit(-1)).withColumn("__key", F.lit(0.0))
    names, schema = out.columns, out.schema
    if not first:
        return Clustering(_assigned(out.where(F.lit(False)), own, []), [], [], [])
    k = len(first)
    centroids = np.array([row["__v"] for row in first], dtype=np.int64)
    sums = np.zeros((k, dimensions + 1), dtype=object)
    drifted, before = np.zeros(k), np.zeros(k)
    runs: dict[str, int] = {}  # with their rows
    expired, rescanned, queues = named, [], None
    for turn in range(rounds + 1):
        moved = expired.mapInArrow(
            lambda batches, centroids=centroids, drifted=drifted: _rescan(centroids, drifted, names, batches), schema
        )
        name = f"queue-{turn}"
        staging.write(moved.sortWithinPartitions("__cluster", "__key"), name)
        made = spark.read.schema(schema).parquet(staging.paths[name])
        rescanned.append(made.count())
        if len(runs) >= MOST_RUNS or sum(runs.values()) > 2 * rescanned[0]:
            old = list(runs)
            left = staging.write(queues.where(_between(drifted, None, k)).sortWithinPartitions("__cluster", "__key"), f"left-{turn}")
            runs = {f"left-{turn}": left.count()}
            staging.drop(*old)
        runs[name] = rescanned[-1]
        if turn == rounds:
            break
        parts = made.where(F.col("__cluster") != F.col("__was")).mapInArrow(
            lambda batches: _moves(k, dimensions, batches), "cluster int, at int, value bigint"
        )
        for row in parts.groupBy("cluster", "at").agg(F.sum("value").alias("value")).collect():
            sums[row["cluster"], row["at"]] += row["value"]
        moved_to = centroids.copy()
        for c in range(k):
            if sums[c, dimensions]:
                moved_to[c] = [int(total) // int(sums[c, dimensions]) for total in sums[c, :dimensions]]
        if (moved_to == centroids).all():
            break  # no bound runs out any more
        drift = np.sqrt(((moved_to - centroids).astype(float) ** 2).sum(axis=1)) * (1 + 1e-12)
        others = np.array([max([*drift[:c], *drift[c + 1 :]], default=0.0) for c in range(k)])
        before, drifted, centroids = drifted, drifted + drift + others, moved_to
        queues = spark.read.schema(schema).parquet(*(staging.paths[r] for r in runs))
        expired = queues.where(_between(before, drifted, k))
    queues = spark.read.schema(schema).parquet(*(staging.paths[r] for r in runs))
    result = staged(_assigned(queues.where(_between(drifted, None, k)), own, centroids.tolist()), "clustered")
    staging.drop(*runs)
    inertia = [0] * k
    for row in result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect():
        inertia[row["cluster"]] = int(row["n"])
    return Clustering(result, centroids.tolist(), inertia, rescanned)


def _assigned(rows: DataFrame, own: dict[str, str], centroids: list[list[int]]) -> DataFrame:
    """The given columns with cluster and squared distance."""
    known = F.array(*(F.array(*(F.lit(x).cast("long") for x in centroid)) for centroid in centroids))
    if not centroids:
        known = F.array().cast("array<array<bigint>>")
    squares = F.zip_with("__v", known[F.col("__cluster")], lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.select(
        *(F.col(name).alias(c) for name, c in own.items()), F.col("__cluster").alias("cluster"), distance.alias("distance")
    )
