"""Connected components of a graph given as edges."""

from pyspark.sql import DataFrame, functions as F

from beatline.session import Staging


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``): each node of an edge with the smallest node of its component.

    Every node takes the smallest root among its neighbours and then the root of that root, until no root changes; the
    second step halves the way to go, so the rounds are few.  Each round is a written table.  Loops are fine and
    NULLs must not occur; no edge gives no row.
    """
    staging = Staging(edges.sparkSession)
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("near"))
    both = staging.write(both.union(both.select("near", "node")).distinct(), "edges")
    roots = staging.write(both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("near"), "root"), "near")
        least = near.groupBy("node").agg(F.min("root").alias("near_root"))
        closer = roots.join(least, "node").select("node", "root", F.least("root", "near_root").alias("closer"))
        # a root is a node and has a root itself
        jumps = roots.select(F.col("node").alias("closer"), F.col("root").alias("jump"))
        moved = closer.join(jumps, "closer").select("node", "root", F.least("closer", "jump").alias("moved"))
        moved = staging.write(moved, "roots")
        changed = not moved.where(F.col("root") != F.col("moved")).isEmpty()
        roots = moved.select("node", F.col("moved").alias("root"))
        if not changed:
            staging.drop("edges")
            return roots
