"""Frontier expansion over a stored link graph (breadth-first).

The reference follows links while fetching, up to a depth limit.  Here
the pages are already stored; the walk is a bounded loop of
``frontier ⋈ edges`` joins with an anti join against everything visited,
so a node is reached once, at its smallest depth, and cycles end.  Each
round's new frontier is written as a table in the shared checkpoint
folder (``spark.checkpoint.dir``), so lineage stays one round deep and a
lost executor only recomputes one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def bfs(seeds: DataFrame, edges: DataFrame, max_depth: int = 5,
        node: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes reachable from ``seeds`` within ``max_depth`` hops, with the
    smallest depth (seeds have depth 0).

    ``seeds`` has column ``node``; ``edges`` has ``src`` and ``dst``.
    """
    # The edge list is read by every round: materialise it once.
    e = materialize(edges.select(F.col(src).alias("__src"), F.col(dst).alias("__dst")).distinct(), "edges")
    visited = materialize(seeds.select(F.col(node).alias("node")).distinct().withColumn("depth", F.lit(0)),
                          "frontier")
    frontier = visited
    for d in range(1, max_depth + 1):
        nxt = (
            frontier.join(e, frontier["node"] == e["__src"])
            .select(F.col("__dst").alias("node"))
            .distinct()
            .join(visited.select("node"), "node", "left_anti")
            .withColumn("depth", F.lit(d))
        )
        nxt = materialize(nxt, "frontier")
        # Parquet footers hold the row count: no scan of the data.
        if nxt.count() == 0:
            break
        # A union of checkpointed pieces: lineage stays one scan per round.
        visited = visited.unionByName(nxt)
        frontier = nxt
    return visited
