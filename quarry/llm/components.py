"""Connected components of an edge table by alternating stars.

Each round rewires edges towards smaller neighbours (large star: a node's
greater neighbours to its least one; small star: a node and its lesser
neighbours to the least) until every node points at its component's least
node.  Rounds are joins and partial aggregations over the edges, written
to the shared folder; only the number of edges that changed comes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every edge of ``edges`` has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int, int]:
    """Number of edges and two sums of their hashes: equal for equal sets."""
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64("b", "a", F.lit(1))), F.lit(0))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): of every node that has an edge to another in
    ``edges`` (a, b; of any one ordered type), the least node that it can
    reach.  Loops, repeated edges and nulls are ignored."""
    now = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    state = _state(now)
    while state[0]:
        now = written(_small(_large(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    least = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least)
