"""Connected components by alternating large-star and small-star steps.

The edge list never leaves the cluster; each round is written to the shared
folder, so a lost executor costs one round at most. Joins are plain shuffle
joins against a per-node minimum (aggregated map-side first), which adaptive
execution can split when one node has a very large degree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node long, root long), root the smallest node.

    Self-loops are ignored; nodes without an edge to another node do not occur in
    the result. An empty edge list gives an empty result.
    """
    edges = materialize(edges.where("a != b").select("a", "b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(b as decimal(38,0)))")
        ).first()
        if tuple(now) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
