"""Connected components of a graph given as edges, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.sources.snapshot import stage_table


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node of its component.

    In every round each remaining root takes the smallest root next to it, twice over, and the
    edges are rewritten to roots; equal and inner edges fall away, so the edge table shrinks. Each
    round is written, so a lost executor costs one round, and nothing but one flag reaches the
    driver. Self-loops give a node that is its own root; NULL ends are dropped.
    """
    edges = edges.select("a", "b").dropna()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage_table(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), name
    )
    left = _rewritten(edges, labels, name)
    for _ in range(rounds):
        if left.isEmpty():
            return labels
        hook = stage_table(
            left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("next")), f"{name}-hook"
        )
        onward = hook.select(F.col("node").alias("next"), F.col("next").alias("last"))
        hook = stage_table(
            hook.join(onward, "next", "left").select("node", F.coalesce("last", "next").alias("to")),
            f"{name}-jump",
        )
        labels = stage_table(
            labels.join(hook.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            name,
        )
        left = _rewritten(left, hook.select("node", F.col("to").alias("root")), name)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _rewritten(edges: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Distinct edges between different roots, the smaller one first."""
    of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = edges.join(of_a, "a", "left").join(of_b, "b", "left")
    ra, rb = F.coalesce("ra", "a"), F.coalesce("rb", "b")
    ends = ends.select(F.least(ra, rb).alias("a"), F.greatest(ra, rb).alias("b"))
    return stage_table(ends.where("a < b").distinct(), f"{name}-edges")
