"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is an aggregation (combined before its shuffle) and a join with its one row per node, so a node with very many
links is no unbounded group: adaptive execution splits that join's large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("a").alias("w")).agg(F.min("b").alias("m"))
    joined = links.join(least, F.col("a") == F.col("w"))
    return (
        joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), two columns of one orderable type: root is the smallest
    node that can be reached. Links of a node with itself count for nothing; nodes that are roots are not listed."""
    state = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or not mark["n"]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        state = written(_small_star(_large_star(state)), "links")
