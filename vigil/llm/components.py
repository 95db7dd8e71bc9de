"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stash


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges(u, v): root is the least node of its component.

    Large-star and small-star rounds: each node's neighbours are linked to the least of them, on their greater side and on
    their lesser side by turns, until nothing changes, which takes about the logarithm of the longest chain. Minima
    have partial sums before the shuffle, and joins of a hub's edges are left to adaptive execution to split. Each round
    is written to the checkpoint folder. No edge, or component, comes to the driver.
    """
    now = stash(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("x"), F.least("u", "w").alias("w"))
        large = both.join(least, F.col("u") == F.col("x")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("w").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("w")).withColumnRenamed("u", "x")
        small = large.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("w").alias("v")).union(least.select(F.col("x").alias("u"), F.col("w").alias("v"))).where("u != v").distinct()
        now = stash(small)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(now.select("v", F.col("v").alias("root")).distinct())
