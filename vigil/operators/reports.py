"""Summaries, funnels, rankings and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.text import pipe_list


def run_summary(df: DataFrame, status: str, decision: str) -> DataFrame:
    """Counts by status, by decision, and in all, in one pass (grouping sets)."""
    return df.groupingSets([[status], [decision], []], status, decision).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row: how many rows each stage's condition keeps."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in stages.items()])


def ranked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """df with rank 1..n in a total order: a report over summaries, few by nature."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def numbered(df: DataFrame, column: str, out: str, ranges: int = 200) -> DataFrame:
    """df with out, the place (1..n) of each row in the order of a number. Ranges of about as many rows are numbered apart, and what
    stands before each is added: no task gets all rows."""
    edges = df.agg(F.percentile_approx(column, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    part = F.size(F.filter(F.array(*map(F.lit, sorted(set(edges)))), lambda e: e <= F.col(column))) if edges else F.lit(0)
    dealt = df.withColumn("__part", part)
    before, offsets = 0, []
    for r in sorted(dealt.groupBy("__part").agg(F.count("*").alias("n")).collect(), key=lambda r: r["__part"]):  # a row a range
        offsets += [F.lit(r["__part"]), F.lit(before)]
        before += r.n
    if not offsets:
        return df.withColumn(out, F.lit(None).cast("long"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(column))
    return dealt.withColumn(out, (place + F.element_at(F.create_map(*offsets), F.col("__part"))).cast("long")).drop("__part")


def exploded(df: DataFrame, column: str, out: str) -> DataFrame:
    """A row for each distinct item of a list joined by '|': what a partitioned export writes."""
    return df.withColumn(out, F.explode(pipe_list(F.col(column))))


def newest(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    return df.withColumn("age_rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("age_rank") <= k)


def overlay(base: DataFrame, over: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """base with columns taken from over where it has them."""
    o = over.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__o_{c}") for c in columns])
    joined = base.join(o, F.col(key) == F.col("__k"), "left")
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(F.col(f"__o_{c}"), F.col(c)))
    return joined.drop("__k", *[f"__o_{c}" for c in columns])


def top_reasons(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)
