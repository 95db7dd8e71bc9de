"""Keyed run state: latest rows, merged patches, deduplicated logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key: an aggregate with partial maxima, which a hot key doesn't bring into one task."""
    rest = [c for c in log.columns if c not in {*keys, *order}]
    top = log.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("m"))
    return top.select(*keys, *[F.col(f"m.{c}").alias(c) for c in [*order, *rest]])


def earliest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in log.columns if c not in {*keys, *order}]
    top = log.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("m"))
    return top.select(*keys, *[F.col(f"m.{c}").alias(c) for c in [*order, *rest]])


def merged(patches: DataFrame, keys: Sequence[str], order: Sequence[str], meaningful: dict[str, Column], flags: Sequence[str] = ()) -> DataFrame:
    """One row for each key: of each column the last meaningful value in order, of each flag whether it was ever set.

    patches are upserts; order is total. meaningful: column to the condition that its value counts.
    """
    rank = F.struct(*order)
    aggs = [F.max_by(F.when(ok, F.col(c)), F.when(ok, rank)).alias(c) for c, ok in meaningful.items()]
    return patches.groupBy(*keys).agg(*aggs, *[F.max(F.coalesce(F.col(f).cast("int"), F.lit(0))).alias(f) for f in flags], F.max(F.col(order[0])).alias("last_updated"))


def forward_fill(df: DataFrame, part: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def upsert_log(state: DataFrame, patches: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State with patches over it, columns missing on either side null: what foreachBatch applies to a table."""
    return latest(state.unionByName(patches, allowMissingColumns=True), keys, order)
