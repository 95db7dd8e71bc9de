"""Weighted signals, margins, confidence bands and admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_score(signals: dict[str, tuple[float, Column, Column]]) -> Column:
    """100 * sum of numerators / sum of weights over the active signals; signals: weight, active, similarity."""
    active = sum((F.when(on, w).otherwise(0.0) for w, on, _ in signals.values()), F.lit(0.0))
    reached = sum((F.when(on, w * s).otherwise(0.0) for w, on, s in signals.values()), F.lit(0.0))
    return F.when(active > 1e-8, 100 * reached / active).otherwise(0.0)


def keyword_part(n: Column) -> Column:
    """Points for so many risk keywords."""
    return F.when(n > 0, F.least(F.lit(25), 8 + 6 * (n - 1))).otherwise(0)


def anchor(anchors: list[Column], hits: list[Column]) -> Column:
    """Any anchor, or at least two hits."""
    any_anchor = anchors[0]
    for a in anchors[1:]:
        any_anchor = any_anchor | a
    return any_anchor | (sum((h.cast("int") for h in hits), F.lit(0)) >= 2)


def confidence_band(score: Column, high: float = 78, medium: float = 68) -> Column:
    return F.when(score >= high, "High").when(score >= medium, "Medium").otherwise("Low")


def evidence_tier(given: Column, lexical: Column, hashed: Column) -> Column:
    """A valid given tier, else strong if both kinds of evidence are there."""
    text = F.lower(F.trim(given))
    return F.when(text.isin("strong_evidence", "weak_evidence"), text).when(lexical & hashed, "strong_evidence").otherwise("weak_evidence")


def margins(scores: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """(key, best, second, margin) of the two greatest scores of each key."""
    order = Window.partitionBy(key).orderBy(F.desc(score), tie)
    ranked = scores.withColumn("r", F.row_number().over(order)).where("r <= 2")
    best, second = F.max(F.when(F.col("r") == 1, F.col(score))), F.coalesce(F.max(F.when(F.col("r") == 2, F.col(score))), F.lit(0.0))
    return ranked.groupBy(key).agg(best.alias("best"), second.alias("second")).withColumn("margin", F.round(F.col("best") - F.col("second"), 6))


def admission(df: DataFrame, score: Column, threshold: float, strict: Column, passed: Column, anchored: Column, weak: Column, network: Column, parked: Column) -> DataFrame:
    """df with admitted, review_only, admission_reason (paths in order, joined by '|') and review_reason."""
    survivor = strict | passed
    paths = F.array_compact(F.array(
        F.when(score >= threshold, "score_threshold"), F.when(anchored, "hash_bypass_hit"), F.when(survivor & weak, "weak_direct_evidence"),
        F.when(survivor & network, "network_corroboration"), F.when(survivor & parked, "parked_sale_signal"),
    ))
    review = (F.size("__paths") == 0) & survivor
    return (
        df.withColumn("__paths", paths)
        .withColumn("admitted", F.size("__paths") > 0)
        .withColumn("review_only", review)
        .withColumn("admission_reason", F.array_join("__paths", "|"))
        .withColumn("review_reason", F.when(review & strict, "strict_lexical_below_holdout_threshold").when(review, "lexical_score_pass_below_holdout_threshold").otherwise(""))
        .drop("__paths")
    )
