"""Exports of a run: tables with fixed columns, artifacts with their pointers, checkpoints and manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.outcomes import deep_analysis, export_stem
from vigil.operators.reports import exploded, top_reasons
from vigil.sources.writers import to_schema, write_csv

#: The columns of the sinks, as they are written.
STAGE0 = (
    "input_position", "input_url", "normalized_url", "source_workbook", "lexical_hit", "strict_lexical_hit", "lexical_score_pass", "fallback_rank_only", "candidate_generation_reason", "stage0_match_reason", "stage0_final_score", "stage0_risk", "stage0_similarity_score",
    "stage0_brand_hits", "stage0_phishing_keyword_hits", "stage0_keyword_similarity_score", "best_entity", "best_matching_domain", "lexical_score", "typo_similarity", "generic_token_only_match", "dns_status", "dns_decision", "fetch_status", "fetch_error_type", "fetch_error_detail", "hash_shortlisted",
    "review_only", "reason", "final_status",
)
HASHED = (
    "run_id", "hashed_at_utc", "source_workbook", "export_workbook", "raw_url", "normalized_url", "final_landing_url", "domain", "final_domain", "hash_mode", "fetch_status", "visual_status", "fetch_error_type", "fetch_error_detail", "parking_provider", "parking_reason", "screenshot_path", "target_url_sha256",
    "favicon_hash_raw", "ssl_hash_raw", "html_hash_raw", "page_hash_raw", "domain_hash_raw", "best_entity", "best_matching_domain", "hash_score", "confidence_band", "score_margin", "lexical_score", "direct_brand_evidence_count", "deceptive_host_embedding", "content_spoof_strong", "favicon_hash_similarity",
    "favicon_hash_distance", "page_hash_similarity", "page_hash_distance", "domain_hash_similarity", "domain_hash_distance", "ssl_hash_similarity", "ssl_hash_distance", "signal_hit_favicon", "signal_hit_ssl_hash", "signal_hit_html_hash", "signal_hit_domain_hash", "hash_anchor", "admission_path", "review_reason",
)
REVIEW = ("Identified Phishing/Suspected Domain Name", "Cooresponding CSE", "Legitimate Domains", "review_reason")


def stage0_table(rows: DataFrame, path: str) -> None:
    write_csv(to_schema(rows, STAGE0), path)


def hash_exports(rows: DataFrame, path: str) -> None:
    """A folder for each workbook: a row of several workbooks is in each. Rebalanced, so that a hot workbook is written by many tasks."""
    each = exploded(rows.withColumn("source_workbook", F.coalesce(F.nullif(F.trim("source_workbook"), F.lit("")), F.lit("unknown_source"))), "source_workbook", "export_workbook")
    named = to_schema(each, HASHED).withColumn("export_stem", export_stem(F.col("export_workbook")))
    named.hint("rebalance", "export_stem").write.mode("overwrite").partitionBy("export_stem").option("header", True).csv(path)


def review_queue(rows: DataFrame, path: str) -> None:
    """The review queue; without rows its header."""
    write_csv(to_schema(rows, REVIEW), path)


def subsets(rows: DataFrame, path: str, conditions: Mapping[str, Column]) -> None:
    """A CSV for each condition's rows."""
    for name, condition in conditions.items():
        write_csv(rows.where(condition), f"{path}/{name}")


def method_artifacts(rows: DataFrame, path: str) -> None:
    """The first stage's rows with their steps to the deep analysis, the steps' counts, and the commonest reasons."""
    steps = deep_analysis(rows)
    write_csv(steps, f"{path}/methods")
    counts = [F.count("*").alias("rows"), *[F.count_if(c).alias(c) for c in ("deep_analysis_candidate", "deep_analysis_dns_accepted", "deep_analysis_attempted")]]
    write_csv(steps.agg(*counts), f"{path}/deep_analysis")
    write_csv(top_reasons(rows.where(F.trim("escalate_reason") != ""), "escalate_reason"), f"{path}/top_reasons")


def text_list(df: DataFrame, column: str, path: str) -> None:
    """The distinct values of a column in order, a line each."""
    df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct().orderBy("value").write.mode("overwrite").text(path)


def json_document(spark: SparkSession, path: str, content: Mapping) -> None:
    """A JSON document with sorted keys, written in one step."""
    text = json.dumps(content, sort_keys=True, separators=(",", ":"))
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))  # one small document


def publish(df: DataFrame, root: str, run_id: str, name: str) -> str:
    """Write an artifact once, under its run, and point `latest` at it; its path."""
    path = f"{root}/runs/{run_id}/{name}"
    write_csv(df, path)
    json_document(df.sparkSession, f"{root}/latest/{name}", {"run_id": run_id, "path": path})
    return path


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.option("header", True).csv(read_document(spark, f"{root}/latest/{name}")["path"])


def checkpoint(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str, manifest: Mapping) -> None:
    """Each of a run's tables (with its keys) in the order of its keys, then the manifest with their counts: a reader that finds it
    finds them all."""
    counts = {}
    for name, (df, keys) in tables.items():
        write_csv(df.orderBy(*keys), f"{path}/{name}")
        counts[name] = df.sparkSession.read.option("header", True).csv(f"{path}/{name}").count()
    spark = next(iter(tables.values()))[0].sparkSession
    json_document(spark, f"{path}/manifest", {**manifest, "rows": counts})


def newest_file(spark: SparkSession, folder: str, suffix: str) -> str | None:
    """The file of a folder that ends like this and was changed last."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getModificationTime(), str(s.getPath())) for s in (fs.listStatus(root) if fs.exists(root) else []) if s.getPath().getName().endswith(suffix)]
    return max(found)[1] if found else None
