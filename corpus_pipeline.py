"""A training corpus from documents: language ID, near-duplicate removal, mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import langid, mixing, neardup, packing
from vigil.llm.common import partitions, shared, stash

#: A document is rejected if it has no letters, or if the best language is this unsure.
LEAST_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without text or letters, or of no one language, go. Repeated rows are judged alike."""
    model = langid.fit(docs.where(~langid.held_out()))
    # the documents' own columns of these names are kept
    own = {c: f"__own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = langid.predict(docs.withColumnsRenamed(own), model).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.drop("lang_pred", "score").withColumnsRenamed({v: c for c, v in own.items()}).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8): that with the least doc_id.

    A document is a doc_id with a text: rows equal in both are one, and different texts under one doc_id are judged apart. Rows
    without doc_id come last, and of those with equal texts one stays.
    """
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count():
        found = neardup.near_duplicates(docs, width=5, percent=80)
        return docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    # keys in the order of doc_id, as the least one is kept
    order = [F.col("__id").asc_nulls_last(), F.col("__hash")]
    pairs = docs.select(F.col("doc_id").alias("__id"), F.sha2("text", 256).alias("__hash")).distinct()
    keys = stash(pairs.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("__key", F.monotonically_increasing_id()))
    keyed = stash(docs.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & F.sha2("text", 256).eqNullSafe(F.col("__hash"))).select(*docs.columns, "__key"))
    found = neardup.near_duplicates(keyed, width=5, percent=80, id_col="__key")
    copies = found.where(~F.col("kept")).select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(copies, "__key", "left_anti").dropDuplicates(["__key"]).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources have their target weights, see mixing.mix(): rows without source are a source of their own, rows
    without words take no part in the weights, repeated rows are drawn alike, no rows give no rows."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, see packing.pack(): null and empty texts are one token, repeated rows are
    packed each, no rows give no rows."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", identified), ("near_dedup", deduplicated), ("mixing", mixed), ("packing", packed)]
#: SQL can't express the language model or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared checkpoint folder and read again."""
    shared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
