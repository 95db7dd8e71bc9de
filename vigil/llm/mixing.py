"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import n_words, stash, tables


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 to 1 by a hash of the seed and the document's id, without id of its text: equal in every rerun."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def targets(sources: DataFrame, limit: int = 3) -> DataFrame:
    """sources(source, source_size) with target.

    Weights 1, 2, 3, repeating, in the order of the sources' code points, null last, share all sizes; no target exceeds
    limit times its source's size, and what is over goes to the others by weight until none is above. That ends where
    every source has the lesser of its limit and weight times one common level: with the sources in the order of
    limit / weight, the first ones have their limits and the others share what these leave.
    One row per source goes through one task: a source's name and three numbers.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    level = F.col("left") / F.col("weight_left")
    return (
        sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("cap", F.lit(limit) * F.col("source_size"))
        .withColumn("left", F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("full", F.col("cap") <= F.col("weight") * level)
        .withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(1)).over(by_room.rowsBetween(Window.unboundedPreceding, 0)))
        # the first source that isn't filled sets the level for itself and all after it
        .withColumn("left", F.first(F.when(F.col("open") > 0, F.col("left")), True).over(by_room.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("weight_left", F.first(F.when(F.col("open") > 0, F.col("weight_left")), True).over(by_room.rowsBetween(Window.unboundedPreceding, 0)))
        .select("source", "source_size", F.when(F.col("open") == 0, F.col("cap").cast("double")).otherwise((F.col("weight") * F.col("left")).cast("double") / F.col("weight_left")).alias("target"))
    )


#: Sources whose rates are broadcast at most: about 50 bytes each. More are joined by shuffle.
MOST_BROADCAST = 200_000


def rates(sized: DataFrame, limit: int = 3) -> DataFrame:
    """(__s, __source_size, __target, __rate) for sized(source, size): a row for each source."""
    found = stash(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), limit))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    out = found.select(F.col("source").alias("__s"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), rate.alias("__rate"))
    return F.broadcast(out) if found.count() <= MOST_BROADCAST else out


def drawn(variate: Column, rate: Column) -> Column:
    """Copies of a document: floor(rate), and one more with the rate's fraction as its probability."""
    return (F.floor(rate) + (variate < rate - F.floor(rate)).cast("long")).cast("long")


def copies(docs: DataFrame, *, seed: int = 11, limit: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of each row of docs(doc_id, text, source): what mix() does with it.

    Tokens are summed per source, then a source's rate is target / source_size, and each of its documents is emitted
    floor(rate) times plus one Bernoulli copy with the rate's fraction as probability. The draw is by a hash of the seed and
    doc_id alone, so it doesn't depend on other documents. What is taken comes near the target as the source grows: its
    standard deviation is at most half the root of the sum of the squared sizes.

    Null text has size 0; null is a source of its own; a source without words takes nothing (rate 0); rows with equal
    doc_id share their draw; rows without doc_id are drawn by their texts; no rows give no rows; other columns are ignored.
    The texts are read once; 4 short columns a document are written to the checkpoint folder. Partial sums before the
    shuffle take a source that holds a third of all rows; the rates are broadcast if they are few, else a join is left to
    adaptive execution to split.
    """
    base = stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), uniform(F.col("doc_id").cast("long"), F.col("text"), seed).alias("__u")))
    joined = base.join(rates(base, limit), F.col("source").eqNullSafe(F.col("__s"))).withColumn("copies", drawn(F.col("__u"), F.col("__rate")))
    return joined.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, *, seed: int = 11, limit: int = 3) -> DataFrame:
    """The rows of docs, all columns, each as often as copies() says."""
    free = "__"
    while any(c.startswith(free) for c in docs.columns):  # names that the documents' own columns don't have
        free += "_"
    sized = docs.select(F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    found = rates(sized, limit).select(F.col("__s").alias(f"{free}s"), F.col("__rate").alias(f"{free}rate"))
    n = drawn(uniform(F.col("doc_id").cast("long"), F.col("text"), seed), F.col(f"{free}rate")).cast("int")
    return docs.join(found, F.col("source").cast("string").eqNullSafe(F.col(f"{free}s"))).withColumn(f"{free}copy", F.explode(F.array_repeat(F.lit(0), n))).select(*docs.columns)


def op4(spark, sf_dir: str) -> DataFrame:
    return copies(tables(spark, sf_dir, "documents")).drop("copies")


SQL = r"""
WITH base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 12) AS BIGINT) / 281474976710656.0 AS u
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sizes),
levels AS (
  SELECT *, (SELECT sum(source_size) FROM sizes) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM ranked),
filled AS (SELECT *, cap <= weight * (open_words / open_weight) AS is_full FROM levels),
level AS (SELECT open_words, open_weight FROM filled WHERE NOT is_full ORDER BY cap / weight, source NULLS LAST LIMIT 1),
rates AS (
  SELECT f.source, f.source_size,
         CASE WHEN l.open_weight IS NULL OR f.cap <= f.weight * (CAST(l.open_words AS DOUBLE) / CAST(l.open_weight AS DOUBLE)) THEN CAST(f.cap AS DOUBLE)
              ELSE CAST(f.weight * l.open_words AS DOUBLE) / CAST(l.open_weight AS DOUBLE) END AS target
  FROM filled f LEFT JOIN level l ON true),
plan AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate FROM rates)
SELECT b.doc_id, b.size, p.source_size, p.target, CAST(b.size * (floor(p.rate) + CASE WHEN b.u < p.rate - floor(p.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source
"""
