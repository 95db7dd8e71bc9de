"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

U64 = np.uint64
_A, _B, _C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def shared(spark: SparkSession) -> None:
    """Make sure that checkpoints have a folder: the cluster's spark.checkpoint.dir, or where that is unset and everything runs on one
    machine, as in tests, one of our own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="vigil-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def stash(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder; a lost executor doesn't lose it."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def freed(spark: SparkSession) -> None:
    """Have the files of shuffles that no DataFrame needs any more removed; else they stay until the driver happens to collect its garbage."""
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of a bounded size: some texts are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the filter of only(): 131,072 words of 64 bits, 2 MB at most to broadcast.
MASK = 1 << 23


def only(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key (a long) may be the one column of ids: those that a Bloom filter of a fixed size lets through.

    It is to save a shuffle the rows that its join will drop anyway. With many more ids than bits it lets all rows through.
    """
    (name,) = ids.columns
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(MASK))
    words = ids.select(place(name).alias("__p")).groupBy(F.expr("__p div 64").alias("__w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__p % 64 as int))")).alias("__bits"))
    there = df.withColumn("__q", place(key)).join(F.broadcast(words), F.expr("__q div 64") == F.col("__w"))
    return there.where(F.call_function("getbit", F.col("__bits"), (F.col("__q") % 64).cast("int")) == 1).drop("__q", "__w", "__bits")


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; None has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair."""
    with np.errstate(over="ignore"):
        x = (a * _A) ^ ((b << U64(31) | b >> U64(33)) * _B)
        x ^= x >> U64(32)
        x *= _C
        return x ^ x >> U64(29)


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)
