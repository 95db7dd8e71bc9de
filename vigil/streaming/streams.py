"""Structured Streaming forms of the telemetry and state operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigil.operators.state import latest


def dated_stream(spark: SparkSession, path: str, schema, day: str) -> DataFrame:
    """New Parquet files of a day's folder (YYYY-MM-DD) below path."""
    return spark.readStream.schema(schema).parquet(f"{path}/{day}")


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = 64) -> DataFrame:
    """New Parquet files of a folder; a trigger takes so many of them at most (back-pressure), with None all that are there.

    Files come in no order of event time, so with a bound the watermark of one trigger drops older events of the next.
    """
    reader = spark.readStream.schema(schema)
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).parquet(path)


def windowed(events: DataFrame, ts: str, keys: list[str], value: str, *, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counters of event-time windows; windows end once the watermark has passed them."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def deduplicated(events: DataFrame, ts: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def watchdog(events: DataFrame, key: str, ts: str, warn: float, stall: float, silent_after: float | None = None) -> DataFrame:
    """(key, warnings, stalls, silent) so far of each key, updated by its batches: a silence of `warn` seconds between events is a warning,
    one of `stall` a stall; progress arms both again. With silent_after, a key without events for so many seconds before the
    watermark (events must have one) is reported as silent once.

    State is the spans of time without a warning's silence, so events may come in any order, and between batches, too: one that
    comes late splits a silence or ends it. A key has one span more than warnings.
    """

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spans = list(zip(*state.get, strict=True)) if state.exists else []
        silent = state.hasTimedOut
        if not silent:
            spans += [(t.timestamp(), t.timestamp()) for f in frames for t in f[ts]]
        merged: list[list[float]] = []
        for a, b in sorted(spans):
            if merged and a - merged[-1][1] < warn:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        state.update(([m[0] for m in merged], [m[1] for m in merged]))
        if silent_after is not None and not silent:
            state.setTimeoutTimestamp(max(int((merged[-1][1] + silent_after) * 1000), state.getCurrentWatermarkMs() + 1))
        stalls = sum(y[0] - x[1] >= stall for x, y in pairwise(merged))
        yield pd.DataFrame({key: [k[0]], "warnings": [len(merged) - 1], "stalls": [stalls], "silent": [bool(silent)]})

    timeout = GroupStateTimeout.NoTimeout if silent_after is None else GroupStateTimeout.EventTimeTimeout
    return events.groupBy(key).applyInPandasWithState(update, f"{key} string, warnings long, stalls long, silent boolean", "starts array<double>, ends array<double>", "update", timeout)


def drained(stream: DataFrame, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """What a stream gives over the input that is there (Trigger.AvailableNow), as a table. For tests and one-off runs."""
    spark = stream.sparkSession
    name = f"drained_{uuid.uuid4().hex}"
    writer = stream.writeStream.trigger(availableNow=True).outputMode(mode).option("checkpointLocation", f"{checkpoint}/{name}")
    query = (writer.foreachBatch(each) if each else writer.format("memory").queryName(name)).start()
    query.awaitTermination()
    return spark.table(name) if not each else spark.range(0)


def drained_table(stream: DataFrame, folder: str, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """As drained(), into Parquet files in a shared folder: nothing passes through the driver. mode 'append' only emits closed windows;
    'complete' has what the last batch has; 'update' has the last row of each of the keys over all batches."""
    out = f"{folder}/out-{uuid.uuid4().hex}"
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}-checkpoint")
    spark = stream.sparkSession
    if mode == "append":
        writer.outputMode("append").format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    if mode == "update" and not keys:
        raise ValueError("rows are updated by keys")
    # a batch that is run again writes its own folder again
    at = (lambda n: f"{out}/__batch={n}") if mode == "update" else lambda n: f"{out}/__batch=0"
    writer.outputMode(mode).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(at(n))).start().awaitTermination()
    every = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("__batch", T.LongType())])).parquet(out)
    return (latest(every, keys, ["__batch"]) if mode == "update" else every).drop("__batch").select(*stream.columns)
