"""The drained stream queries over more files than a bounded trigger takes, which come in no order of time."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.plans.queries import QUERIES

START, N = datetime.datetime(2024, 1, 1), 280


@pytest.fixture(scope="module")
def many_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("many")
    (folder / "events.parquet").mkdir()
    order = list(range(N))
    random.Random(1).shuffle(order)
    for i in range(0, N, 2):
        rows = [(e, START + datetime.timedelta(hours=5 * e if e % 2 else 5 * e - 3), e % 7, "click", 1.0) for e in order[i : i + 2]]
        pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value"]).astype({"ts": "datetime64[us]"}).to_parquet(folder / f"events.parquet/{i:04}.parquet")
    return str(folder)


def test_dedupe_keeps_every_event(spark, many_files):
    assert sorted(r.event_id for r in QUERIES["q_stream_dedupe"](spark, many_files).collect()) == list(range(N))


def test_watchdog_sees_events_in_time_order(spark, many_files):
    (row,) = QUERIES["q_stream_watchdog"](spark, many_files).collect()
    gaps = [8 if e % 2 else 2 for e in range(1, N)]
    assert (row.warnings, row.stalls) == (len(gaps), sum(g >= 4 for g in gaps))


def test_updates_of_many_batches_are_merged(spark, many_files, tmp_path):
    from vigil.streaming import streams

    schema = spark.read.parquet(f"{many_files}/events.parquet").schema
    events = streams.file_stream(spark, f"{many_files}/events.parquet", schema, 7).withColumn("ts", F.col("ts").cast("timestamp"))
    (row,) = streams.drained_table(streams.watchdog(events, "event_type", "ts", 3600, 4 * 3600), str(tmp_path), "update", ["event_type"]).collect()
    gaps = [8 if e % 2 else 2 for e in range(1, N)]
    assert (row.warnings, row.stalls) == (len(gaps), sum(g >= 4 for g in gaps))
    counted = streams.drained_table(events.groupBy("user_id").agg(F.count("*").alias("n")), str(tmp_path), "update", ["user_id"]).collect()
    assert sum(r.n for r in counted) == N and len(counted) == 7


def test_silent_keys_are_reported(spark, tmp_path):
    from vigil.streaming import streams

    (tmp_path / "e").mkdir()
    for i, (key, hour) in enumerate([("a", 0), ("b", 0), ("b", 5), ("b", 9), ("b", 10)]):
        pd.DataFrame([(key, START + datetime.timedelta(hours=hour))], columns=["k", "ts"]).astype({"ts": "datetime64[us]"}).to_parquet(tmp_path / f"e/{i}.parquet")
    events = streams.file_stream(spark, str(tmp_path / "e"), "k string, ts timestamp", 1).withWatermark("ts", "1 minute")
    found = streams.drained_table(streams.watchdog(events, "k", "ts", 3600, 4 * 3600, silent_after=3 * 3600), str(tmp_path / "out"), "update", ["k"]).collect()
    assert {r.k: r.silent for r in found} == {"a": True, "b": False}
