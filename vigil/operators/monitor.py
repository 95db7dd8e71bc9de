"""Telemetry: windows, rings, streaks, stalls, and the controllers that follow them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators import control


def tumbling(events: DataFrame, ts: str, seconds: int, keys: Sequence[str], value: str) -> DataFrame:
    """Counters (count, sum), a gauge (last value) and latency (mean, max) for each window and key."""
    return events.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("greatest"), F.max_by(value, ts).alias("gauge")).withColumn("window_start", F.col("w.start")).drop("w")


#: Rows of a key from which its ring is computed in parts.
PART = 100_000


def ring(events: DataFrame, keys: Sequence[str], order: str, value: str, size: int = 256, part: int = PART) -> DataFrame:
    """events with the count, mean and maximum of the last `size` values of their key, by a number that orders them.

    A key of many rows goes in parts of about `part` rows, so that a few hot keys keep all machines busy. A part gets the last rows
    of those before it, too, as many as its first rows look back to.
    """
    back = size - 1
    w = Window.partitionBy(*keys, "__part").orderBy(order)
    hot = events.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > part)
    most = hot.agg(F.max("__n")).first()[0]
    if most is None:
        dealt = events.withColumn("__part", F.lit(0)).withColumn("__own", F.lit(True))
    else:
        shares = [i * part / most for i in range(1, -(-most // part))]
        edges = events.join(hot, list(keys), "left_semi").groupBy(*keys).agg(F.percentile_approx(order, shares, 10_000).alias("__edges"))
        placed = events.join(edges, list(keys), "left").withColumn("__part", F.coalesce(F.size(F.filter("__edges", lambda e: e <= F.col(order))), F.lit(0)))
        # of each part how many rows there are, to know how far back the parts after it look
        sizes = placed.where("__edges IS NOT NULL").groupBy(*keys, "__part").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__part", "n"))).alias("__sizes"))
        ranked = placed.join(sizes, list(keys), "left").withColumn("__last", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(F.desc(order))))
        later = F.sequence(F.col("__part") + 1, F.size("__edges"))
        between = lambda p: F.aggregate(F.filter(F.map_entries("__sizes"), lambda x: (x["key"] > F.col("__part")) & (x["key"] < p)), F.lit(0).cast("long"), lambda s, x: s + x["value"])
        wanted = F.when((F.col("__last") <= back) & (F.col("__part") < F.size("__edges")), F.filter(later, lambda p: F.col("__last") + between(p) <= back)).otherwise(F.array().cast("array<int>"))
        places = F.concat(F.array(F.struct(F.col("__part").alias("part"), F.lit(True).alias("own"))), F.transform(F.coalesce(wanted, F.array().cast("array<int>")), lambda p: F.struct(p.alias("part"), F.lit(False).alias("own"))))
        dealt = ranked.withColumn("__x", F.explode(places)).withColumn("__part", F.col("__x.part")).withColumn("__own", F.col("__x.own")).drop("__x", "__edges", "__sizes", "__last")
    looked = w.rowsBetween(-back, 0)
    return dealt.withColumn("ring_n", F.count(value).over(looked)).withColumn("ring_avg", F.avg(value).over(looked)).withColumn("ring_max", F.max(value).over(looked)).where("__own").drop("__part", "__own")


def streaks(ticks: DataFrame, part: Sequence[str], order: Sequence[str], pressed: Column) -> DataFrame:
    """ticks with streak, the number of pressed ticks in a row up to each (gaps and islands)."""
    w = Window.partitionBy(*part).orderBy(*order)
    runs = ticks.withColumn("__p", pressed).withColumn("__g", F.sum(F.when(F.col("__p"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inner = Window.partitionBy(*part, "__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("streak", F.sum(F.col("__p").cast("int")).over(inner)).drop("__p", "__g")


def stalls(events: DataFrame, part: str, ts: str, warn: int, stall: int) -> DataFrame:
    """Per key the silences between its events: how many reach the warning and the stall threshold, and the longest (seconds)."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = at - F.lag(at).over(Window.partitionBy(part).orderBy(ts))
    return events.withColumn("gap", gap / 1_000_000).groupBy(part).agg(F.count_if(F.col("gap") >= warn).alias("warnings"), F.count_if(F.col("gap") >= stall).alias("stalls"), F.round(F.max("gap"), 3).alias("longest"))


def sessions(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Sessions of a key that end with a silence: start, end of the last event, and count."""
    return events.groupBy(F.session_window(ts, f"{gap_seconds} seconds"), key).agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).drop("session_window")


def downshift(ticks: DataFrame, part: str, order: str, *, limit: int, floor: int, step: int, backlog_most: int | None = None) -> DataFrame:
    """(part, next_limit, downshifts): the fold of a limiter over a run's ticks(processed, failed, timed_out[, backlog]).

    A tick presses if timeouts reach 35 % or failures and timeouts 70 % of what it processed, the run has processed enough by then, and
    no more than backlog_most rows wait for the next stage; two in a row lower the limit by a step, not below the floor.
    """
    run = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    full = ticks.withColumn("total", F.sum("processed").over(run)).withColumn("clear", F.col("backlog") <= backlog_most if backlog_most is not None else F.lit(True))

    def move(s: Column, t: Column) -> Column:
        over = t["clear"] & (t["total"] >= control.LEAST_PROCESSED) & (t["processed"] > 0) & ((control.share(t["timed_out"], t["processed"]) >= control.TIMEOUTS) | (control.share(t["failed"] + t["timed_out"], t["processed"]) >= control.FAILURES))
        pressed = F.when(over, s["pressed"] + 1).otherwise(0)
        down = over & (pressed >= control.PRESSED_WINDOWS) & (s["next_limit"] > floor)
        return F.struct(F.when(down, F.greatest(F.lit(floor), s["next_limit"] - step)).otherwise(s["next_limit"]).alias("next_limit"), F.when(down, 0).otherwise(pressed).alias("pressed"), (s["downshifts"] + down.cast("int")).alias("downshifts"))

    return control.folded(full, part, order, {"next_limit": F.lit(limit), "pressed": F.lit(0), "downshifts": F.lit(0)}, move).select(part, "next_limit", "downshifts")
