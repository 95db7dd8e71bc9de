"""Controllers that follow telemetry: pressure, limits, backlogs, stale tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares of a window at which a fetch limit is lowered, and below which a window is healthy.
TIMEOUTS, FAILURES, QUEUES, FILES, MEMORY = 0.35, 0.70, 0.75, 0.70, 0.75
CALM_TIMEOUTS, CALM_FAILURES, CALM_QUEUES = 0.20, 0.30, 0.40
#: Windows in a row before a limit moves, and records of a run before any does.
PRESSED_WINDOWS, HEALTHY_WINDOWS, LEAST_PROCESSED = 2, 2, 500


def share(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def pressure(depths: dict[str, Column], limits: dict[str, Column]) -> Column:
    """The greatest ratio of a queue's depth to its limit."""
    ratios = [share(depths[q], limits[q]) for q in depths]
    return F.greatest(*ratios) if len(ratios) > 1 else ratios[0]


def window_rates(ticks: DataFrame, part: str, order: str, *totals: str) -> DataFrame:
    """ticks with what each cumulative counter has gained since the last tick (d_<counter>): never negative, as counters restart at 0."""
    w = Window.partitionBy(part).orderBy(order)
    return ticks.select("*", *[F.greatest(F.col(c) - F.lag(c, 1, 0).over(w), F.lit(0)).alias(f"d_{c}") for c in totals])


def folded(ticks: DataFrame, part: str, order: str, start: dict[str, Column], step) -> DataFrame:
    """(part, state after its last tick): step(state, tick) for each of a run's ticks in order, as each step depends on the last.

    A run's ticks are one every few seconds: a row holds those of one run.
    """
    rest = [c for c in ticks.columns if c != part]
    rows = ticks.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order]))).alias("t"))
    return rows.select(part, F.aggregate("t", F.struct(*[c.alias(n) for n, c in start.items()]), step).alias("s")).select(part, "s.*")


def fetch_limits(ticks: DataFrame, part: str, order: str, *, limit: int, most: int, floor: int, step: int) -> DataFrame:
    """(part, limit, pressed, healthy, downs, ups) after a run's ticks(total, processed, failed, timed_out, queues, files, memory).

    total: processed by the run so far; queues, files, memory: ratios. Two pressed windows in a row lower the limit by a step,
    two healthy ones raise it, both only once the run has processed enough.
    """

    def move(s: Column, t: Column) -> Column:
        timeouts, failures = share(t["timed_out"], t["processed"]), share(t["failed"] + t["timed_out"], t["processed"])
        busy = t["processed"] > 0
        enough = t["total"] >= LEAST_PROCESSED
        over = enough & busy & ((timeouts >= TIMEOUTS) | (failures >= FAILURES) | (t["queues"] >= QUEUES) | (t["files"] >= FILES) | (t["memory"] >= MEMORY))
        calm = busy & (timeouts < CALM_TIMEOUTS) & (failures < CALM_FAILURES) & (t["queues"] < CALM_QUEUES) & (t["files"] < FILES) & (t["memory"] < MEMORY)
        pressed = F.when(over, s["pressed"] + 1).otherwise(0)
        healthy = F.when(~over & calm, s["healthy"] + 1).otherwise(0)
        down = over & (pressed >= PRESSED_WINDOWS) & (s["limit"] > floor)
        up = ~over & (s["limit"] < most) & (healthy >= HEALTHY_WINDOWS) & enough
        return F.struct(
            F.when(down, F.greatest(F.lit(floor), s["limit"] - step)).when(up, F.least(F.lit(most), s["limit"] + step)).otherwise(s["limit"]).alias("limit"),
            F.when(down, 0).otherwise(pressed).alias("pressed"),
            F.when(up, 0).otherwise(healthy).alias("healthy"),
            (s["downs"] + down.cast("int")).alias("downs"),
            (s["ups"] + up.cast("int")).alias("ups"),
        )

    return folded(ticks, part, order, {"limit": F.lit(limit), "pressed": F.lit(0), "healthy": F.lit(0), "downs": F.lit(0), "ups": F.lit(0)}, move)


def stage_limit(limit: Column, floor: Column, most: Column, ingress: Column, cpu: Column, cpu_depth: Column, cpu_rate: Column, timeouts: Column, files: Column, memory: Column, step: int = 32) -> Column:
    """struct(action, next_limit) of a stage's fetch limit: halved when the processors' queue is nearly full, lowered by a quarter
    under other pressure, raised by a step when there is room."""
    low = F.greatest(F.lit(1), floor)
    high = F.greatest(low, most)
    now = F.greatest(low, F.least(high, limit))
    backlog = cpu_depth / F.greatest(cpu_rate, F.lit(1.0))
    halved = F.greatest(low, F.ceil(now * 0.5).cast("int"))
    lowered = F.greatest(low, now - F.greatest(F.lit(step), F.floor(now / 4).cast("int")))
    to = lambda action, value: F.struct(F.when(value < now, action).otherwise("hold").alias("action"), value.cast("int").alias("next_limit"))
    pressed = (backlog > 2.0) | (cpu > 0.60) | (timeouts >= TIMEOUTS) | (files >= FILES) | (memory >= MEMORY)
    room = (backlog < 1.0) & (ingress < 0.50) & (timeouts < CALM_TIMEOUTS) & (files < 0.65) & (memory < 0.70) & (now < high)
    raised = F.struct(F.lit("upshift").alias("action"), F.least(high, now + step).cast("int").alias("next_limit"))
    return F.when(cpu >= 0.80, to("hard_clamp", halved)).when(pressed, to("downshift", lowered)).when(room, raised).otherwise(F.struct(F.lit("hold").alias("action"), now.cast("int").alias("next_limit")))


def backlog_cap(full: Column, reserved: Column, backlog: Column, ingress: Column, cpu: Column, done: Column) -> Column:
    """Fetches that a later stage may have while an earlier one is still busy."""
    most = F.greatest(F.lit(1), full)
    least = F.least(most, F.greatest(F.lit(1), reserved))
    calm = (backlog <= 0.5) & (ingress < 0.25) & (cpu < 0.25)
    eased = (backlog <= 1.0) & (ingress < 0.50) & (cpu < 0.50)
    return F.when(done | calm, most).when(eased, F.least(most, F.greatest(least, F.lit(16)))).otherwise(least)


def in_flight(ticks: DataFrame, part: str, order: str, *, start: int, floor: int, cap: int, target: float = 0.82, spare_cores: float = 2.0) -> DataFrame:
    """(part, in_flight, action, reason) after a run's ticks(free_cpu, used_cpu, lag_ms, pending_rows, queue, open_tasks, completed):
    four fewer tasks in flight for any severe reason, twelve more after a healthy window. spare_cores are to stay free."""
    least = max(1.0, spare_cores - 2)
    reasons = lambda t, load: F.array_compact(F.array(
        F.when(t["free_cpu"] < least, "cpu_headroom_low"), F.when((t["free_cpu"] < spare_cores) & (load > min(0.99, target + 0.12)), "cpu_utilization"), F.when(t["lag_ms"] > 250.0, "event_loop_lag"),
        F.when(t["pending_rows"] > 20_000, "checkpoint_backlog"), F.when(t["queue"] > F.greatest(F.lit(32), 2 * t["open_tasks"]), "ocr_backlog"),
    ))

    def move(s: Column, t: Column) -> Column:
        load = F.when(t["free_cpu"] + t["used_cpu"] > 0, t["used_cpu"] / (t["free_cpu"] + t["used_cpu"])).otherwise(0.0)
        severe = reasons(t, load)
        bad = F.size(severe) > 0
        good = ~bad & (t["free_cpu"] > spare_cores + 2) & (load < min(0.99, target + 0.05)) & (t["lag_ms"] < 100.0) & (t["pending_rows"] < 5000) & (t["queue"] < 8) & ((t["completed"] > 0) | (t["open_tasks"] == 0))
        down, up = bad & (s["in_flight"] > floor), good & (s["in_flight"] < cap)
        return F.struct(
            F.when(down, F.greatest(F.lit(floor), s["in_flight"] - 4)).when(up, F.least(F.lit(cap), s["in_flight"] + 12)).otherwise(s["in_flight"]).alias("in_flight"),
            F.when(down, "downshift").when(up, "upshift").otherwise("hold").alias("action"),
            F.when(bad, F.array_join(F.slice(severe, 1, 3), ",")).when(up, "healthy_window").when(good, "at_cap").otherwise("steady").alias("reason"),
        )

    return folded(ticks, part, order, {"in_flight": F.lit(start), "action": F.lit("hold"), "reason": F.lit("steady")}, move)


def reaped(tasks: DataFrame, now: Column, *, age: float = 180.0) -> DataFrame:
    """tasks(submitted, attempts) with what becomes of each: 'running', 'retry' once when it is stale, 'classification_failed' after that."""
    old = now.cast("double") - F.col("submitted").cast("double") >= age
    return tasks.withColumn("fate", F.when(~F.coalesce(old, F.lit(False)), "running").when(F.col("attempts") >= 1, "classification_failed").otherwise("retry"))


def backlog(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the rows that wait in each table, and in all."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        counts = one if counts is None else counts.union(one)
    return counts.agg(*[F.sum(F.when(F.col("name") == n, F.col("n")).otherwise(0)).alias(n) for n in tables], F.sum("n").alias("pending_rows_total"))


def rolled_up(stats: DataFrame) -> DataFrame:
    """One row of workers' stats(ready, queue_depth, batches, items): ready if all are, the rest summed."""
    return stats.agg(F.coalesce(F.bool_and(F.coalesce("ready", F.lit(False))), F.lit(True)).alias("ready"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("queue_depth", "batches", "items")])
