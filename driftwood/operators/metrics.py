"""Metric points: append, read, summaries, retention, and the metrics derived
from timers, throughput counts, errors and streaming progress.

Operators: SNK-10, SRC-7, AGG-11/12, WIN-4, FLT-9, JOI-3, MET-1..5.

A metric point is ``(name, ts, seq, value, tags)``; ``seq`` is the append
order, so "latest" means the last appended point (as in the original list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.operators.calls import interval_micros
from driftwood.schemas import PROGRESS_SCHEMA

# The dashboard's key metrics and summary windows (minutes).
KEY_METRICS = ("messages.per_second", "kafka.consumer.lag", "errors.per_minute",
               "system.memory.usage_percent", "system.cpu.usage_percent")
SUMMARY_MINUTES = 60
PANEL_MINUTES = 15
RETAIN_POINTS = 1000


def append_metrics(points: DataFrame, path: str) -> None:
    """SNK-10: append points to a parquet table partitioned by date, so a
    time bound prunes whole partitions on read."""
    (points.withColumn("date", F.to_date("ts"))
           .write.mode("append").partitionBy("date").parquet(path))


def since_bound(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def metric_summary(points: DataFrame, as_of: Column, minutes: int = SUMMARY_MINUTES,
                   names: list[str] | None = None) -> DataFrame:
    """AGG-11/12: per metric over ``[as_of - minutes, as_of]`` (inclusive
    lower bound): count, min, max, avg and the last appended value. Metrics
    without points in the window produce no row."""
    p = points.where((F.col("ts") >= since_bound(as_of, minutes)) & (F.col("ts") <= as_of))
    if names:
        p = p.where(F.col("name").isin(list(names)))
    return p.groupBy("name").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.max_by("value", "seq").alias("latest"))


def retain_last(points: DataFrame, n: int = RETAIN_POINTS) -> DataFrame:
    """WIN-4: the last ``n`` appended points of each metric.

    ``row_number() <= n`` lets Spark insert a per-partition group limit
    before the shuffle, so a metric holding most of the points sends at most
    ``n`` rows per map task instead of all of them to one reducer.
    """
    w = Window.partitionBy("name").orderBy(F.col("seq").desc())
    return points.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def timer_durations(timer_events: DataFrame, order: str | None = None,
                    tags: str | None = None) -> DataFrame:
    """MET-1 / JOI-3: ``performance.<operation>.duration_ms`` for timers
    that started and ended, from one log of ``(timer_id, phase, ts)`` with
    phase ``start`` or ``end``. An end counts when the event just before it
    in its timer is a start, so an id may be used again, a start that starts
    anew replaces the open one, and an end without a start is ignored. Equal
    times go by the column ``order``, then start before end. With ``tags``
    the end's tags stay on the point. The operation is the timer id without
    its last ``_suffix``."""
    by = [F.col("ts"), *([F.col(order)] if order else []), F.col("phase").desc()]
    w = Window.partitionBy("timer_id").orderBy(*by)
    j = (timer_events.withColumn("_phase", F.lag("phase").over(w)).withColumn("_start", F.lag("ts").over(w))
         .where((F.col("phase") == "end") & (F.col("_phase") == "start")))
    return j.select(
        "timer_id", _timer_name(), "ts",
        ((F.unix_micros("ts") - F.unix_micros("_start")) / F.lit(1000.0)).alias("value"),
        *([F.col(tags)] if tags else []))


def timer_durations_stream(starts: DataFrame, ends: DataFrame, longest: str = "1 hour",
                           watermark: str = "10 minutes", tags: str | None = None) -> DataFrame:
    """JOI-3 on streams: :func:`timer_durations` of two streams ``(timer_id,
    ts)``, for timers of at most ``longest``, in append mode.

    A stream-stream inner join with a watermark on both sides and a range of
    ``longest`` between start and end, so Spark drops a row from the state as
    soon as nothing can meet it any more. An id may be used again: the first
    end behind each start counts, and of the starts that have one end the
    latest. Both are stateful aggregates chained behind the join. Rows behind
    the watermark are ignored.
    """
    s = (starts.select(F.col("timer_id"), F.col("ts").alias("start_ts")).withWatermark("start_ts", watermark))
    e = (ends.select(F.col("timer_id").alias("_id"), F.col("ts").alias("end_ts"),
                     *([F.col(tags).alias("_tags")] if tags else [])).withWatermark("end_ts", watermark))
    met = s.join(e, (F.col("timer_id") == F.col("_id")) & (F.col("end_ts") >= F.col("start_ts"))
                 & (F.col("end_ts") <= F.col("start_ts") + F.expr(f"INTERVAL {longest}")))
    first = met.groupBy("timer_id", "start_ts").agg(
        F.min("end_ts").alias("end_ts"), *([F.min_by("_tags", "end_ts").alias("_tags")] if tags else []))
    # All starts of an end lie within ``longest`` before it: one session.
    last = first.groupBy(F.session_window("start_ts", longest), "timer_id", "end_ts").agg(
        F.max("start_ts").alias("start_ts"), *([F.max_by("_tags", "start_ts").alias("_tags")] if tags else []))
    return last.select(
        "timer_id", _timer_name(), F.col("end_ts").alias("ts"),
        ((F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1000.0)).alias("value"),
        *([F.col("_tags").alias(tags)] if tags else []))


def _timer_name() -> Column:
    op = F.regexp_replace("timer_id", "_[^_]*$", "")
    return F.concat(F.lit("performance."), op, F.lit(".duration_ms")).alias("name")


def throughput_metrics(events: DataFrame, component: str, ts: str = "ts",
                       every: str = "1 minute") -> DataFrame:
    """MET-2: ``throughput.<component>.messages_per_second`` per time bucket."""
    seconds = interval_micros(every) / 1e6
    return (events.groupBy(F.col(component).alias("_c"), F.window(ts, every).alias("_w"))
                  .agg(F.count(F.lit(1)).alias("_n"))
                  .select(F.concat(F.lit("throughput."), F.col("_c"),
                                   F.lit(".messages_per_second")).alias("name"),
                          F.col("_w.start").alias("ts"),
                          (F.col("_n") / F.lit(seconds)).alias("value")))


def error_metrics(errors: DataFrame, component: str, error_type: str, ts: str = "ts",
                  tags: str | None = None) -> DataFrame:
    """MET-3: one ``errors.<component>.count`` point of value 1 per error,
    tagged with its error type."""
    base = F.create_map(F.lit("error_type"), F.col(error_type))
    t = F.map_concat(F.col(tags), base) if tags else base
    return errors.select(
        F.concat(F.lit("errors."), F.col(component), F.lit(".count")).alias("name"),
        F.col(ts).alias("ts"), F.lit(1.0).alias("value"), t.alias("tags"))


def progress_metrics(progress_json: DataFrame, col: str = "json") -> DataFrame:
    """MET-4: one row per progress event: query id, name, time, batch id,
    input and processed rows per second, trigger duration, state memory in
    MB (summed over state operators, 0 when there are none: D10) and rows
    dropped by the watermark (STR-3)."""
    p = progress_json.select(F.from_json(F.col(col), PROGRESS_SCHEMA).alias("p")).select("p.*")
    ops = F.coalesce(F.col("stateOperators"), F.array())
    mem = F.aggregate(ops, F.lit(0).cast("long"),
                      lambda acc, o: acc + F.coalesce(o["memoryUsedBytes"], F.lit(0)))
    dropped = F.aggregate(ops, F.lit(0).cast("long"),
                          lambda acc, o: acc + F.coalesce(o["numRowsDroppedByWatermark"], F.lit(0)))
    return p.select(
        F.col("id").alias("query_id"), "name",
        F.try_to_timestamp(F.col("timestamp")).alias("timestamp"),
        F.col("batchId").alias("batch_id"),
        F.col("inputRowsPerSecond").alias("input_rows_per_second"),
        F.col("processedRowsPerSecond").alias("processed_rows_per_second"),
        F.col("durationMs")["triggerExecution"].alias("batch_duration_ms"),
        (mem / F.lit(1024.0 * 1024.0)).alias("state_store_memory_mb"),
        dropped.alias("rows_dropped_by_watermark"))


def latest_progress(progress: DataFrame) -> DataFrame:
    """MET-5: the most recent progress row of each query."""
    cols = [c for c in progress.columns if c != "query_id"]
    latest = F.max_by(F.struct(*cols), F.col("batch_id"))
    return progress.groupBy("query_id").agg(latest.alias("_l")).select("query_id", "_l.*")
