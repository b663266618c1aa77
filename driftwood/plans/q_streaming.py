"""Registered streaming queries: the driver's ``events`` file read as a file
stream, drained once with ``availableNow`` into a checkpointed parquet sink
(STR-1..6, STR-10).

In append mode a window (or session) leaves the state only when the
watermark, ``max(event time) - 10 minutes``, passes its end. The tables end,
so the drained queries are flushed (``run_bounded``) and give all rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import calls as C
from driftwood.operators import metrics as MT
from driftwood.operators import normalize as N
from driftwood.operators import windows as W
from driftwood.operators.messages import map_text
from driftwood.plans import q_messages as QM
from driftwood.plans import q_monitoring as QMON
from driftwood.plans import q_normalize as QN
from driftwood.plans.q_calls import ORDER
from driftwood.plans.q_windows import SQL_SCORE, SQL_STATUS, SQL_WIN_ANOMALIES, _wins_sql, compared, sql_compared, sql_windows
from driftwood.plans.registry import ORACLE, r6, register, sql_r6, with_views
from driftwood.plans.views import SQL_CDR, cdr, cdr_from, iot_from, table
from driftwood.session import folder_names, scratch_path
from driftwood.sinks import ANOMALIES_TOPIC, RESULTS_TOPIC, SinkConfig
from driftwood.sources.stream import SourceConfig
from driftwood.streaming.callbacks import CallbackRegistry
from driftwood.streaming.pipeline import (END_OF_STREAM, WATERMARK, WINDOW_KEYS, PipelineConfig, cluster_partitions, drain,
                                          processing_flow, run_bounded, start_pipeline)
from driftwood.streaming.sessions import CallStream
from driftwood.streaming.tables import BatchManifest, VersionedTable

WATERMARK_US = C.interval_micros(WATERMARK)


def events_stream(spark, sf_dir):
    """The events table as a file stream (same rows, streaming plan)."""
    from driftwood.plans.views import utc
    utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1)
            .parquet(sf_dir))


#: Most rows of a file that ``timed_stream`` writes: one task reads a few of
#: them, however long a stretch is.
ROWS_PER_FILE = 100_000


def timed_stream(spark, sf_dir, parts: int = 3, rows_per_file: int = ROWS_PER_FILE):
    """The events as a stream of ``parts`` micro-batches, each a later stretch
    of time; together they hold every row. All stretches have as many files,
    so that a micro-batch takes the files of one."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-by-time")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(us), F.max(us)).first()
    part = F.coalesce(F.least(F.floor((us - F.lit(lo)) * parts / F.lit(max(1, (hi or 0) - (lo or 0)))),
                              F.lit(parts - 1)), F.lit(0))
    most = max((r["count"] for r in events.groupBy(part.alias("part")).count().collect()), default=0)
    files = max(1, -(-most // rows_per_file))
    for i in range(parts):  # files are taken in the order in which they were written
        events.where(part == i).repartition(files).write.mode("append").parquet(path)
        written = sum(n.startswith("part-") for n in folder_names(spark, path))
        for _ in range(written, files * (i + 1)):  # a stretch of few rows: empty files
            events.limit(0).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)


@register("sliding_stream_append", _wins_sql(W.DEFAULT_WINDOWS) + sql_compared("wins"))
def sliding_stream_append(spark, sf_dir):
    """STR-2: one read, panes and windows as chained stateful aggregates."""
    def windows(readings):
        return W.window_metrics(readings.withWatermark("event_time", WATERMARK), method="stream")
    return compared(run_bounded(iot_from(events_stream(spark, sf_dir)), windows, "sliding-stream",
                                [{"device_id": "<end>", "event_time": END_OF_STREAM}]))


@register("protocol_union_stream", QN.SQL_PROTOCOLS + QN.SQL_MESSAGES)
def protocol_union_stream(spark, sf_dir):
    """SET-2 and NRM-3/4 on a landing stream: polls are folded by two chained
    stateful aggregates and closed by the watermark."""
    def messages(raw):
        return N.normalize_all(raw.withWatermark("received_at", WATERMARK), resources=QN.RESOURCES)
    landing = QN.landing_from(iot_from(events_stream(spark, sf_dir)))
    return QN.shown(run_bounded(landing, messages, "landing", [
        {"protocol": "SNMP", "received_at": END_OF_STREAM, "poll_id": "<end>"}]))


@register("timer_durations_stream", QMON.SQL_TIMERS)
def timer_durations_stream(spark, sf_dir):
    """JOI-3 on a stream: starts joined with ends within an hour."""
    def timers(log):
        starts, ends = (log.where(F.col("phase") == p) for p in ("start", "end"))
        return MT.timer_durations_stream(starts, ends)
    log = QMON.timer_log_from(events_stream(spark, sf_dir))
    d = run_bounded(log, timers, "timers", [
        {"timer_id": f"<{phase}>_0", "phase": phase, "ts": END_OF_STREAM} for phase in ("start", "end")])
    return d.select("timer_id", "name", F.unix_micros("ts").alias("end_us"), "value")


_SQL_STREAM_SESSIONS = with_views(SQL_CDR, """
trimmed AS (
  SELECT *, CASE WHEN end_dt - INTERVAL 10 MINUTE < start_dt THEN end_dt
                 ELSE end_dt - INTERVAL 10 MINUTE END AS adjusted_end_dt
  FROM cdr
  WHERE msisdn IS NOT NULL AND domain IS NOT NULL
    AND start_dt IS NOT NULL AND end_dt IS NOT NULL)""", """
flagged AS (
  SELECT *, CASE WHEN epoch_us(start_dt) - max(epoch_us(end_dt)) OVER (
                   PARTITION BY msisdn, domain ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 300000000
                 THEN 1 ELSE 0 END AS new_call
  FROM trimmed)""", """
sessions AS (
  SELECT *, sum(new_call) OVER (PARTITION BY msisdn, domain
               ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS call_no
  FROM flagged)""", """
calls AS (
  SELECT msisdn, domain, call_no,
         min(epoch_us(start_dt)) AS session_start_us,
         max(epoch_us(end_dt)) + 300000000 AS session_end_us,
         count(*) AS fdr_count,
         CAST(sum(ulvolume) AS BIGINT) AS ul_bytes, CAST(sum(dlvolume) AS BIGINT) AS dl_bytes,
         max(epoch_us(adjusted_end_dt)) AS call_end_us
  FROM sessions GROUP BY msisdn, domain, call_no)""")


@register("calls_stream_session", _SQL_STREAM_SESSIONS + """
SELECT msisdn, domain, session_start_us, session_end_us, fdr_count, ul_bytes, dl_bytes,
       call_end_us
FROM calls""")
def calls_stream_session(spark, sf_dir):
    """STR-10: calls on a stream with ``session_window``: each record opens
    ``[start, end + 5 min)`` and overlapping records merge (the running-max
    rule)."""
    gap_s = C.interval_micros(C.CALL_GAP) // 1_000_000
    gap = F.expr("make_interval(0, 0, 0, 0, 0, 0, CAST((unix_micros(end_dt) - "
                 f"unix_micros(start_dt)) / 1000000 + {gap_s} AS DECIMAL(18, 6)))")

    def sessions(records):
        rec = C.idle_trim(records).where(F.col("msisdn").isNotNull() & F.col("domain").isNotNull()
                                         & F.col("start_dt").isNotNull() & F.col("end_dt").isNotNull())
        return (rec.withWatermark("start_dt", WATERMARK)
                   .groupBy(F.session_window("start_dt", gap).alias("s"), "msisdn", "domain")
                   .agg(F.count(F.lit(1)).alias("fdr_count"),
                        F.sum("ulvolume").alias("ul_bytes"), F.sum("dlvolume").alias("dl_bytes"),
                        F.max("adjusted_end_dt").alias("call_end")))

    out = run_bounded(cdr_from(events_stream(spark, sf_dir)), sessions, "calls-stream", [
        {"msisdn": -1, "domain": "<end>", "start_dt": END_OF_STREAM, "end_dt": END_OF_STREAM}])
    return out.select("msisdn", "domain",
                      F.unix_micros("s.start").alias("session_start_us"),
                      F.unix_micros("s.end").alias("session_end_us"),
                      "fdr_count", "ul_bytes", "dl_bytes",
                      F.unix_micros("call_end").alias("call_end_us"))


@register("calls_sessionize_running_max", _SQL_STREAM_SESSIONS + """
SELECT msisdn, domain, CAST(call_no AS BIGINT) AS call_no, session_start_us, fdr_count,
       ul_bytes, dl_bytes, call_end_us
FROM calls""")
def calls_sessionize_running_max(spark, sf_dir):
    """The batch form of the running-max rule (``gap_from="running_max"``),
    split by time bucket like the previous-record rule."""
    a = C.call_sessions(C.idle_trim(cdr(spark, sf_dir)), order=ORDER, gap_from="running_max")
    return a.select("msisdn", "domain", "call_no",
                    F.unix_micros("call_start").alias("session_start_us"), "fdr_count",
                    "ul_bytes", "dl_bytes", F.unix_micros("call_end").alias("call_end_us"))



@register("calls_stream_previous", with_views(SQL_CDR, """
trimmed AS (
  SELECT *, CASE WHEN end_dt - INTERVAL 10 MINUTE < start_dt THEN end_dt
                 ELSE end_dt - INTERVAL 10 MINUTE END AS adjusted_end_dt
  FROM cdr
  WHERE msisdn IS NOT NULL AND domain IS NOT NULL
    AND start_dt IS NOT NULL AND end_dt IS NOT NULL)""", """
flagged AS (
  SELECT *, CASE WHEN epoch_us(start_dt) - epoch_us(lag(end_dt) OVER w) > 300000000
                 THEN 1 ELSE 0 END AS new_call
  FROM trimmed
  WINDOW w AS (PARTITION BY msisdn, domain
               ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id))""", """
sessions AS (
  SELECT *, sum(new_call) OVER (PARTITION BY msisdn, domain
               ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS call_no
  FROM flagged)""", """
calls AS (
  SELECT msisdn, domain, CAST(call_no AS BIGINT) AS call_no,
         min(epoch_us(start_dt)) AS call_start_us, max(epoch_us(adjusted_end_dt)) AS call_end_us,
         count(*) AS fdr_count, CAST(sum(ulvolume) AS BIGINT) AS ul_bytes,
         CAST(sum(dlvolume) AS BIGINT) AS dl_bytes
  FROM sessions GROUP BY msisdn, domain, call_no)""") + """
SELECT * FROM calls""")
def calls_stream_previous(spark, sf_dir):
    """STR-10 with the previous-record rule, over three micro-batches in time
    order: buckets closed by the watermark run through the batch operator."""
    stream = CallStream(scratch_path(spark, "calls-previous"), order=ORDER)
    records = C.idle_trim(cdr_from(timed_stream(spark, sf_dir)))
    q = stream.start(records, scratch_path(spark, "calls-ckpt"), trigger=None)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    stream.finish(spark)
    return stream.read(spark).select(
        "msisdn", "domain", "call_no", F.unix_micros("call_start").alias("call_start_us"),
        F.unix_micros("call_end").alias("call_end_us"), "fdr_count", "ul_bytes", "dl_bytes")


def _flow(spark, sf_dir, part):
    """Drain the message stream through the processing flow (ALR-2) and read
    one of its outputs back."""
    root, ckpt = scratch_path(spark, "flow-out"), scratch_path(spark, "flow-ckpt")
    stream = QM.kafka_rows_from(QM.message_rows_from(iot_from(events_stream(spark, sf_dir))))
    q = (stream.writeStream.foreachBatch(processing_flow(root)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.option("basePath", f"{root}/{part}").parquet(f"{root}/{part}")


@register("flow_processed", ORACLE["processed_records"])
def flow_processed(spark, sf_dir):
    p = _flow(spark, sf_dir, "processed")
    return p.select("device_id", "timestamp", map_text(F.col("metrics")).alias("metrics"),
                    map_text(F.col("metadata")).alias("metadata"))


@register("flow_alerts", ORACLE["high_temperature_alerts"])
def flow_alerts(spark, sf_dir):
    return _flow(spark, sf_dir, "alerts").select("device_id", "alert_type", "value", "threshold", "severity")


@register("flow_quarantine", QM._SQL_MSG + """
SELECT CASE WHEN dev IS NULL THEN 'missing_device_id' ELSE 'missing_timestamp' END AS reason,
       event_id
FROM msg WHERE dev IS NULL OR NOT has_ts""")
def flow_quarantine(spark, sf_dir):
    return _flow(spark, sf_dir, "quarantine").select(
        "reason", F.col("message.metadata")["event_id"].cast("long").alias("event_id"))


@register("sliding_stream_update", _wins_sql(W.DEFAULT_WINDOWS) + sql_compared("wins"))
def sliding_stream_update(spark, sf_dir):
    """STR-4: update mode over three micro-batches. A window is written again
    whenever it changes; the newest version of each is read back, from a
    compacted base and what came after it."""
    windows = VersionedTable(scratch_path(spark, "versions"), WINDOW_KEYS)
    readings = iot_from(timed_stream(spark, sf_dir)).withWatermark("event_time", WATERMARK)

    def write(batch, batch_id):
        windows.write(batch, batch_id)
        if batch_id == 1:
            windows.compact(spark, batch_id)
    drain(W.window_metrics(readings, method="direct"), scratch_path(spark, "versions-ckpt"),
          output_mode="update", each=write)
    return compared(windows.read(spark))


_MSG_WINDOWS = QM._SQL_MSG.replace("WITH iot AS (", "WITH raw_iot AS (").replace("FROM iot)", "FROM raw_iot)") + f""",
iot AS (
  SELECT dev AS device_id, protocol,
         CASE WHEN has_ts THEN event_time ELSE event_time + INTERVAL 2 SECOND END AS event_time,
         CASE WHEN has_data AND event_id % 11 <> 0 THEN temperature END AS temperature,
         CASE WHEN has_data THEN humidity END AS humidity, CASE WHEN has_data THEN pressure END AS pressure,
         CASE WHEN has_data THEN vibration END AS vibration
  FROM msg),
wins AS ({sql_windows(W.DEFAULT_WINDOWS)})"""


@register("pipeline_targets", _MSG_WINDOWS + f"""
SELECT '{RESULTS_TOPIC}' AS target, device_id, window_duration, window_start_us, 'message_count' AS kind,
       CAST(message_count AS DOUBLE) AS value FROM wins
UNION ALL
SELECT '{ANOMALIES_TOPIC}', device_id, window_duration, window_start_us, anomaly_type, {sql_r6('anomaly_value')}
FROM ({SQL_WIN_ANOMALIES})
UNION ALL
SELECT 'health', device_id, window_duration, window_start_us, {SQL_STATUS}, {sql_r6('health_score')}
FROM (SELECT *, {SQL_SCORE} AS health_score FROM wins)""")
def pipeline_targets(spark, sf_dir):
    """SNK-3/4/5: the analytics pipeline from Kafka rows to its three targets,
    read back: results and anomalies from their topics (file stand-in), health
    scores from JSON files."""
    src, root, topics = (scratch_path(spark, n) for n in ("kafka-in", "pipeline-out", "pipeline-topics"))
    columns = ("key", "value", "topic", "headers")
    events = table(spark, sf_dir, "events")
    # A file of few row groups is read by few tasks; the messages are made and parsed by all.
    tasks = max(spark.sparkContext.defaultParallelism, events.rdd.getNumPartitions())
    rows = QM.kafka_rows_from(QM.message_rows_from(iot_from(events.repartition(tasks))))
    rows.select(*columns).write.parquet(src)
    cfg = PipelineConfig(source=SourceConfig(kind="files", path=src, topics=(), file_format="parquet"), trigger=None,
                         output_root=root, checkpoint=scratch_path(spark, "pipeline-ckpt"),
                         publish=SinkConfig(kind="files", path=topics))
    end = QM.kafka_rows_from(QM.message_rows_from(iot_from(table(spark, sf_dir, "events").limit(0))))
    value = f'{{"timestamp":"{END_OF_STREAM}","data":{{"timestamp":"{END_OF_STREAM}","device_id":"<end>"}}}}'
    last = spark.range(1).select(*(F.lit({"value": value}.get(c)).cast(end.schema[c].dataType).alias(c) for c in columns))
    for ended in (False, True):
        if ended:  # the stream's end moves the watermark past all windows
            last.write.mode("append").parquet(src)
        with cluster_partitions(spark):
            started = start_pipeline(spark, cfg)
        for q in started:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    sent = spark.read.schema("topic string, value string").json(topics)
    key = "device_id string, window_duration string, window_start timestamp"

    def shown(df, target, kind, value):
        return df.select(F.lit(target).alias("target"), "device_id", "window_duration",
                         F.unix_micros("window_start").alias("window_start_us"), kind.alias("kind"), value.alias("value"))

    def of(topic, more):
        v = F.from_json("value", f"{key}, {more}").alias("v")
        return sent.where(F.col("topic") == topic).select(v).select("v.*")
    results = of(RESULTS_TOPIC, "message_count long")
    anomalies = of(ANOMALIES_TOPIC, "anomaly_type string, anomaly_value double")
    health = spark.read.schema(f"{key}, health_score double, health_status string").json(f"{root}/health_json")
    return (shown(results, RESULTS_TOPIC, F.lit("message_count"), F.col("message_count").cast("double"))
            .unionAll(shown(anomalies, ANOMALIES_TOPIC, F.col("anomaly_type"), r6("anomaly_value")))
            .unionAll(shown(health, "health", F.col("health_status"), r6("health_score"))))


@register("flow_restart", ORACLE["processed_records"])
def flow_restart(spark, sf_dir):
    """STR-9: a query that dies in its second batch, when the outputs are
    written but not committed, and is started again from its checkpoint."""
    root, ckpt = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ckpt")
    stream = QM.kafka_rows_from(QM.message_rows_from(iot_from(timed_stream(spark, sf_dir))))
    died = []

    def die_once(batch_id):
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("stopped before the commit")
    step = processing_flow(root, before_commit=die_once)
    try:
        drain(stream, ckpt, each=step)
    except Exception:  # noqa: BLE001 - the failure that the restart is for
        if not died:
            raise
        spark.streams.resetTerminated()  # the session's awaitAnyTermination would raise it again
    drain(stream, ckpt, each=step)
    p = BatchManifest(root).read(spark, "processed")
    return p.select("device_id", "timestamp", map_text(F.col("metrics")).alias("metrics"),
                    map_text(F.col("metadata")).alias("metadata"))


@register("message_callbacks", QN.SQL_PROTOCOLS + f"SELECT *, 'broken' AS failed FROM ({QN.SQL_MESSAGES})")
def message_callbacks(spark, sf_dir):
    """UDF-2: a callback on all normalised messages of a stream and one that
    fails on TCP messages; what the first saw, beside the failure table."""
    root = scratch_path(spark, "callbacks")
    registry = CallbackRegistry(root)
    registry.register("keep", lambda part, n: part.write.mode("overwrite").parquet(f"{root}/seen/batch_id={n}"))

    def broken(part, batch_id):
        if not part.isEmpty():
            raise ValueError("cannot handle this")
    registry.register("broken", broken, "TCP")
    run_bounded(QN.landing_from(iot_from(events_stream(spark, sf_dir))),
                lambda raw: N.normalize_all(raw.withWatermark("received_at", WATERMARK), resources=QN.RESOURCES),
                "callbacks", [{"protocol": "SNMP", "received_at": END_OF_STREAM, "poll_id": "<end>"}],
                each=lambda batch, n: registry.run(batch, n) and None)
    failed = registry.failures(spark).select(F.col("callback").alias("failed")).distinct()
    seen = spark.read.option("basePath", f"{root}/seen").parquet(f"{root}/seen")
    return QN.shown(seen, F.lit(1).alias("_one")).join(failed, F.col("_one") == 1, "left").drop("_one")
