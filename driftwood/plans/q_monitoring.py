"""Registered monitoring queries: metric summaries, retention, threshold
rules, alert state, system health, timers, throughput, errors and streaming
progress (AGG-11..13, WIN-4/5, SRT-3, JOI-1/3/4, ALR-3..5, FLT-9..12,
MET-1..5).

Metric points come from ``events``: each event type is one metric (mapped
to the metric names the rules and the dashboard read), ``seq`` is the
event id (append order), ``as_of`` is the latest point's time.

The alert log comes from ``events`` too: an ``error`` event creates an alert
``user.<u % 10>_<epoch hour>`` (a second create in the same hour replaces
it), a ``purchase`` event of the same component and hour resolves it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import alerts as AL
from driftwood.operators import metrics as MT
from driftwood.operators.messages import iso_text, map_text
from driftwood.plans.registry import r6, register, sql_r6
from driftwood.plans.views import table

# Metric name of each event type.
METRIC_OF = {"view": "messages.per_second", "click": "kafka.consumer.lag",
             "error": "errors.per_minute", "purchase": "system.memory.usage_percent",
             "signup": "system.disk.usage_percent"}

_SQL_METRIC_NAME = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_OF.items()) + " END"


def points(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in METRIC_OF.items()])
    return ev.select(name.alias("name"), F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_id").alias("seq"), "value",
                     F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("tags"))


def latest_time(df):
    """``as_of`` = the latest point time. In production ``as_of`` is "now";
    here it comes from the data, fetched once as one number (epoch
    microseconds, time-zone safe) so the bounds are literals that prune."""
    us = df.agg(F.max(F.unix_micros("ts"))).first()[0]
    return F.timestamp_micros(F.lit(us))


_SQL_POINTS = f"""
WITH p AS (
  SELECT {_SQL_METRIC_NAME} AS name, CAST(ts AS TIMESTAMP) AS ts, event_id AS seq, value
  FROM events)
"""


def _sql_summary(minutes: int, names=None) -> str:
    only = ""
    if names:
        only = " AND name IN (" + ", ".join(f"'{n}'" for n in names) + ")"
    return _SQL_POINTS + f"""
SELECT name, count(*) AS count, min(value) AS min, max(value) AS max,
       {sql_r6('avg(value)')} AS avg, arg_max(value, seq) AS latest
FROM p
WHERE ts >= (SELECT max(ts) FROM p) - INTERVAL {minutes} MINUTE
  AND ts <= (SELECT max(ts) FROM p){only}
GROUP BY name"""


@register("metric_summary", _sql_summary(MT.SUMMARY_MINUTES))
def metric_summary(spark, sf_dir):
    p = points(spark, sf_dir)
    return MT.metric_summary(p, latest_time(p), MT.SUMMARY_MINUTES).withColumn("avg", r6("avg"))


@register("metric_key_panel", _sql_summary(MT.PANEL_MINUTES, MT.KEY_METRICS))
def metric_key_panel(spark, sf_dir):
    p = points(spark, sf_dir)
    return (MT.metric_summary(p, latest_time(p), MT.PANEL_MINUTES, names=list(MT.KEY_METRICS))
              .withColumn("avg", r6("avg")))


@register("metric_retention", _SQL_POINTS + """
SELECT name, seq, epoch_us(ts) AS ts_us, value FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY seq DESC) AS r FROM p)
WHERE r <= 1000""")
def metric_retention(spark, sf_dir):
    kept = MT.retain_last(points(spark, sf_dir), MT.RETAIN_POINTS)
    return kept.select("name", "seq", F.unix_micros("ts").alias("ts_us"), "value")


_SQL_RULES = "(VALUES " + ", ".join(
    f"('{r.name}', '{r.metric}', {float(r.threshold)}::DOUBLE, "
    f"'{int(r.threshold) if float(r.threshold).is_integer() else r.threshold}', "
    f"'{r.operator}', '{r.severity}', '{r.message}')" for r in AL.DEFAULT_RULES) + \
    ") AS rules(rule, metric, threshold, threshold_text, operator, severity, message)"


@register("alert_rules", _SQL_POINTS + f""",
s AS (
  SELECT name AS metric, arg_max(value, seq) AS latest
  FROM p
  WHERE ts >= (SELECT max(ts) FROM p) - INTERVAL {AL.RULE_WINDOW_MINUTES} MINUTE
    AND ts <= (SELECT max(ts) FROM p)
  GROUP BY name)
SELECT 'monitor.' || rule || '_' || CAST(epoch((SELECT max(ts) FROM p))::BIGINT AS VARCHAR) AS id,
       severity, 'monitor.' || rule AS component,
       message || ' (current: ' || CAST(latest AS VARCHAR) || ', threshold: ' || threshold_text || ')'
         AS message,
       metric, latest AS current_value, threshold
FROM s JOIN {_SQL_RULES} USING (metric)
WHERE CASE operator WHEN '>' THEN latest > threshold WHEN '<' THEN latest < threshold
                    WHEN '>=' THEN latest >= threshold WHEN '<=' THEN latest <= threshold
                    WHEN '==' THEN latest = threshold ELSE false END""")
def alert_rules(spark, sf_dir):
    p = points(spark, sf_dir)
    a = AL.evaluate_rules(p, AL.rules_frame(spark), latest_time(p))
    return a.select("id", "severity", "component", "message", "metric", "current_value",
                    "threshold")


def alert_log(spark, sf_dir):
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "purchase"))
    ts = F.col("ts").cast("timestamp")
    component = F.concat(F.lit("user."), (F.col("user_id") % 10).cast("string"))
    hour = F.floor(F.unix_seconds(ts) / 3600).cast("long")
    severity = (F.when(F.col("value") < 20, F.lit("INFO")).when(F.col("value") < 60, F.lit("WARNING"))
                 .when(F.col("value") < 120, F.lit("ERROR")).otherwise(F.lit("CRITICAL")))
    return ev.select(
        F.concat(component, F.lit("_"), hour.cast("string")).alias("id"),
        F.when(F.col("event_type") == "error", F.lit("create")).otherwise(F.lit("resolve"))
         .alias("action"),
        ts.alias("ts"), F.col("event_id").alias("seq"), severity.alias("severity"),
        component.alias("component"),
        F.concat(F.lit("error event "), F.col("event_id").cast("string")).alias("message"))


_SQL_ALERTS = """
WITH log AS (
  SELECT 'user.' || CAST(user_id % 10 AS VARCHAR) || '_'
           || CAST(CAST(floor(epoch(CAST(ts AS TIMESTAMP)) / 3600) AS BIGINT) AS VARCHAR) AS id,
         CASE WHEN event_type = 'error' THEN 'create' ELSE 'resolve' END AS action,
         CAST(ts AS TIMESTAMP) AS ts, event_id AS seq,
         CASE WHEN value < 20 THEN 'INFO' WHEN value < 60 THEN 'WARNING'
              WHEN value < 120 THEN 'ERROR' ELSE 'CRITICAL' END AS severity,
         'user.' || CAST(user_id % 10 AS VARCHAR) AS component
  FROM events WHERE event_type IN ('error', 'purchase')),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS r
                     FROM log WHERE action = 'create') WHERE r = 1),
rz AS (SELECT id, ts AS rts, seq AS rseq FROM (
         SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS r
         FROM log WHERE action = 'resolve') WHERE r = 1),
state AS (
  SELECT c.id, c.ts AS created_at, c.seq, c.severity, c.component,
         coalesce(rz.rts > c.ts OR (rz.rts = c.ts AND rz.rseq > c.seq), false) AS resolved
  FROM c LEFT JOIN rz USING (id)),
active AS (SELECT * FROM state WHERE NOT resolved)
"""


def _state(spark, sf_dir):
    return AL.alert_state(alert_log(spark, sf_dir))


@register("alert_active", _SQL_ALERTS + """
SELECT id, component, severity, epoch_us(created_at) AS created_us, seq FROM active""")
def alert_active(spark, sf_dir):
    a = AL.active_alerts(_state(spark, sf_dir))
    return a.select("id", "component", "severity", F.unix_micros("created_at").alias("created_us"),
                    "seq")


@register("alert_critical", _SQL_ALERTS + """
SELECT id, component, epoch_us(created_at) AS created_us, resolved FROM state WHERE severity = 'CRITICAL'""")
def alert_critical(spark, sf_dir):
    """FLT-11: alerts of one severity, resolved or not."""
    a = AL.by_severity(_state(spark, sf_dir), "CRITICAL")
    return a.select("id", "component", F.unix_micros("created_at").alias("created_us"), "resolved")


_COMPARED = ((">", "v > t"), ("<", "v < t"), (">=", "v >= t"), ("<=", "v <= t"), ("==", "v = t"), ("!=", "false"))


@register("rule_comparisons", "WITH e AS (SELECT event_id, floor(value) AS v, CAST(event_id % 500 AS DOUBLE) AS t FROM events) "
          + " UNION ALL ".join(f"SELECT event_id, '{o}' AS operator, {c} AS breached FROM e" for o, c in _COMPARED))
def rule_comparisons(spark, sf_dir):
    """FLT-12: every comparison on every event, against a threshold by id."""
    ev = table(spark, sf_dir, "events").withColumn(
        "operator", F.explode(F.array(*[F.lit(o) for o, _ in _COMPARED])))
    return ev.select("event_id", "operator", AL.breached(
        F.floor("value").cast("double"), F.col("operator"), (F.col("event_id") % 500).cast("double")).alias("breached"))


@register("alert_last10", _SQL_ALERTS + """
SELECT id, component, severity, epoch_us(created_at) AS created_us, seq
FROM active ORDER BY created_at DESC, seq DESC LIMIT 10""")
def alert_last10(spark, sf_dir):
    a = AL.last_alerts(AL.active_alerts(_state(spark, sf_dir)))
    return a.select("id", "component", "severity", F.unix_micros("created_at").alias("created_us"),
                    "seq")


@register("system_health", _SQL_ALERTS + """
SELECT CASE WHEN count(*) FILTER (WHERE severity = 'CRITICAL') > 0 THEN 'CRITICAL'
            WHEN count(*) FILTER (WHERE severity = 'WARNING') > 0 THEN 'WARNING'
            WHEN count(*) > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status,
       count(*) AS total_alerts,
       count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
       count(*) FILTER (WHERE severity = 'WARNING') AS warning_alerts
FROM active""")
def system_health(spark, sf_dir):
    return AL.system_health(AL.active_alerts(_state(spark, sf_dir)))


@register("dashboard", _SQL_ALERTS + f""",
{_SQL_POINTS.replace("WITH", "").strip()},
panel AS ({_sql_summary(MT.PANEL_MINUTES, MT.KEY_METRICS).replace(_SQL_POINTS, "")}),
newest AS (SELECT * FROM active ORDER BY created_at DESC, seq DESC LIMIT 10),
health AS (
  SELECT count(*) AS total_alerts, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
         count(*) FILTER (WHERE severity = 'WARNING') AS warning_alerts FROM active),
sections AS (
  SELECT 'system_health' AS section, to_json(struct_pack(
      status := CASE WHEN critical_alerts > 0 THEN 'CRITICAL' WHEN warning_alerts > 0 THEN 'WARNING'
                     WHEN total_alerts > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END,
      total_alerts := total_alerts, critical_alerts := critical_alerts, warning_alerts := warning_alerts))::VARCHAR AS json
  FROM health
  UNION ALL
  SELECT 'performance_metrics', '{{' || coalesce(string_agg('"' || name || '":' || to_json(struct_pack(
      count := count, min := min, max := max, avg := avg, latest := latest))::VARCHAR, ',' ORDER BY name), '') || '}}'
  FROM panel
  UNION ALL
  SELECT 'active_alerts', '[' || coalesce(string_agg(to_json(struct_pack(
      id := id, created_at := strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z', severity := severity,
      component := component, message := 'error event ' || CAST(seq AS VARCHAR)))::VARCHAR, ','
      ORDER BY created_at DESC, seq DESC), '') || ']'
  FROM newest)
SELECT section, json, epoch_us((SELECT max(ts) FROM p)) AS timestamp FROM sections""")
def dashboard(spark, sf_dir):
    """ALR-6: the three sections as JSON texts."""
    p = points(spark, sf_dir)
    return AL.dashboard(p, _state(spark, sf_dir), latest_time(p), MT.KEY_METRICS) \
             .withColumn("timestamp", F.unix_micros("timestamp"))


# Timers: every event starts ``<event_type>_<event_id>``; three in four end
# ``floor(value * 1000)`` ms later; every 9th event also ends an unknown
# timer; every 5th uses its id again one hour later, for one second. One scan
# yields the whole timer log (start, end and stray end rows).
def _timer_log(spark, sf_dir):
    return timer_log_from(table(spark, sf_dir, "events"))


def timer_log_from(ev):
    """The timer log of an events frame (batch or stream)."""
    ts = F.col("ts").cast("timestamp")
    tid = F.concat(F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"))
    end_ts = F.timestamp_micros(F.unix_micros(ts) + F.floor(F.col("value") * 1000).cast("long") * 1000)
    rows = F.array_compact(F.array(
        F.struct(tid.alias("timer_id"), F.lit("start").alias("phase"), ts.alias("ts")),
        F.when(F.col("event_id") % 4 != 0,
               F.struct(tid.alias("timer_id"), F.lit("end").alias("phase"), end_ts.alias("ts"))),
        F.when(F.col("event_id") % 9 == 0,
               F.struct(F.concat(F.lit("ghost_"), F.col("event_id").cast("string")).alias("timer_id"),
                        F.lit("end").alias("phase"), ts.alias("ts"))),
        F.when(F.col("event_id") % 5 == 0,
               F.struct(tid.alias("timer_id"), F.lit("start").alias("phase"),
                        (ts + F.expr("INTERVAL 1 HOUR")).alias("ts"))),
        F.when(F.col("event_id") % 5 == 0,
               F.struct(tid.alias("timer_id"), F.lit("end").alias("phase"),
                        (ts + F.expr("INTERVAL '1:00:01' HOUR TO SECOND")).alias("ts")))))
    return ev.select(F.inline(rows))


SQL_TIMERS = """
SELECT event_type || '_' || CAST(event_id AS VARCHAR) AS timer_id,
       'performance.' || event_type || '.duration_ms' AS name,
       epoch_us(CAST(ts AS TIMESTAMP)) + CAST(floor(value * 1000) AS BIGINT) * 1000 AS end_us,
       CAST(CAST(floor(value * 1000) AS BIGINT) * 1000 AS DOUBLE) / 1000.0 AS value
FROM events WHERE event_id % 4 <> 0
UNION ALL
SELECT event_type || '_' || CAST(event_id AS VARCHAR), 'performance.' || event_type || '.duration_ms',
       epoch_us(CAST(ts AS TIMESTAMP)) + 3601000000, 1000.0
FROM events WHERE event_id % 5 = 0"""


@register("timer_durations", SQL_TIMERS)
def timer_durations(spark, sf_dir):
    d = MT.timer_durations(_timer_log(spark, sf_dir))
    return d.select("timer_id", "name", F.unix_micros("ts").alias("end_us"), "value")


@register("throughput_metrics", """
SELECT 'throughput.' || event_type || '.messages_per_second' AS name,
       epoch_us(CAST(ts AS TIMESTAMP)) // 60000000 * 60000000 AS ts_us,
       count(*) / 60.0 AS value
FROM events GROUP BY event_type, 2""")
def throughput_metrics(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    t = MT.throughput_metrics(ev, "event_type")
    return t.select("name", F.unix_micros("ts").alias("ts_us"), "value")


@register("error_metrics", """
SELECT 'errors.user' || CAST(user_id % 10 AS VARCHAR) || '.count' AS name,
       epoch_us(CAST(ts AS TIMESTAMP)) AS ts_us, 1.0::DOUBLE AS value,
       'error_type=code_' || json_extract_string(props, '$.k') || ',user_id='
         || CAST(user_id AS VARCHAR) AS tags
FROM events WHERE event_type = 'error'""")
def error_metrics(spark, sf_dir):
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error").select(
        F.concat(F.lit("user"), (F.col("user_id") % 10).cast("string")).alias("component"),
        F.concat(F.lit("code_"), F.get_json_object("props", "$.k")).alias("error_type"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("tags"))
    m = MT.error_metrics(ev, "component", "error_type", tags="tags")
    return m.select("name", F.unix_micros("ts").alias("ts_us"), "value",
                    map_text(F.col("tags")).alias("tags"))


# Streaming progress lines, one per (event type, minute) as a listener would
# write them; the signup stream is stateless (empty stateOperators).
def progress_lines(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    minute = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60).cast("long")
    g = ev.groupBy("event_type", minute.alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < 5).alias("late"))
    ops = F.when(F.col("event_type") == "signup", F.array().cast(
        "array<struct<numRowsTotal:bigint,memoryUsedBytes:bigint,numRowsDroppedByWatermark:bigint>>")
    ).otherwise(F.array(F.struct(
        F.col("n").alias("numRowsTotal"), (F.col("n") * 4096).alias("memoryUsedBytes"),
        F.col("late").alias("numRowsDroppedByWatermark"))))
    doc = F.to_json(F.struct(
        F.concat(F.lit("query-"), F.col("event_type")).alias("id"),
        F.concat(F.col("event_type"), F.lit("_stream")).alias("name"),
        iso_text(F.timestamp_seconds(F.col("batch") * 60)).alias("timestamp"),
        F.col("batch").alias("batchId"),
        (F.col("n") / F.lit(60.0)).alias("inputRowsPerSecond"),
        (F.col("n") / F.lit(30.0)).alias("processedRowsPerSecond"),
        F.create_map(F.lit("triggerExecution"), F.col("n") * 7 + F.col("batch") % 13).alias("durationMs"),
        ops.alias("stateOperators")))
    return g.select(doc.alias("json"))


_SQL_PROGRESS = """
WITH g AS (
  SELECT event_type, CAST(floor(epoch(CAST(ts AS TIMESTAMP)) / 60) AS BIGINT) AS batch,
         count(*) AS n, count(*) FILTER (WHERE value < 5) AS late
  FROM events GROUP BY 1, 2),
pm AS (
  SELECT 'query-' || event_type AS query_id, event_type || '_stream' AS name,
         batch * 60000000 AS timestamp_us, batch AS batch_id,
         n / 60.0 AS input_rows_per_second, n / 30.0 AS processed_rows_per_second,
         n * 7 + batch % 13 AS batch_duration_ms,
         CASE WHEN event_type = 'signup' THEN 0.0 ELSE n * 4096 / (1024.0 * 1024.0) END
           AS state_store_memory_mb,
         CASE WHEN event_type = 'signup' THEN 0 ELSE late END AS rows_dropped_by_watermark
  FROM g)
"""


def _progress(spark, sf_dir):
    return MT.progress_metrics(progress_lines(spark, sf_dir))


def _progress_out(df):
    return df.select("query_id", "name", F.unix_micros("timestamp").alias("timestamp_us"),
                     "batch_id", "input_rows_per_second", "processed_rows_per_second",
                     "batch_duration_ms", "state_store_memory_mb", "rows_dropped_by_watermark")


@register("progress_metrics", _SQL_PROGRESS + "SELECT * FROM pm")
def progress_metrics(spark, sf_dir):
    return _progress_out(_progress(spark, sf_dir))


@register("progress_latest", _SQL_PROGRESS + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY batch_id DESC) AS r
               FROM pm) WHERE r = 1""".replace("SELECT * FROM (SELECT *", "SELECT query_id, name, timestamp_us, batch_id, input_rows_per_second, processed_rows_per_second, batch_duration_ms, state_store_memory_mb, rows_dropped_by_watermark FROM (SELECT *"))
def progress_latest(spark, sf_dir):
    return _progress_out(MT.latest_progress(_progress(spark, sf_dir)))
