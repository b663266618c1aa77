"""Registered message-path queries over the ``iot`` view: envelope round trip,
processed records, stream alerts, topic dispatch, routing and shifts
(PRJ-1/2/3/5/6/12/13, SNK-6, FLT-1/2/3/8, ALR-1/2).

Fault injection, by ``event_id``: every 17th message has no device id, every
19th no message timestamp (the envelope's is used: D1), every 23rd no sensor
map, every 11th a non-numeric temperature.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import messages as M
from driftwood.operators.windows import extract_metrics
from driftwood.plans.registry import register, with_views
from driftwood.plans.views import SQL_IOT, iot

# Topic of each event type, and the topics with a handler.
TOPIC_OF = {"click": "iot-streaming-data", "view": "iot-streaming-data",
            "purchase": "iot-processed-data", "error": "iot-alerts",
            "signup": "device-registry"}
HANDLED = ["iot-streaming-data", "iot-alerts"]


def _s(c):
    return F.col(c).cast("string")


def message_rows(spark, sf_dir):
    return message_rows_from(iot(spark, sf_dir))


def message_rows_from(i):
    """The messages of an ``iot`` frame (batch or stream)."""
    eid = F.col("event_id")
    temp_text = F.when(eid % 11 == 0, F.lit("n/a")).otherwise(_s("temperature"))
    data = F.when(eid % 23 == 0, F.lit(None)).otherwise(F.create_map(
        F.lit("temperature"), temp_text, F.lit("humidity"), _s("humidity"),
        F.lit("pressure"), _s("pressure"), F.lit("vibration"), _s("vibration")))
    topic = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in TOPIC_OF.items()],
                       F.lit("unknown"))
    return i.select(
        "event_id", "event_time", topic.alias("topic"),
        F.when(eid % 19 == 0, F.lit(None)).otherwise(M.iso_text(F.col("event_time")))
         .alias("timestamp"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("device_id")).alias("device_id"),
        "protocol", data.alias("data"),
        F.create_map(F.lit("event_id"), _s("event_id"), F.lit("source"), F.lit("events"))
         .alias("metadata"))


def kafka_rows(spark, sf_dir):
    """SNK-6: the producer side (key, JSON value, topic, headers)."""
    return kafka_rows_from(message_rows(spark, sf_dir))


def kafka_rows_from(m):
    env_ts = M.iso_text(F.col("event_time") + F.expr("INTERVAL 2 SECONDS"))
    return M.to_envelope(m, env_ts, topic=F.col("topic"),
                         headers={"source": F.lit("events")})


_SQL_MSG = with_views(SQL_IOT, """
msg AS (
  SELECT *,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE device_id END AS dev,
         event_id % 19 <> 0 AS has_ts,
         event_id % 23 <> 0 AS has_data,
         CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(temperature AS VARCHAR) END AS temp_text,
         CASE event_type WHEN 'click' THEN 'iot-streaming-data' WHEN 'view' THEN 'iot-streaming-data'
              WHEN 'purchase' THEN 'iot-processed-data' WHEN 'error' THEN 'iot-alerts'
              WHEN 'signup' THEN 'device-registry' ELSE 'unknown' END AS topic
  FROM iot)""")


@register("envelope_roundtrip", _SQL_MSG + """
SELECT dev AS device_id, protocol, topic, event_id,
       CASE WHEN has_ts THEN epoch_us(event_time) ELSE epoch_us(event_time) + 2000000 END
         AS event_time_us,
       CASE WHEN has_data AND event_id % 11 <> 0 THEN temperature END AS temperature,
       CASE WHEN has_data THEN humidity END AS humidity,
       CASE WHEN has_data THEN pressure END AS pressure,
       CASE WHEN has_data THEN vibration END AS vibration
FROM msg WHERE dev IS NOT NULL""")
def envelope_roundtrip(spark, sf_dir):
    parsed = M.parse_envelope(kafka_rows(spark, sf_dir))
    flat = extract_metrics(M.flatten_messages(parsed))
    return flat.select(
        "device_id", "protocol", "topic",
        F.col("metadata")["event_id"].cast("long").alias("event_id"),
        F.unix_micros("event_time").alias("event_time_us"),
        "temperature", "humidity", "pressure", "vibration")


_SQL_METRICS_TEXT = """CASE WHEN has_data THEN
    'humidity=' || CAST(humidity AS VARCHAR) || ',pressure=' || CAST(pressure AS VARCHAR)
    || ',temperature=' || temp_text || ',vibration=' || CAST(vibration AS VARCHAR)
  ELSE '' END"""


@register("processed_records", _SQL_MSG + f"""
SELECT dev AS device_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
       {_SQL_METRICS_TEXT} AS metrics,
       'event_id=' || CAST(event_id AS VARCHAR) || ',source=events' AS metadata
FROM msg WHERE dev IS NOT NULL AND has_ts""")
def processed_records(spark, sf_dir):
    p = M.processed_records(M.parse_envelope(kafka_rows(spark, sf_dir)))
    return p.select("device_id", "timestamp", M.map_text(F.col("metrics")).alias("metrics"),
                    M.map_text(F.col("metadata")).alias("metadata"))


@register("high_temperature_alerts", _SQL_MSG + """
SELECT dev AS device_id, 'HIGH_TEMPERATURE' AS alert_type, temperature AS value,
       80.0::DOUBLE AS threshold, 'WARNING' AS severity
FROM msg WHERE dev IS NOT NULL AND has_ts AND has_data AND event_id % 11 <> 0
  AND temperature > 80""")
def high_temperature_alerts(spark, sf_dir):
    p = M.processed_records(M.parse_envelope(kafka_rows(spark, sf_dir)))
    return M.temperature_alerts(p).drop("timestamp")


@register("topic_dispatch", _SQL_MSG + f"""
SELECT topic, count(*) AS messages, topic IN {tuple(HANDLED)!r} AS handled
FROM msg GROUP BY topic""")
def topic_dispatch(spark, sf_dir):
    parsed = M.parse_envelope(kafka_rows(spark, sf_dir))
    return M.dispatch_counts(parsed, HANDLED)


# Flow documents (variant 1) built from iot rows; faults as above.
def _documents(spark, sf_dir):
    i = iot(spark, sf_dir)
    eid = F.col("event_id")
    doc = F.to_json(F.struct(
        F.when(eid % 19 == 0, F.lit(None)).otherwise(M.iso_text(F.col("event_time")))
         .alias("timestamp"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("device_id")).alias("deviceId"),
        F.struct("temperature", "humidity").alias("sensorData"),
        F.concat(F.lit("zone-"), (F.col("user_id") % 7).cast("string")).alias("location"),
        F.concat(F.lit("v"), (eid % 3).cast("string")).alias("firmware"),
        eid.alias("seq")))
    return i.select("event_id", doc.alias("doc"))


_SQL_DOCS = with_views(SQL_IOT, """
docs AS (
  SELECT event_id,
         CASE WHEN event_id % 19 = 0 THEN NULL
              ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE device_id END AS device_id,
         'humidity=' || CAST(humidity AS VARCHAR) || ',temperature=' || CAST(temperature AS VARCHAR)
           AS metrics,
         'zone-' || CAST(user_id % 7 AS VARCHAR) AS geo_location,
         'firmware=v' || CAST(event_id % 3 AS VARCHAR) || ',seq=' || CAST(event_id AS VARCHAR)
           AS extra
  FROM iot)""")


@register("shift_document", _SQL_DOCS + "SELECT * FROM docs")
def shift_document(spark, sf_dir):
    s = _documents(spark, sf_dir).select("event_id", M.shift_document(F.col("doc")).alias("s"))
    return s.select("event_id", "s.event_time", "s.device_id",
                    M.map_text(F.col("s.metrics")).alias("metrics"), "s.geo_location",
                    M.map_text(F.col("s.extra")).alias("extra"))


@register("route_valid_invalid", _SQL_DOCS + """
SELECT event_id, device_id,
       CASE WHEN device_id IS NOT NULL AND event_time IS NOT NULL THEN 'valid' ELSE 'invalid' END
         AS route
FROM docs""")
def route_valid_invalid(spark, sf_dir):
    s = _documents(spark, sf_dir).select("event_id", M.shift_document(F.col("doc")).alias("s"))
    return M.route_valid(s.select("event_id", "s.device_id", "s.event_time")).drop("event_time")


@register("shift_nested", with_views(SQL_IOT) + """
SELECT event_id,
       CASE WHEN event_id % 19 = 0 THEN NULL
            ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE device_id END AS device_id,
       temperature, humidity, pressure,
       CAST(user_id % 90 AS DOUBLE) + 0.5 AS latitude,
       -CAST(user_id % 180 AS DOUBLE) - 0.25 AS longitude,
       'firmware=v' || CAST(event_id % 3 AS VARCHAR) || ',protocol=' || protocol
         AS device_metadata
FROM iot""")
def shift_nested(spark, sf_dir):
    i = iot(spark, sf_dir)
    eid = F.col("event_id")
    doc = F.to_json(F.struct(
        F.when(eid % 19 == 0, F.lit(None)).otherwise(M.iso_text(F.col("event_time")))
         .alias("timestamp"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("device_id")).alias("deviceId"),
        "temperature", "humidity", "pressure",
        F.struct(((F.col("user_id") % 90).cast("double") + 0.5).alias("lat"),
                 (-(F.col("user_id") % 180).cast("double") - 0.25).alias("lon")).alias("location"),
        F.create_map(F.lit("firmware"), F.concat(F.lit("v"), (eid % 3).cast("string")),
                     F.lit("protocol"), F.col("protocol")).alias("metadata"),
        F.col("event_type").alias("unlisted")))
    s = i.select("event_id", M.shift_nested(doc).alias("s"))
    return s.select("event_id", "s.event_time", "s.device_id", "s.metrics.temperature",
                    "s.metrics.humidity", "s.metrics.pressure", "s.geo_location.latitude",
                    "s.geo_location.longitude",
                    M.map_text(F.col("s.device_metadata")).alias("device_metadata"))


# Consumer view of the produced rows: partition = event_id % 6, offset =
# event_id div 6, record time = the event time in epoch milliseconds.
@register("kafka_consumer_records", _SQL_MSG + """
SELECT topic, CAST(event_id % 6 AS INTEGER) AS partition, event_id // 6 AS offset, dev AS key,
       dev AS device_id, 'source=events' AS headers,
       strftime(make_timestamp((epoch_us(event_time) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%g')
         AS timestamp
FROM msg""")
def kafka_consumer_records(spark, sf_dir):
    m = message_rows(spark, sf_dir)
    envelope = F.to_json(F.struct(
        M.iso_text(F.col("event_time")).alias("timestamp"),
        F.struct("timestamp", "device_id", "protocol", "data", "metadata").alias("data")))
    produced = m.select(
        F.col("device_id").cast("binary").alias("key"),
        envelope.cast("binary").alias("value"),
        "topic",
        (F.col("event_id") % 6).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 6).cast("long").alias("offset"),
        F.floor(F.unix_micros("event_time") / 1000).cast("long").alias("timestamp"),
        F.array(F.struct(F.lit("source").alias("key"),
                         F.lit("events").cast("binary").alias("value"))).alias("headers"))
    c = M.consumer_records(produced)
    return c.select("topic", "partition", "offset", "key",
                    F.col("value.data.device_id").alias("device_id"),
                    M.map_text(F.col("headers")).alias("headers"), "timestamp")
