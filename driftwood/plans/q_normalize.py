"""Registered protocol-normalisation queries over a landing table of payloads
derived from ``events`` (NRM-1..7, SET-2, FLT-7).

Landing rows, by ``event_id``: the protocol is the (event_id % 5)-th of the
five; MQTT topics cycle over ``actuators/dev<u>/status``,
``sensors/dev<u>/data`` and ``sensors/dev<u>/raw/extra`` (every 29th is
``x``); the payload is ``props`` (a JSON object), every 13th is broken
text, every 31st a bare JSON scalar, every 17th an object with text behind it,
every 19th one with ``] x`` and every 23rd one with ``}`` behind it; every
26th TCP payload starts with bytes that are not UTF-8; every 7th CoAP response failed (4.04).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.functions.text import topic_matches
from driftwood.operators import normalize as N
from driftwood.operators.messages import map_text
from driftwood.plans.registry import register, with_views
from driftwood.plans.views import PROTOCOLS, SQL_IOT, iot

# OIDs and resources polled, MQTT subscriptions.
OIDS = ["1.3.6.1.2.1.1.1.0", "1.3.6.1.2.1.1.3.0", "1.3.6.1.2.1.2.2.1.10.1"]
RESOURCES = ["/sensors/temperature", "/sensors/humidity"]
SUBSCRIPTIONS = ["sensors/+/data", "actuators/+/status"]


def landing(spark, sf_dir):
    return landing_from(iot(spark, sf_dir))


def landing_from(i):
    """The landing rows of an ``iot`` frame (batch or stream)."""
    eid, u = F.col("event_id"), F.col("user_id")
    us = u.cast("string")
    text = (F.when(eid % 13 == 0, F.concat(F.lit("broken "), F.col("props")))
             .when(eid % 31 == 0, F.lit("42"))
             .when(eid % 17 == 0, F.concat(F.col("props"), F.lit(" trailing")))
             .when(eid % 19 == 0, F.concat(F.col("props"), F.lit("] x")))
             .when(eid % 23 == 0, F.concat(F.col("props"), F.lit("}"))).otherwise(F.col("props")))
    proto = F.element_at(F.array(*[F.lit(p) for p in PROTOCOLS]), (eid % 5 + 1).cast("int"))
    payload = F.when((proto == "TCP") & (eid % 26 == 0),
                     F.concat(F.unhex(F.lit("FF00")), text.cast("binary"))
                     ).otherwise(text.cast("binary"))
    topic = (F.when(eid % 29 == 0, F.lit("x"))
              .when(eid % 3 == 0, F.concat(F.lit("actuators/dev"), us, F.lit("/status")))
              .when(eid % 3 == 1, F.concat(F.lit("sensors/dev"), us, F.lit("/data")))
              .otherwise(F.concat(F.lit("sensors/dev"), us, F.lit("/raw/extra"))))
    return i.select(
        eid.alias("source_id"), proto.alias("protocol"), F.col("event_time").alias("received_at"),
        topic.alias("topic"), (eid % 3).cast("int").alias("qos"), (eid % 2 == 0).alias("retain"),
        F.concat(F.lit("10.0."), (u % 256).cast("string")).alias("host"),
        (F.lit(8000) + u % 10).cast("int").alias("port"),
        F.concat(F.lit("ws://gw"), (u % 4).cast("string"), F.lit("/iot")).alias("uri"),
        F.element_at(F.array(*[F.lit(r) for r in RESOURCES]), (eid % 2 + 1).cast("int"))
         .alias("resource"),
        F.when(eid % 7 == 0, F.lit("4.04")).otherwise(F.lit("2.05")).alias("response_code"),
        F.lit("public").alias("community"),
        F.element_at(F.array(*[F.lit(o) for o in OIDS]), (eid % 3 + 1).cast("int")).alias("oid"),
        F.col("temperature").cast("string").alias("oid_value"),
        F.concat(F.lit("p"), F.floor(eid / 10).cast("string")).alias("poll_id"),
        F.when((proto == "TCP") & (eid % 4 == 0), F.lit("industrial_plc")).alias("device_id"),
        payload.alias("payload"))


def shown(df, *extra):
    return df.select("source_id", "device_id", "protocol",
                     F.unix_micros("timestamp").alias("timestamp_us"),
                     map_text(F.col("data")).alias("data"),
                     map_text(F.col("metadata")).alias("metadata"), *extra)


_SQL_RAW = with_views(SQL_IOT, f"""
raw AS (
  SELECT event_id AS source_id, {PROTOCOLS!r}[CAST(event_id % 5 AS INTEGER) + 1] AS protocol,
         event_time AS received_at, user_id, event_id, props,
         CASE WHEN event_id % 13 = 0 THEN 'broken ' || props
              WHEN event_id % 31 = 0 THEN '42'
              WHEN event_id % 17 = 0 THEN props || ' trailing'
              WHEN event_id % 19 = 0 THEN props || '] x'
              WHEN event_id % 23 = 0 THEN props || '}}' ELSE props END AS text,
         CASE WHEN event_id % 29 = 0 THEN 'x'
              WHEN event_id % 3 = 0 THEN 'actuators/dev' || CAST(user_id AS VARCHAR) || '/status'
              WHEN event_id % 3 = 1 THEN 'sensors/dev' || CAST(user_id AS VARCHAR) || '/data'
              ELSE 'sensors/dev' || CAST(user_id AS VARCHAR) || '/raw/extra' END AS topic,
         '10.0.' || CAST(user_id % 256 AS VARCHAR) AS host,
         CAST(8000 + user_id % 10 AS INTEGER) AS port,
         'ws://gw' || CAST(user_id % 4 AS VARCHAR) || '/iot' AS uri,
         {RESOURCES!r}[CAST(event_id % 2 AS INTEGER) + 1] AS resource,
         {OIDS!r}[CAST(event_id % 3 AS INTEGER) + 1] AS oid,
         CAST(temperature AS VARCHAR) AS oid_value,
         'p' || CAST(event_id // 10 AS VARCHAR) AS poll_id
  FROM iot)""", """
texts AS (
  SELECT *, CASE WHEN json_valid(text) AND text LIKE '{%' THEN 'k=' || json_extract_string(text, '$.k') END AS obj
  FROM raw)""")

_SQL_MQTT = """
SELECT source_id, coalesce(string_split(topic, '/')[2], 'unknown') AS device_id, 'MQTT' AS protocol,
       epoch_us(received_at) AS timestamp_us,
       coalesce(obj, 'raw_message=' || text) AS data,
       'qos=' || CAST(event_id % 3 AS VARCHAR) || ',retain=' || CAST(event_id % 2 = 0 AS VARCHAR)
         || ',topic=' || topic AS metadata
FROM texts WHERE protocol = 'MQTT'"""

_SQL_WS = """
SELECT source_id, 'websocket_client' AS device_id, 'WebSocket' AS protocol,
       epoch_us(received_at) AS timestamp_us,
       coalesce(obj, 'raw_message=' || text) AS data,
       'message_size=' || CAST(length(text) AS VARCHAR) || ',uri=' || uri AS metadata
FROM texts WHERE protocol = 'WebSocket'"""

_SQL_TCP = """
SELECT source_id,
       CASE WHEN event_id % 4 = 0 THEN 'industrial_plc'
            ELSE 'tcp_' || host || '_' || CAST(port AS VARCHAR) END AS device_id,
       'TCP' AS protocol, epoch_us(received_at) AS timestamp_us,
       CASE WHEN event_id % 26 = 0
            THEN 'raw_binary=' || lower(hex('\\xFF\\x00'::BLOB || encode(text)))
                 || ',size=' || CAST(octet_length(encode(text)) + 2 AS VARCHAR)
            ELSE coalesce(obj, 'raw_text=' || text) END AS data,
       'data_size=' || CAST(octet_length(encode(text)) + CASE WHEN event_id % 26 = 0 THEN 2 ELSE 0 END
                            AS VARCHAR)
         || ',host=' || host || ',port=' || CAST(port AS VARCHAR) AS metadata
FROM texts WHERE protocol = 'TCP'"""

_SQL_SNMP_FOLD = """
snmp_last AS (
  SELECT 'snmp_' || host AS device_id, poll_id, host, port, oid,
         arg_max(oid_value, source_id) AS v, max(received_at) AS received_at,
         min(source_id) AS first_id
  FROM raw WHERE protocol = 'SNMP' GROUP BY ALL),
snmp AS (
  SELECT min(first_id) AS source_id, device_id, 'SNMP' AS protocol,
         epoch_us(max(received_at)) AS timestamp_us,
         string_agg(oid || '=' || v, ',' ORDER BY oid) AS data,
         'community=public,host=' || host || ',port=' || CAST(port AS VARCHAR) AS metadata,
         poll_id
  FROM snmp_last GROUP BY device_id, poll_id, host, port)"""

_SQL_COAP_FOLD = """
coap_last AS (
  SELECT 'coap_' || host AS device_id, poll_id, host, port, resource,
         arg_max(CASE WHEN json_valid(text) THEN CAST(json(text) AS VARCHAR)
                      ELSE CAST(json_object('raw_data', text) AS VARCHAR) END, source_id) AS v,
         max(received_at) AS received_at, min(source_id) AS first_id
  FROM raw WHERE protocol = 'CoAP' AND event_id % 7 <> 0 GROUP BY ALL),
coap AS (
  SELECT min(first_id) AS source_id, device_id, 'CoAP' AS protocol,
         epoch_us(max(received_at)) AS timestamp_us,
         string_agg(resource || '=' || v, ',' ORDER BY resource) AS data,
         'host=' || host || ',port=' || CAST(port AS VARCHAR)
           || ',resources=/sensors/temperature,/sensors/humidity' AS metadata,
         poll_id
  FROM coap_last GROUP BY device_id, poll_id, host, port)"""


@register("mqtt_normalize", _SQL_RAW + _SQL_MQTT)
def mqtt_normalize(spark, sf_dir):
    return shown(N.normalize_mqtt(landing(spark, sf_dir)))


@register("websocket_normalize", _SQL_RAW + _SQL_WS)
def websocket_normalize(spark, sf_dir):
    return shown(N.normalize_websocket(landing(spark, sf_dir)))


@register("tcp_normalize", _SQL_RAW + _SQL_TCP)
def tcp_normalize(spark, sf_dir):
    return shown(N.normalize_tcp(landing(spark, sf_dir)))


@register("snmp_fold", _SQL_RAW + "," + _SQL_SNMP_FOLD + "\nSELECT * FROM snmp")
def snmp_fold(spark, sf_dir):
    return shown(N.fold_snmp(landing(spark, sf_dir)), "poll_id")


@register("coap_fold", _SQL_RAW + "," + _SQL_COAP_FOLD + "\nSELECT * FROM coap")
def coap_fold(spark, sf_dir):
    return shown(N.fold_coap(landing(spark, sf_dir), resources=RESOURCES), "poll_id")


SQL_PROTOCOLS = _SQL_RAW + "," + _SQL_SNMP_FOLD + "," + _SQL_COAP_FOLD
SQL_MESSAGES = f"""
{_SQL_MQTT}
UNION ALL {_SQL_WS}
UNION ALL {_SQL_TCP}
UNION ALL SELECT source_id, device_id, protocol, timestamp_us, data, metadata FROM snmp
UNION ALL SELECT source_id, device_id, protocol, timestamp_us, data, metadata FROM coap"""


@register("protocol_union", SQL_PROTOCOLS + SQL_MESSAGES)
def protocol_union(spark, sf_dir):
    return shown(N.normalize_all(landing(spark, sf_dir), resources=RESOURCES))


@register("topic_filter", _SQL_RAW + """
SELECT source_id, topic,
       regexp_full_match(topic, '(sensors/[^/]+/data)|(actuators/[^/]+/status)') AS matched
FROM raw WHERE protocol = 'MQTT'""")
def topic_filter(spark, sf_dir):
    r = landing(spark, sf_dir).where(F.col("protocol") == "MQTT")
    return r.select("source_id", "topic", topic_matches("topic", SUBSCRIPTIONS).alias("matched"))
