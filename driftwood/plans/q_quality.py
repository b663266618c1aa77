"""Registered quality and profile queries (QUA-1..13, AGG-5..10, WIN-3, SRT-4).

Messages are JSON documents built from the ``iot`` view with faults injected
by ``event_id``: every 7th device id is empty, every 31st has a ``#``, every
19th message has no device id at all; every 13th timestamp is not a
timestamp; every 17th protocol is UNKNOWN; every 11th temperature is the
text "not-a-number"; every 23rd humidity is JSON null; every 29th pressure
has three decimals. Readings out of range come from the data itself.
``as_of`` is fixed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from driftwood.operators import profile as P
from driftwood.operators import quality as Q
from driftwood.operators.messages import iso_text, map_text
from driftwood.plans.registry import r6, register, sql_r6, with_views
from driftwood.plans.views import SQL_IOT, iot

AS_OF = dt.datetime(2024, 1, 2, 3, 0, 0, tzinfo=dt.timezone.utc)
AS_OF_SQL = "TIMESTAMP '2024-01-02 03:00:00'"


def _kv(name, col):
    """``"name":<json value>`` for a non-null column (strings escaped)."""
    return F.regexp_extract(F.to_json(F.struct(col.alias(name))), r"^\{(.*)\}$", 1)


def quality_messages(spark, sf_dir):
    i = iot(spark, sf_dir)
    eid = F.col("event_id")
    dev = (F.when(eid % 7 == 0, F.lit(""))
            .when(eid % 31 == 0, F.concat(F.lit("dev#"), F.col("user_id").cast("string")))
            .otherwise(F.col("device_id")))
    ts = F.when(eid % 13 == 0, F.lit("invalid-timestamp")).otherwise(iso_text(F.col("event_time")))
    proto = F.when(eid % 17 == 0, F.lit("UNKNOWN")).otherwise(F.col("protocol"))
    parts = F.array(
        F.when(eid % 19 != 0, _kv("device_id", dev)),
        _kv("timestamp", ts),
        _kv("protocol", proto),
        F.when(eid % 11 == 0, F.lit('"temperature":"not-a-number"'))
         .otherwise(_kv("temperature", F.col("temperature"))),
        F.when(eid % 23 == 0, F.lit('"humidity":null'))
         .otherwise(_kv("humidity", F.col("humidity"))),
        _kv("pressure", F.when(eid % 29 == 0, F.col("pressure") + F.lit(0.257))
            .otherwise(F.col("pressure"))))
    json = F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}"))
    return P.parse_messages(i.select("event_id", json.alias("json")))


def _validated(spark, sf_dir):
    return Q.validate(quality_messages(spark, sf_dir), as_of=F.lit(AS_OF))


_SQL_Q = with_views(SQL_IOT, """
q AS (
  SELECT event_id, user_id,
         event_id % 19 <> 0 AS dev_present,
         CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 31 = 0 THEN 'dev#' || CAST(user_id AS VARCHAR)
              ELSE device_id END AS dev,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_time END AS ts,
         CASE WHEN event_id % 13 = 0 THEN 'invalid-timestamp'
              ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts_text,
         CASE WHEN event_id % 17 = 0 THEN 'UNKNOWN' ELSE protocol END AS proto,
         event_id % 11 = 0 AS temp_bad,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE temperature END AS temp,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE humidity END AS hum,
         CASE WHEN event_id % 29 = 0 THEN pressure + 0.257 ELSE pressure END AS pres
  FROM iot)""", f"""
c AS (
  SELECT *,
    dev_present AND NOT regexp_full_match(dev, '[a-zA-Z0-9_-]+') AS e_pattern,
    dev_present AND length(dev) < 3 AS e_short,
    dev_present AND length(dev) > 50 AS w_long,
    ts IS NULL AS e_format,
    ts IS NOT NULL AND epoch_us({AS_OF_SQL}) - epoch_us(ts) > 86400000000 AS w_age,
    temp_bad AS e_type,
    coalesce(temp < -50, false) AS e_tmin, coalesce(temp > 100, false) AS e_tmax,
    coalesce(round(temp, 2) <> temp, false) AS w_tprec,
    coalesce(hum < 0, false) AS e_hmin, coalesce(hum > 100, false) AS e_hmax,
    coalesce(round(hum, 2) <> hum, false) AS w_hprec,
    pres < 800 AS e_pmin, pres > 1200 AS e_pmax, round(pres, 2) <> pres AS w_pprec,
    proto NOT IN ('MQTT', 'SNMP', 'CoAP', 'TCP', 'WebSocket') AS e_allowed,
    coalesce(temp > 30 AND hum > 80, false) AS w_hot,
    coalesce(temp < 0 AND hum > 90, false) AS w_cold,
    proto = 'SNMP' AND dev_present AND NOT regexp_matches(dev, '^\\d+\\.\\d+\\.\\d+\\.\\d+')
      AND NOT regexp_matches(dev, '^snmp_') AS w_snmp
  FROM q)""", """
v AS (
  SELECT *,
    list_filter([
      CASE WHEN NOT dev_present THEN 'Missing required field: device_id' END,
      CASE WHEN e_pattern THEN 'device_id: Does not match required pattern' END,
      CASE WHEN e_short THEN 'device_id: Too short (min: 3)' END,
      CASE WHEN e_format THEN 'timestamp: Invalid timestamp format' END,
      CASE WHEN e_type THEN 'temperature: Invalid type. Expected float' END,
      CASE WHEN e_tmin THEN 'temperature: Below minimum (-50.0)' END,
      CASE WHEN e_tmax THEN 'temperature: Above maximum (100.0)' END,
      CASE WHEN e_hmin THEN 'humidity: Below minimum (0.0)' END,
      CASE WHEN e_hmax THEN 'humidity: Above maximum (100.0)' END,
      CASE WHEN e_pmin THEN 'pressure: Below minimum (800.0)' END,
      CASE WHEN e_pmax THEN 'pressure: Above maximum (1200.0)' END,
      CASE WHEN e_allowed THEN 'protocol: Invalid value. Allowed: [''MQTT'', ''SNMP'', ''CoAP'', ''TCP'', ''WebSocket'']' END
    ], lambda x: x IS NOT NULL) AS errors,
    list_filter([
      CASE WHEN w_long THEN 'device_id: Too long (max: 50)' END,
      CASE WHEN w_age THEN 'timestamp: Timestamp is too old' END,
      CASE WHEN w_tprec THEN 'temperature: Too many decimal places' END,
      CASE WHEN w_hprec THEN 'humidity: Too many decimal places' END,
      CASE WHEN w_pprec THEN 'pressure: Too many decimal places' END,
      CASE WHEN w_hot THEN 'Unusual: High temperature with high humidity' END,
      CASE WHEN w_cold THEN 'Suspicious: Sub-zero temperature with very high humidity' END,
      CASE WHEN w_snmp THEN 'SNMP device ID format may be incorrect' END
    ], lambda x: x IS NOT NULL) AS warnings,
    greatest(0.0, 100.0 - (CASE WHEN NOT dev_present THEN 20 ELSE 0 END
      + 10 * e_pattern::INT + 5 * e_short::INT + 15 * e_format::INT + 15 * e_type::INT
      + 10 * e_tmin::INT + 10 * e_tmax::INT + 10 * e_hmin::INT + 10 * e_hmax::INT
      + 10 * e_pmin::INT + 10 * e_pmax::INT + 10 * e_allowed::INT))::DOUBLE AS quality_score,
    array_to_string(list_filter([
      CASE WHEN dev_present THEN 'device_id_quality=' || CAST(greatest(0, 100 - 20 * e_pattern::INT
           - 15 * e_short::INT - 5 * w_long::INT)::DOUBLE AS VARCHAR) END,
      CASE WHEN hum IS NOT NULL THEN 'humidity_quality=' || CAST(greatest(0, 100 - 20 * e_hmin::INT
           - 20 * e_hmax::INT - 5 * w_hprec::INT)::DOUBLE AS VARCHAR) END,
      'pressure_quality=' || CAST(greatest(0, 100 - 20 * e_pmin::INT - 20 * e_pmax::INT
           - 5 * w_pprec::INT)::DOUBLE AS VARCHAR),
      'protocol_quality=' || CAST(greatest(0, 100 - 25 * e_allowed::INT)::DOUBLE AS VARCHAR),
      'temperature_quality=' || CAST(greatest(0, 100 - 30 * e_type::INT - 20 * e_tmin::INT
           - 20 * e_tmax::INT - 5 * w_tprec::INT)::DOUBLE AS VARCHAR),
      'timestamp_quality=' || CAST(greatest(0, 100 - 30 * e_format::INT - 10 * w_age::INT)::DOUBLE
           AS VARCHAR)
    ], lambda x: x IS NOT NULL), ',') AS metrics
  FROM c)""")


@register("quality_rows", _SQL_Q + """
SELECT event_id, len(errors) = 0 AS is_valid, quality_score,
       array_to_string(errors, ' | ') AS errors, array_to_string(warnings, ' | ') AS warnings,
       metrics
FROM v""")
def quality_rows(spark, sf_dir):
    v = _validated(spark, sf_dir).select("event_id", "validation.*")
    return v.select("event_id", "is_valid", "quality_score",
                    F.array_join("errors", " | ").alias("errors"),
                    F.array_join("warnings", " | ").alias("warnings"),
                    map_text(F.col("metrics").cast("map<string,string>")).alias("metrics"))


@register("quality_summary", _SQL_Q + f"""
SELECT count(*) FILTER (WHERE len(errors) = 0) AS valid_messages,
       count(*) FILTER (WHERE len(errors) > 0) AS invalid_messages,
       {sql_r6('count(*) FILTER (WHERE len(errors) = 0) / count(*)')} AS validation_rate,
       CAST(sum(len(errors)) AS BIGINT) AS total_errors,
       CAST(sum(len(warnings)) AS BIGINT) AS total_warnings,
       {sql_r6('avg(quality_score)')} AS average_quality_score
FROM v""")
def quality_summary(spark, sf_dir):
    s = Q.quality_summary(_validated(spark, sf_dir))
    return (s.withColumn("validation_rate", r6("validation_rate"))
             .withColumn("average_quality_score", r6("average_quality_score")))


@register("quality_errors_by_rule", _SQL_Q + """
SELECT kind, message, count(*) AS n FROM (
  SELECT 'error' AS kind, unnest(errors) AS message FROM v
  UNION ALL SELECT 'warning', unnest(warnings) FROM v) GROUP BY kind, message""")
def quality_errors_by_rule(spark, sf_dir):
    return Q.errors_by_rule(_validated(spark, sf_dir))


@register("profile_timestamps", _SQL_Q + f"""
SELECT epoch_us(min(ts)) AS earliest_us, epoch_us(max(ts)) AS latest_us,
       {sql_r6('(epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0')} AS span_hours,
       {sql_r6('CASE WHEN count(ts) > 1 THEN (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 / (count(ts) - 1) ELSE 0.0 END')}
         AS average_interval_seconds,
       count(ts) AS total_timestamps
FROM q""")
def profile_timestamps(spark, sf_dir):
    t = P.profile_timestamps(quality_messages(spark, sf_dir))
    return t.select(F.unix_micros("earliest").alias("earliest_us"),
                    F.unix_micros("latest").alias("latest_us"),
                    r6("span_hours").alias("span_hours"),
                    r6("average_interval_seconds").alias("average_interval_seconds"),
                    "total_timestamps")


@register("profile_devices", _SQL_Q + """
SELECT CASE WHEN dev_present THEN dev ELSE 'unknown' END AS device_id,
       count(*) AS message_count,
       array_to_string(list_sort(list_distinct(list(proto))), '|') AS protocols,
       epoch_us(min(ts)) AS first_seen_us, epoch_us(max(ts)) AS last_seen_us
FROM q GROUP BY 1""")
def profile_devices(spark, sf_dir):
    d = P.profile_devices(quality_messages(spark, sf_dir))
    return d.select("device_id", "message_count",
                    F.array_join("protocols", "|").alias("protocols"),
                    F.unix_micros("first_seen").alias("first_seen_us"),
                    F.unix_micros("last_seen").alias("last_seen_us"))


@register("profile_protocols", _SQL_Q + """
SELECT proto AS protocol, count(*) AS messages FROM q GROUP BY proto""")
def profile_protocols(spark, sf_dir):
    return P.profile_protocols(quality_messages(spark, sf_dir))


@register("profile_fields", _SQL_Q + f""",
kv AS (
  SELECT 'device_id' AS field, false AS is_null, 'str' AS type, dev AS text FROM q WHERE dev_present
  UNION ALL SELECT 'timestamp', false, 'str', ts_text FROM q
  UNION ALL SELECT 'protocol', false, 'str', proto FROM q
  UNION ALL SELECT 'temperature', false, CASE WHEN temp_bad THEN 'str' ELSE 'float' END,
                   CASE WHEN temp_bad THEN 'not-a-number' ELSE CAST(temp AS VARCHAR) END FROM q
  UNION ALL SELECT 'humidity', hum IS NULL, 'float', CAST(hum AS VARCHAR) FROM q
  UNION ALL SELECT 'pressure', false, 'float', CAST(pres AS VARCHAR) FROM q),
stats AS (SELECT field, count(*) AS count, count(*) FILTER (WHERE is_null) AS null_count
          FROM kv GROUP BY field),
types AS (SELECT field, string_agg(type || '=' || CAST(n AS VARCHAR), ',' ORDER BY type) AS td
          FROM (SELECT field, type, count(*) AS n FROM kv WHERE NOT is_null GROUP BY ALL)
          GROUP BY field),
dist AS (SELECT DISTINCT field, text FROM kv WHERE NOT is_null),
nd AS (SELECT field, count(*) AS d FROM dist GROUP BY field),
smp AS (SELECT field, string_agg(text, '|' ORDER BY text) AS sample_values
        FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY text) AS r FROM dist)
        WHERE r <= 100 GROUP BY field)
SELECT s.field, s.count, s.null_count,
       {sql_r6('(s.count - s.null_count) / s.count')} AS completeness,
       coalesce(t.td, '') AS type_distribution,
       coalesce(nd.d, 0) AS distinct_values,
       {sql_r6('coalesce(nd.d, 0) / s.count')} AS uniqueness,
       coalesce(smp.sample_values, '') AS sample_values
FROM stats s LEFT JOIN types t USING (field) LEFT JOIN nd USING (field)
     LEFT JOIN smp USING (field)""")
def profile_fields(spark, sf_dir):
    f = P.profile_fields(quality_messages(spark, sf_dir))
    return (f.withColumn("completeness", r6("completeness"))
             .withColumn("uniqueness", r6("uniqueness")))


@register("profile_device_gaps", _SQL_Q + f""",
g AS (
  SELECT CASE WHEN dev_present THEN dev ELSE 'unknown' END AS device_id,
         epoch_us(ts) - lag(epoch_us(ts)) OVER (
           PARTITION BY CASE WHEN dev_present THEN dev ELSE 'unknown' END ORDER BY ts) AS gap
  FROM q WHERE ts IS NOT NULL)
SELECT device_id, count(gap) AS gaps, {sql_r6('min(gap) / 1e6')} AS min_gap_seconds,
       {sql_r6('max(gap) / 1e6')} AS max_gap_seconds,
       {sql_r6('sum(gap) / 1e6 / nullif(count(gap), 0)')} AS mean_gap_seconds
FROM g GROUP BY device_id""")
def profile_device_gaps(spark, sf_dir):
    g = P.device_gaps(quality_messages(spark, sf_dir))
    return g.select("device_id", "gaps", *(r6(c).alias(c) for c in (
        "min_gap_seconds", "max_gap_seconds", "mean_gap_seconds")))


@register("profile_dataset", _SQL_Q + """
SELECT 'total' AS section, count(*) AS n FROM q
UNION ALL SELECT 'timestamps', 1
UNION ALL SELECT 'devices', count(DISTINCT CASE WHEN dev_present THEN coalesce(dev, '-') ELSE 'unknown' END) FROM q
UNION ALL SELECT 'protocols', count(DISTINCT proto) FROM q
UNION ALL SELECT 'fields', 6
UNION ALL SELECT 'device_gaps', count(DISTINCT CASE WHEN dev_present THEN coalesce(dev, '-') ELSE 'unknown' END) FROM q WHERE ts IS NOT NULL""")
def profile_dataset(spark, sf_dir):
    """Rows of each section; the sections' contents have oracles of their own."""
    p = P.profile(quality_messages(spark, sf_dir))
    n = F.when(F.col("section") == "total", F.get_json_object("json", "$.total_records").cast("long")).otherwise(1)
    return p.groupBy("section").agg(F.sum(n).alias("n"))
