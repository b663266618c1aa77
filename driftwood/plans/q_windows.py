"""Registered sliding-window, anomaly and health queries over the ``iot`` view
(AGG-1, STR-2, SET-1, PRJ-4, ANO-1..5, FLT-6, HLT-1/2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import anomalies as A
from driftwood.operators import health as H
from driftwood.operators import windows as W
from driftwood.operators.calls import interval_micros
from driftwood.plans.registry import r6, register, sql_r6, sql_round, with_views
from driftwood.plans.views import SQL_IOT, iot

R6 = ["avg_temperature", "stddev_temperature", "avg_humidity", "avg_pressure",
      "avg_vibration"]


def compared(df):
    """Comparison form: epoch micros, 6-digit means and deviations."""
    out = df
    for c in R6:
        out = out.withColumn(c, r6(c))
    return (out.withColumn("window_start_us", F.unix_micros("window_start"))
               .withColumn("window_end_us", F.unix_micros("window_end"))
               .drop("window_start", "window_end"))


def sliding(spark, sf_dir, windows=W.DEFAULT_WINDOWS, method="panes"):
    return W.window_metrics(iot(spark, sf_dir), windows=windows, method=method)


def sql_window(length: str, slide: str) -> str:
    """One configuration in DuckDB: each reading goes to the ``length/slide``
    windows starting at its slide-aligned start and ``k`` slides earlier."""
    len_us, slide_us = interval_micros(length), interval_micros(slide)
    k = len_us // slide_us
    return f"""
SELECT device_id, protocol, '{length}' AS window_duration,
       ws AS window_start_us, ws + {len_us} AS window_end_us,
       count(*) AS message_count,
       avg(temperature) AS avg_temperature, max(temperature) AS max_temperature,
       min(temperature) AS min_temperature, stddev_samp(temperature) AS stddev_temperature,
       avg(humidity) AS avg_humidity, avg(pressure) AS avg_pressure,
       avg(vibration) AS avg_vibration, max(vibration) AS max_vibration
FROM (SELECT *, (epoch_us(event_time) // {slide_us}) * {slide_us} - k * {slide_us} AS ws
      FROM (SELECT *, unnest(range(0, {k})) AS k FROM iot
            WHERE device_id IS NOT NULL AND event_time IS NOT NULL))
GROUP BY device_id, protocol, ws"""


def sql_windows(windows) -> str:
    return "\nUNION ALL\n".join(sql_window(length, slide) for length, slide in windows)


def sql_compared(src: str) -> str:
    cols = ", ".join(f"{sql_r6(c)} AS {c}" for c in R6)
    return f"""SELECT device_id, protocol, window_duration, window_start_us, window_end_us,
       message_count, max_temperature, min_temperature, max_vibration, {cols}
FROM {src}"""


def _wins_sql(windows) -> str:
    return with_views(SQL_IOT, f"wins AS ({sql_windows(windows)})")


for _name, _cfg in (("sliding_1m", W.DEFAULT_WINDOWS[0]),
                    ("sliding_5m", W.DEFAULT_WINDOWS[1]),
                    ("sliding_15m", W.DEFAULT_WINDOWS[2])):
    def _q(spark, sf_dir, _cfg=_cfg):
        return compared(sliding(spark, sf_dir, windows=(_cfg,)))
    register(_name, _wins_sql((_cfg,)) + sql_compared("wins"))(_q)


@register("sliding_union", _wins_sql(W.DEFAULT_WINDOWS) + sql_compared("wins"))
def sliding_union(spark, sf_dir):
    return compared(sliding(spark, sf_dir))


@register("sliding_union_direct", _wins_sql(W.DEFAULT_WINDOWS) + sql_compared("wins"))
def sliding_union_direct(spark, sf_dir):
    """Same result through three ``window()`` aggregates (the streaming form)."""
    return compared(sliding(spark, sf_dir, method="direct"))


SQL_WIN_ANOMALIES = f"""
SELECT device_id, protocol, window_duration, window_start_us, window_end_us,
       'TEMPERATURE_EXTREME' AS anomaly_type,
       CASE WHEN max_temperature > 80 THEN max_temperature ELSE min_temperature END AS anomaly_value,
       'Temperature outside normal range' AS anomaly_description
FROM wins WHERE max_temperature > 80 OR min_temperature < -10
UNION ALL
SELECT device_id, protocol, window_duration, window_start_us, window_end_us,
       'HUMIDITY_EXTREME', avg_humidity, 'Humidity outside normal range'
FROM (SELECT *, {sql_round('avg_humidity', 9)} AS round_h FROM wins) WHERE round_h > 95 OR round_h < 5
UNION ALL
SELECT device_id, protocol, window_duration, window_start_us, window_end_us,
       'HIGH_VIBRATION', max_vibration, 'Excessive vibration detected'
FROM wins WHERE max_vibration > 100
UNION ALL
SELECT device_id, protocol, window_duration, window_start_us, window_end_us,
       'LOW_FREQUENCY', CAST(message_count AS DOUBLE), 'Low message frequency detected'
FROM wins WHERE message_count < 5"""


@register("anomalies_windowed", _wins_sql(W.DEFAULT_WINDOWS) + f"""
SELECT device_id, protocol, window_duration, window_start_us, window_end_us, anomaly_type,
       {sql_r6('anomaly_value')} AS anomaly_value, anomaly_description
FROM ({SQL_WIN_ANOMALIES})""")
def anomalies_windowed(spark, sf_dir):
    a = A.detect_anomalies(sliding(spark, sf_dir))
    return (a.withColumn("anomaly_value", r6("anomaly_value"))
             .withColumn("window_start_us", F.unix_micros("window_start"))
             .withColumn("window_end_us", F.unix_micros("window_end"))
             .drop("window_start", "window_end"))


@register("anomalies_row", with_views(SQL_IOT) + """
SELECT event_id, device_id, epoch_us(event_time) AS event_time_us,
       'TEMPERATURE_EXTREME' AS anomaly_type, temperature AS anomaly_value,
       'Temperature outside normal range' AS anomaly_description
FROM iot WHERE temperature > 80 OR temperature < -10
UNION ALL
SELECT event_id, device_id, epoch_us(event_time), 'HUMIDITY_EXTREME', humidity,
       'Humidity outside normal range'
FROM iot WHERE humidity > 95 OR humidity < 5
UNION ALL
SELECT event_id, device_id, epoch_us(event_time), 'HIGH_VIBRATION', vibration,
       'Excessive vibration detected'
FROM iot WHERE vibration > 100""")
def anomalies_row(spark, sf_dir):
    rows = iot(spark, sf_dir).withColumn("event_time_us", F.unix_micros("event_time"))
    return A.detect_anomalies(rows, A.row_rules(), keep=("event_id", "device_id",
                                                         "event_time_us"))


def _sql_ladder(col, bands, fallback):
    parts = " ".join(f"WHEN {col} >= {lo} AND {col} <= {hi} THEN {s}" for lo, hi, s in bands)
    return f"(CASE {parts} ELSE {fallback} END)"


def _sql_steps(col, steps, fallback, op):
    parts = " ".join(f"WHEN {col} {op} {e} THEN {s}" for e, s in steps)
    return f"(CASE {parts} ELSE {fallback} END)"


SQL_SCORE = (
    f"{_sql_ladder(sql_round('avg_temperature', 9), H.TEMPERATURE_BANDS, H.TEMPERATURE_ELSE)} * {H.TEMPERATURE_WEIGHT}::DOUBLE"
    f" + {_sql_ladder(sql_round('avg_humidity', 9), H.HUMIDITY_BANDS, H.HUMIDITY_ELSE)} * {H.HUMIDITY_WEIGHT}::DOUBLE"
    f" + {_sql_steps('max_vibration', H.VIBRATION_AT_MOST, H.VIBRATION_ELSE, '<=')} * {H.VIBRATION_WEIGHT}::DOUBLE"
    f" + {_sql_steps('message_count', H.COUNT_AT_LEAST, H.COUNT_ELSE, '>=')} * {H.COUNT_WEIGHT}::DOUBLE")
SQL_STATUS = "CASE " + " ".join(
    f"WHEN health_score >= {e} THEN '{n}'" for e, n in H.STATUS_AT_LEAST) + \
    f" ELSE '{H.STATUS_ELSE}' END"


@register("health_scores", _wins_sql(W.DEFAULT_WINDOWS) + f"""
SELECT device_id, protocol, window_duration, window_start_us,
       {sql_r6('health_score')} AS health_score, {SQL_STATUS} AS health_status
FROM (SELECT *, {SQL_SCORE} AS health_score FROM wins)""")
def health_scores(spark, sf_dir):
    h = H.health_scores(sliding(spark, sf_dir))
    return h.select("device_id", "protocol", "window_duration",
                    F.unix_micros("window_start").alias("window_start_us"),
                    r6("health_score").alias("health_score"), "health_status")
