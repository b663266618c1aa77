"""Views the registered queries read: projections of the driver tables.

Everything here is a narrow projection of one scan (no shuffle), so every
query's work grows with the tables. The same definitions exist in SQL for the
DuckDB oracle (``SQL_*`` strings, used as CTEs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived views.
T0_US = 1704067200000000          # 2024-01-01T00:00:00Z in microseconds
TIME_COMPRESSION = 100            # events' 30 days squeezed into ~7 hours
PROTOCOLS = ["MQTT", "SNMP", "CoAP", "TCP", "WebSocket"]


def utc(spark: SparkSession) -> None:
    """The data model is UTC (driver tables hold wall-clock TIMESTAMP_NTZ
    values read as UTC instants); pin the session zone before planning."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _protocol_of(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in PROTOCOLS]), (n + 1).cast("int"))


def iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device readings derived from ``events`` (one row per event)."""
    return iot_from(table(spark, sf_dir, "events"))


def iot_from(ev: DataFrame) -> DataFrame:
    """The ``iot`` projection of an events frame (batch or stream)."""
    dev = F.col("user_id") % 5
    event_time = F.expr(
        f"timestamp_micros({T0_US} + (unix_micros(cast(ts as timestamp)) - {T0_US}) "
        f"div {TIME_COMPRESSION})")
    return ev.select(
        "event_id",
        F.concat(F.lit("sensor_"), dev.cast("string")).alias("device_id"),
        _protocol_of(dev).alias("protocol"),
        event_time.alias("event_time"),
        F.round(F.col("value") - 20, 2).alias("temperature"),
        ((F.col("event_id") * 7) % 1010 / F.lit(10.0)).alias("humidity"),
        (F.lit(780) + F.col("event_id") % 450).cast("double").alias("pressure"),
        (F.col("value") / 2).alias("vibration"),
        "user_id", "event_type", "props",
    )


SQL_IOT = f"""
iot AS (
  SELECT event_id,
         'sensor_' || CAST(user_id % 5 AS VARCHAR) AS device_id,
         {PROTOCOLS!r}[CAST(user_id % 5 AS INTEGER) + 1] AS protocol,
         make_timestamp({T0_US} + (epoch_us(ts) - {T0_US}) // {TIME_COMPRESSION}) AS event_time,
         round(value - 20, 2) AS temperature,
         CAST((event_id * 7) % 1010 AS DOUBLE) / 10 AS humidity,
         CAST(780 + event_id % 450 AS DOUBLE) AS pressure,
         value / 2 AS vibration,
         user_id, event_type, props
  FROM events)"""


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call-detail records derived from ``events``: msisdn = user, domain =
    event type, a record lasts ``floor(value)`` minutes."""
    return cdr_from(table(spark, sf_dir, "events"))


def cdr_from(ev: DataFrame) -> DataFrame:
    """The ``cdr`` projection of an events frame (batch or stream)."""
    start_us = F.unix_micros(F.col("ts").cast("timestamp"))
    return ev.select(
        F.col("user_id").alias("msisdn"),
        F.col("event_type").alias("domain"),
        "event_id",
        F.col("ts").cast("timestamp").alias("start_dt"),
        F.timestamp_micros(start_us + F.floor("value").cast("long") * 60_000_000).alias("end_dt"),
        (F.col("event_id") % 5000).alias("ulvolume"),
        ((F.col("event_id") * 3) % 9000).alias("dlvolume"),
    )


SQL_CDR = """
cdr AS (
  SELECT user_id AS msisdn, event_type AS domain, event_id,
         CAST(ts AS TIMESTAMP) AS start_dt,
         make_timestamp(epoch_us(ts) + CAST(floor(value) AS BIGINT) * 60000000) AS end_dt,
         event_id % 5000 AS ulvolume,
         (event_id * 3) % 9000 AS dlvolume
  FROM events)"""
