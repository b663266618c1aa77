"""Declared schemas of the engine's inputs and outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Call-detail records as they arrive in CSV (datetimes still text).
CDR_SCHEMA = T.StructType([
    T.StructField("starttime", T.StringType()),
    T.StructField("endtime", T.StringType()),
    T.StructField("msisdn", T.LongType()),
    T.StructField("ulvolume", T.LongType()),
    T.StructField("dlvolume", T.LongType()),
    T.StructField("domain", T.StringType()),
])

CDR_SCHEMA_WITH_CORRUPT = T.StructType(
    CDR_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])

# Standardised device message (data/metadata are dynamic: string maps).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# Producer envelope around a message: {"timestamp": ..., "data": message}.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("data", MESSAGE_SCHEMA),
])

# Row shape of the Kafka source; the file stand-in uses the same shape.
KAFKA_ROW_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

# Metric points (one row per recorded value); seq orders same-instant points.
METRIC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])

# Append-only alert log; the latest row per id is the alert's state.
ALERT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("severity", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("resolved", T.BooleanType()),
    T.StructField("resolved_at", T.TimestampType()),
])

# Landing table of captured protocol payloads.
RAW_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("protocol", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("qos", T.IntegerType()),
    T.StructField("retain", T.BooleanType()),
    T.StructField("host", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("uri", T.StringType()),
    T.StructField("resource", T.StringType()),
    T.StructField("response_code", T.StringType()),
    T.StructField("community", T.StringType()),
    T.StructField("oid", T.StringType()),
    T.StructField("oid_value", T.StringType()),
    T.StructField("poll_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])

# Structured Streaming progress events, as written by a listener.
PROGRESS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("runId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
    T.StructField("processedRowsPerSecond", T.DoubleType()),
    T.StructField("durationMs", T.MapType(T.StringType(), T.LongType())),
    T.StructField("stateOperators", T.ArrayType(T.StructType([
        T.StructField("numRowsTotal", T.LongType()),
        T.StructField("memoryUsedBytes", T.LongType()),
        T.StructField("numRowsDroppedByWatermark", T.LongType()),
    ]))),
])
