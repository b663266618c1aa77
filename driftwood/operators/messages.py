"""Message path: envelope, parse, flatten, processed records, stream alerts,
topic dispatch, valid/invalid routing and flow-document shifts.

Operators: SNK-6 payload, PRJ-1/2/5/6/12/13, FLT-1/2/3/8, ALR-1, UDF-1.
All are row-local projections (no shuffle) and run unchanged on streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.functions.rows import select_where
from driftwood.schemas import ENVELOPE_SCHEMA

STRING_MAP = T.MapType(T.StringType(), T.StringType())
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def iso_text(ts: Column) -> Column:
    """Instant -> ISO-8601 text with microseconds and ``Z``."""
    return F.date_format(ts, ISO_MICROS)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text (with ``Z`` or an offset) -> instant, null if invalid."""
    return F.try_to_timestamp(text)


def to_envelope(df: DataFrame, envelope_ts: Column, key: str = "device_id",
                headers: dict[str, Column] | None = None,
                topic: Column | None = None) -> DataFrame:
    """SNK-6/PRJ-5: message rows -> Kafka rows ``{timestamp, data: message}``
    as JSON value, device id as key, optional headers."""
    msg = F.struct(*[F.col(c) for c in ("timestamp", "device_id", "protocol", "data",
                                         "metadata") if c in df.columns])
    value = F.to_json(F.struct(envelope_ts.alias("timestamp"), msg.alias("data")))
    cols = [F.col(key).cast("binary").alias("key"), value.cast("binary").alias("value")]
    if topic is not None:
        cols.append(topic.alias("topic"))
    if headers:
        cols.append(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
                              for k, v in headers.items()]).alias("headers"))
    return df.select(*cols)


def parse_envelope(kafka_rows: DataFrame, schema: T.StructType = ENVELOPE_SCHEMA) -> DataFrame:
    """PRJ-1: decode the JSON value by schema and keep the Kafka coordinates.

    A value that is not JSON yields null ``envelope_ts``/message fields (and
    is dropped by :func:`flatten_messages`), never a failed batch.
    """
    keep = [c for c in ("topic", "partition", "offset") if c in kafka_rows.columns]
    if "timestamp" in kafka_rows.columns:
        keep_ts = [F.col("timestamp").alias("kafka_timestamp")]
    else:
        keep_ts = []
    parsed = kafka_rows.select(
        *keep, *keep_ts,
        F.col("key").cast("string").alias("key") if "key" in kafka_rows.columns
        else F.lit(None).cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("_m"))
    return parsed.select(*keep, *[c for c in ("kafka_timestamp",) if keep_ts], "key",
                         F.col("_m.timestamp").alias("envelope_ts"), F.col("_m.data").alias("message"))


def consumer_records(kafka_rows: DataFrame, schema: T.StructType = ENVELOPE_SCHEMA) -> DataFrame:
    """SRC-4: the consumer's record view: UTF-8 key, decoded JSON value,
    headers as a string map, Kafka coordinates and the record time as ISO
    text (a source that delivers epoch milliseconds converts them with
    ``timestamp_millis``, SCL-18)."""
    ts = F.col("timestamp")
    if isinstance(kafka_rows.schema["timestamp"].dataType, T.LongType):
        ts = F.timestamp_millis(ts)
    headers = F.map_from_entries(F.transform(
        F.coalesce(F.col("headers"), F.array().cast(
            "array<struct<key:string,value:binary>>")),
        lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return kafka_rows.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("value"),
        headers.alias("headers"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp"))


def flatten_messages(parsed: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """PRJ-2 + FLT-1: device_id, protocol, sensor map, metadata map, event
    time (message timestamp, else the envelope's: D1), processing time."""
    proc = F.current_timestamp() if processing_time is None else processing_time
    extra = [c for c in ("topic", "partition", "offset", "kafka_timestamp") if c in parsed.columns]
    return select_where(parsed, [
        *extra,
        F.col("message.device_id").alias("device_id"),
        F.col("message.protocol").alias("protocol"),
        F.col("message.data").alias("sensor_data"),
        F.col("message.metadata").alias("metadata"),
        F.coalesce(F.try_to_timestamp(F.col("message.timestamp")),
                   F.try_to_timestamp(F.col("envelope_ts"))).alias("event_time"),
        proc.alias("processing_time"),
    ], lambda r: r["device_id"].isNotNull())


def has_required(message: Column | str = "message") -> Column:
    """FLT-2: device_id and timestamp present (null counts as missing: D6)."""
    m = F.col(message) if isinstance(message, str) else message
    return m["device_id"].isNotNull() & m["timestamp"].isNotNull()


def processed_records(parsed: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """PRJ-6: the forwarded record shape; missing maps become empty maps."""
    at = F.current_timestamp() if processed_at is None else processed_at
    empty = F.create_map().cast(STRING_MAP)
    return select_where(parsed, [
        F.col("message.device_id").alias("device_id"),
        F.col("message.timestamp").alias("timestamp"),
        at.alias("processed_at"),
        F.coalesce(F.col("message.data"), empty).alias("metrics"),
        F.coalesce(F.col("message.metadata"), empty).alias("metadata"),
    ], has_required)


def temperature_alerts(processed: DataFrame, threshold: float = 80.0,
                       at: Column | None = None) -> DataFrame:
    """ALR-1: HIGH_TEMPERATURE when the metric exceeds the threshold;
    non-numeric text never alerts (D7)."""
    temp = F.expr("try_cast(try_element_at(metrics, 'temperature') AS DOUBLE)")
    ts = F.current_timestamp() if at is None else at
    return processed.where(temp > F.lit(threshold)).select(
        "device_id",
        F.lit("HIGH_TEMPERATURE").alias("alert_type"),
        temp.alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        ts.alias("timestamp"),
        F.lit("WARNING").alias("severity"))


def dispatch_counts(df: DataFrame, handled_topics: list[str], topic: str = "topic") -> DataFrame:
    """FLT-8: messages per topic and whether a handler exists for it (the
    unhandled count replaces the per-message warning)."""
    return (df.groupBy(topic)
              .agg(F.count(F.lit(1)).alias("messages"))
              .withColumn("handled", F.col(topic).isin(list(handled_topics))))


def route(batch: DataFrame, epoch_id: int,
          handlers: dict[str, Callable[[DataFrame, int], None]], topic: str = "topic") -> list[str]:
    """UDF-1: run each topic's handler on its slice of a micro-batch (use
    inside ``foreachBatch``). A failing handler does not stop the others;
    the names of failed topics are returned."""
    failed = []
    for name, handler in handlers.items():
        try:
            handler(batch.where(F.col(topic) == name), epoch_id)
        except Exception:  # noqa: BLE001 - isolation is the feature
            failed.append(name)
    return failed


def route_valid(shifted: DataFrame) -> DataFrame:
    """FLT-3: ``valid`` when device_id and event_time are both non-null,
    ``invalid`` otherwise (the two routes are exhaustive)."""
    ok = F.col("device_id").isNotNull() & F.col("event_time").isNotNull()
    return shifted.withColumn("route", F.when(ok, F.lit("valid")).otherwise(F.lit("invalid")))


# The field renames of the two flow-document shifts.
SHIFT_RENAMES = {"timestamp": "event_time", "deviceId": "device_id",
                 "location": "geo_location"}
SHIFT_NESTED_METRICS = ("temperature", "humidity", "pressure")


def shift_document(doc_json: Column) -> Column:
    """PRJ-12 (shift, variant 1) on a JSON document string, as a struct:
    ``timestamp->event_time``, ``deviceId->device_id``,
    ``sensorData.*->metrics.*``, ``location->geo_location``; all other
    top-level fields pass through unchanged (in ``extra``)."""
    top = F.from_json(doc_json, STRING_MAP)
    consumed = F.array(*[F.lit(k) for k in (*SHIFT_RENAMES, "sensorData")])
    return F.struct(
        *[F.try_element_at(top, F.lit(src)).alias(dst) for src, dst in SHIFT_RENAMES.items()],
        F.from_json(F.try_element_at(top, F.lit("sensorData")), STRING_MAP).alias("metrics"),
        F.map_filter(top, lambda k, v: ~F.array_contains(consumed, k)).alias("extra"))


NESTED_DOC_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("deviceId", T.StringType()),
    *[T.StructField(m, T.DoubleType()) for m in SHIFT_NESTED_METRICS],
    T.StructField("location", T.StructType([T.StructField("lat", T.DoubleType()),
                                            T.StructField("lon", T.DoubleType())])),
    T.StructField("metadata", STRING_MAP),
])


def shift_nested(doc_json: Column) -> Column:
    """PRJ-13 (shift, variant 2): flat readings -> ``metrics``,
    ``location.lat/lon`` -> ``geo_location.latitude/longitude``,
    ``metadata.*`` -> ``device_metadata.*``; unlisted fields are dropped."""
    d = F.from_json(doc_json, NESTED_DOC_SCHEMA)
    return F.struct(
        d["timestamp"].alias("event_time"),
        d["deviceId"].alias("device_id"),
        F.struct(*[d[m].alias(m) for m in SHIFT_NESTED_METRICS]).alias("metrics"),
        F.struct(d["location"]["lat"].alias("latitude"),
                 d["location"]["lon"].alias("longitude")).alias("geo_location"),
        d["metadata"].alias("device_metadata"))


def map_text(m: Column) -> Column:
    """A map rendered as ``k=v`` pairs sorted by key, comma separated."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit("="),
                                                       F.coalesce(e["value"], F.lit("null")))),
                        ",")
