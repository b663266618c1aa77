"""Sinks (SNK-1..10).

Kafka sinks need the connector on the classpath; every Kafka writer takes a
``SinkConfig`` whose ``kind="files"`` writes the same row shape (key, value,
topic, headers) as JSON files instead, which is what tests and offline runs
use.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from driftwood.operators import messages as M


@dataclass
class SinkConfig:
    kind: str = "kafka"                        # "kafka" | "files"
    topic: str = "iot-analytics-results"
    bootstrap_servers: str = "localhost:9092"
    path: str | None = None                    # files stand-in location
    extra: dict[str, str] = field(default_factory=dict)


def write_result_csv(df: DataFrame, path: str) -> None:
    """SNK-1: result table as CSV with a header (no index column)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def console_stream(df: DataFrame, trigger: str = "5 seconds",
                   output_mode: str = "append") -> DataStreamWriter:
    """SNK-2 (development only): console sink, 10 rows, no truncation."""
    return (df.writeStream.format("console").outputMode(output_mode)
              .option("truncate", "false").option("numRows", "10")
              .trigger(processingTime=trigger))


def as_json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """PRJ-5: whole row as a JSON ``value`` (plus an optional ``key``)."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def _kafka_opts(cfg: SinkConfig) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": cfg.bootstrap_servers, "topic": cfg.topic}
    opts.update(cfg.extra)
    return opts


# The topics of the analytics results.
RESULTS_TOPIC, ANOMALIES_TOPIC = "iot-analytics-results", "iot-anomalies"


def publish_analytics(windows: DataFrame, anomalies: DataFrame, health: DataFrame, cfg: SinkConfig,
                      health_path: str, batch_id: int) -> dict[str, int]:
    """SNK-3/4/5: one micro-batch to its three targets under one batch id:
    window results and anomalies as JSON values to their topics, health
    scores as JSON files. Returns the rows sent per target; a replayed batch
    replaces its files."""
    rows = as_json_value(windows, "device_id").withColumn("topic", F.lit(RESULTS_TOPIC)).unionByName(
        as_json_value(anomalies, "device_id").withColumn("topic", F.lit(ANOMALIES_TOPIC)))
    sent = publish_rows(rows, cfg, batch_id, (RESULTS_TOPIC, ANOMALIES_TOPIC))
    return {**sent, "health": write_health_json(health, health_path, batch_id)}


def write_health_json(health: DataFrame, path: str, batch_id: int) -> int:
    """SNK-5: the health scores of a batch as JSON files; the rows written."""
    from pyspark.sql import Observation
    seen = Observation()
    (health.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
     .json(os.path.join(path, f"batch_id={batch_id}")))
    return seen.get["n"]


def write_messages(messages: DataFrame, cfg: SinkConfig, envelope_ts: Column | None = None,
                   key: str = "device_id", headers: dict[str, Column] | None = None) -> dict:
    """SNK-6/7/8: keyed produce with the ``{timestamp, data}`` envelope and
    headers; returns the number of rows sent (observed while writing, no
    second pass)."""
    from pyspark.sql import Observation
    ts = envelope_ts if envelope_ts is not None else M.iso_text(F.current_timestamp())
    rows = M.to_envelope(messages, ts, key=key, headers=headers)
    obs = Observation("sent")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("sent"))
    if cfg.kind == "kafka":
        rows.write.format("kafka").options(**_kafka_opts(cfg)).save()
    else:
        (rows.withColumn("topic", F.lit(cfg.topic))
             .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                     *(["headers"] if headers else []))
             .write.mode("append").json(cfg.path))
    return obs.get


def publish_rows(rows: DataFrame, cfg: SinkConfig, batch_id: int | None = None,
                 topics: tuple[str, ...] = ()) -> dict[str, int]:
    """SNK-7: rows ``key, value, topic``, each to the topic it names. Returns
    how many rows went to each of ``topics`` and, as ``""``, to all together,
    observed during the write. The file stand-in takes one folder a batch, so
    that a replayed batch replaces its own rows; Kafka consumers must expect
    repeats after a replay."""
    from pyspark.sql import Observation
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"),
                        *(F.count_if(F.col("topic") == t).alias(f"n{i}") for i, t in enumerate(topics)))
    if cfg.kind == "kafka":
        opts = {k: v for k, v in _kafka_opts(cfg).items() if k != "topic"}
        rows.write.format("kafka").options(**opts).save()
    else:
        target = cfg.path if batch_id is None else os.path.join(cfg.path, f"batch_id={batch_id}")
        rows.write.mode("append" if batch_id is None else "overwrite").json(target)
    found = seen.get
    return {"": found["n"], **{t: found[f"n{i}"] for i, t in enumerate(topics)}}


def write_quarantine(bad: DataFrame, path: str, batch_id: int | None = None) -> None:
    """SNK-9: invalid records partitioned by reason; inside ``foreachBatch``
    pass the batch id so a replayed batch overwrites its own output."""
    target = path if batch_id is None else os.path.join(path, f"batch_id={batch_id}")
    bad.write.mode("overwrite" if batch_id is not None else "append") \
       .partitionBy("reason").parquet(target)


def append_metrics(points: DataFrame, path: str) -> None:
    """SNK-10: metric points appended, partitioned by date."""
    from driftwood.operators.metrics import append_metrics as _append
    _append(points, path)
