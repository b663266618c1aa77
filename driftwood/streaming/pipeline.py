"""The streaming analytics pipeline.

source (Kafka or file stand-in) -> parse envelope -> flatten -> metrics ->
watermark -> sliding-window aggregates -> ONE ``foreachBatch`` that writes
window results, anomalies and health scores, publishes them to their targets
and runs user hooks (D13: the original started four queries that each re-read
the source and recomputed the windows). Rows that cannot enter the windows
travel through the same query to a quarantine partitioned by reason (SNK-9),
so every row of a batch of offsets is in one output or the other.

Fault tolerance: offsets and window state live in the checkpoint (under the
cluster's shared ``spark.checkpoint.dir``); each batch writes its outputs
to ``<sink>/batch_id=<n>`` with overwrite, so a batch replayed after a
failure replaces its own output instead of duplicating it, and a manifest
names the batches whose outputs are complete (STR-9). In update mode (STR-4)
the windows are a table of versions, and anomalies and health are read from
its newest ones.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwood.operators import anomalies as A
from driftwood.operators import health as H
from driftwood.operators import messages as M
from driftwood.operators import windows as W
from driftwood.session import scratch_path
from driftwood.sinks import SinkConfig, publish_analytics, publish_rows, write_quarantine
from driftwood.sources.stream import SourceConfig, message_stream
from driftwood.streaming.tables import BatchManifest, VersionedTable

LOG = logging.getLogger(__name__)
WATERMARK = "10 minutes"          # fixed value: allowed event-time lateness


@dataclass
class PipelineConfig:
    source: SourceConfig = field(default_factory=SourceConfig)
    windows: tuple = W.DEFAULT_WINDOWS
    watermark: str = WATERMARK
    output_mode: str = "append"                 # STR-4: append | update
    trigger: str | None = "5 seconds"           # STR-5; None = availableNow
    output_root: str | None = None              # sinks: <root>/<name>/batch_id=<n>
    checkpoint: str | None = None
    query_name: str = "iot_analytics"
    hooks: dict[str, Callable[[DataFrame, int], None]] = field(default_factory=dict)
    publish: SinkConfig | None = None           # SNK-3/4/5: topics and health files


WINDOW_KEYS = ("device_id", "protocol", "window_duration", "window_start", "window_end")


def parsed_messages(raw: DataFrame) -> DataFrame:
    """Kafka rows -> flat readings with numeric metrics (PRJ-1/2/3)."""
    return W.extract_metrics(M.flatten_messages(M.parse_envelope(raw)))


def windowed_stream(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """STR-1/2: watermark on event time, then the sliding aggregates."""
    readings = parsed_messages(raw).withWatermark("event_time", cfg.watermark)
    method = "stream" if cfg.output_mode == "append" else "direct"  # only append mode chains states
    return W.window_metrics(readings, windows=cfg.windows, method=method,
                            proc="processing_time")


def quarantine(raw: DataFrame) -> DataFrame:
    """SNK-9: rows that cannot enter the windows, with a reason."""
    p = M.parse_envelope(raw)
    reason = (F.when(F.col("message").isNull(), F.lit("unparsable"))
               .when(F.col("message.device_id").isNull(), F.lit("missing_device_id"))
               .when(F.coalesce(F.try_to_timestamp(F.col("message.timestamp")),
                                F.try_to_timestamp(F.col("envelope_ts"))).isNull(),
                     F.lit("missing_event_time")))
    return p.withColumn("reason", reason).where(F.col("reason").isNotNull())


def _write_batch(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    (df.write.mode("overwrite").format("parquet")
       .save(os.path.join(root, name, f"batch_id={batch_id}")))


def window_versions(root: str) -> VersionedTable:
    """The windows of a pipeline in update mode."""
    return VersionedTable(os.path.join(root, "windows"), WINDOW_KEYS)


def fan_out(cfg: PipelineConfig, root: str) -> Callable[[DataFrame, int], None]:
    """STR-7: one micro-batch, several outputs; user hooks run isolated
    (a failing hook does not stop the others: UDF-2/3). A batch holds window
    rows, or rows ``window, rejected`` of both kinds."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            both = "rejected" in batch.columns
            windows = batch.where("window is not null").select("window.*") if both else batch
            if both:
                write_quarantine(batch.where("rejected is not null").select("rejected.*"),
                                 os.path.join(root, "quarantine"), batch_id)
            anomalies = A.detect_anomalies(windows, detected_at=F.current_timestamp())
            health = H.health_scores(windows)
            if cfg.output_mode == "update":
                window_versions(root).write(windows, batch_id)
            else:
                _write_batch(windows, root, "windows", batch_id)
                _write_batch(anomalies, root, "anomalies", batch_id)
                _write_batch(health, root, "health", batch_id)
            sent = {}
            if cfg.publish is not None:
                sent = publish_analytics(windows, anomalies, health, cfg.publish,
                                         os.path.join(root, "health_json"), batch_id)
            for name, hook in cfg.hooks.items():
                try:
                    hook(windows, batch_id)
                except Exception:  # noqa: BLE001 - hook isolation is the contract
                    LOG.exception("hook %s failed on batch %s", name, batch_id)
            BatchManifest(root).commit(batch.sparkSession, batch_id, {"windows": windows.count(), **sent})
        finally:
            batch.unpersist()
    return handle


def start_pipeline(spark: SparkSession, cfg: PipelineConfig) -> list[StreamingQuery]:
    """STR-6/8: start the query; its checkpoint is under the shared folder.
    Windows and rejected rows are two branches over one source, so they see
    the same offsets, wherever the source starts."""
    root = cfg.output_root or scratch_path(spark, "pipeline-out")
    ckpt = cfg.checkpoint or scratch_path(spark, "pipeline-ckpt")
    raw = message_stream(spark, cfg.source)
    windows, bad = windowed_stream(raw, cfg), quarantine(raw)
    rows = windows.select(F.struct(*windows.columns).alias("window")).unionByName(
        bad.select(F.struct(*bad.columns).alias("rejected")), allowMissingColumns=True)
    w = (rows.writeStream.queryName(cfg.query_name).outputMode(cfg.output_mode)
         .option("checkpointLocation", os.path.join(ckpt, "windows")).foreachBatch(fan_out(cfg, root)))
    w = w.trigger(availableNow=True) if cfg.trigger is None else w.trigger(processingTime=cfg.trigger)
    return [w.start()]


def processing_flow(root: str, processed_at=None, threshold: float = 80.0,
                    publish: SinkConfig | None = None,
                    before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """ALR-2: the ``foreachBatch`` step that validates a micro-batch of Kafka
    rows and writes its processed records, temperature alerts and rejected
    rows (with a reason) under ``<root>/<name>/batch_id=<n>``; a replayed
    batch replaces its own rows. With ``publish``, processed records also go
    to the topic in ``iot-processed-data`` and alerts to ``iot-alerts``
    (SNK-7/8), keyed by device. A batch counts once it is in the manifest
    (``BatchManifest(root)``, STR-9); ``before_commit`` runs when its outputs
    are written, and if it fails the batch is not committed."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = M.parse_envelope(batch).persist()  # one parse for the three outputs
        try:
            done = M.processed_records(parsed, processed_at)
            alerts = M.temperature_alerts(done, threshold, processed_at)
            _write_batch(done, root, "processed", batch_id)
            _write_batch(alerts, root, "alerts", batch_id)
            _write_batch(rejected(parsed), root, "quarantine", batch_id)
            if publish is not None:
                out = [df.select(F.col("device_id").alias("key"), F.lit(topic).alias("topic"),
                                 F.to_json(F.struct(*df.columns)).alias("value"))
                       for df, topic in ((done, "iot-processed-data"), (alerts, "iot-alerts"))]
                publish_rows(out[0].unionByName(out[1]), publish, batch_id)
            if before_commit is not None:
                before_commit(batch_id)
            BatchManifest(root).commit(batch.sparkSession, batch_id, {
                "processed": done.count(), "alerts": alerts.count(), "quarantine": rejected(parsed).count()})
        finally:
            parsed.unpersist()
    return handle


def rejected(parsed: DataFrame) -> DataFrame:
    """Parsed rows without the required fields (FLT-2), and why."""
    reason = (F.when(F.col("message").isNull(), F.lit("unparsable"))
               .when(F.col("message.device_id").isNull(), F.lit("missing_device_id"))
               .when(F.col("message.timestamp").isNull(), F.lit("missing_timestamp")))
    return parsed.withColumn("reason", reason).where(F.col("reason").isNotNull())


def stop_all(spark: SparkSession) -> None:
    """STR-8: stop every active query of the session."""
    for q in spark.streams.active:
        q.stop()


#: Event time of the row that ends a bounded stream; later than any data.
END_OF_STREAM = "9999-01-01 00:00:00"


@contextmanager
def cluster_partitions(spark: SparkSession) -> Iterator[None]:
    """Start a query in here to size its state partitions, which are fixed when
    its checkpoint is created, to the cluster instead of inheriting a
    batch-oriented shuffle setting."""
    key = "spark.sql.shuffle.partitions"
    saved = spark.conf.get(key)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, saved)


def drain(df: DataFrame, ckpt: str, out: str | None = None, output_mode: str = "append",
          each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Run a streaming frame once over what its sources hold
    (``availableNow``), into parquet at ``out`` or through ``each``."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    with cluster_partitions(spark):
        q = (w.format("parquet").option("path", out) if each is None else w.foreachBatch(each)).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_available_now(df: DataFrame, spark: SparkSession, name: str,
                      output_mode: str = "append") -> DataFrame:
    """Drain a streaming frame once into parquet under the shared checkpoint
    folder and return what was written, as a batch frame. What the watermark
    has not passed stays in the state (see :func:`run_bounded`)."""
    out = scratch_path(spark, f"{name}-out")
    drain(df, scratch_path(spark, f"{name}-ckpt"), out, output_mode)
    return spark.read.schema(df.schema).parquet(out)


def run_bounded(source: DataFrame, plan: Callable[[DataFrame], DataFrame], name: str,
                ends: list[dict[str, object]], each: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
    """All results of ``plan`` over a stream that has an end, as a batch frame
    (or, with ``each``, through that ``foreachBatch`` function).

    Append mode keeps open windows until the watermark has passed them, which
    on a stream that ends never happens for the last ones. So the drained
    query is started once more with ``ends``, rows of the source's columns
    (others null) whose event time is ``END_OF_STREAM``: the watermark passes
    everything before, and the state is written out. Give them keys of their
    own; what they open themselves never closes. The checkpoint is used up.
    """
    spark = source.sparkSession
    tail = scratch_path(spark, f"{name}-tail")
    spark.createDataFrame([], source.schema).write.parquet(tail)
    df = plan(source.unionByName(spark.readStream.schema(source.schema).parquet(tail)))
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    drain(df, ckpt, out, each=each)
    rows = [spark.range(1).select(*(F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in source.schema))
            for row in ends]
    reduce(DataFrame.unionAll, rows).coalesce(1).write.mode("append").parquet(tail)
    drain(df, ckpt, out, each=each)
    return spark.read.schema(df.schema).parquet(out) if each is None else None
