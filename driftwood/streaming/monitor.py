"""Streaming monitoring: progress events as data (MET-4) and the periodic
rule check (STR-11, UDF-3).

``ProgressRecorder`` is a ``StreamingQueryListener`` that appends each
progress event's JSON to a folder (one small file per event) in shared
storage; :func:`driftwood.operators.metrics.progress_metrics` reads them
back as a table. ``start_rule_monitor`` runs the threshold rules over a
stream of metric points every 30 seconds inside ``foreachBatch`` and hands
new alerts to handlers whose failures are isolated.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from driftwood.operators import alerts as AL
from driftwood.session import folder_exists

LOG = logging.getLogger(__name__)
RULE_CHECK_EVERY = "30 seconds"      # fixed value: rule check period


class ProgressRecorder(StreamingQueryListener):
    """Writes each progress event as one JSON line file under ``folder``,
    through the Hadoop file system of the session, so any shared-storage
    URI works (the default is under ``spark.checkpoint.dir``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder

    def _write(self, text: str) -> None:
        path = self._jvm.org.apache.hadoop.fs.Path(
            f"{self.folder}/progress-{uuid.uuid4().hex}.json")
        out = path.getFileSystem(self._conf).create(path, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self._write(event.progress.json.replace("\n", " ") + "\n")

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress lines as a ``json`` text column."""
    return spark.read.text(folder).withColumnRenamed("value", "json")


def _days(spark: SparkSession, schema, path: str, day: dt.date) -> DataFrame:
    """The metric table from the day before ``day`` on."""
    names = [f"date={day + dt.timedelta(days=k)}" for k in (-1, 0, 1)]
    found = [os.path.join(path, n) for n in names if folder_exists(spark, os.path.join(path, n))]
    parts = [T.StructField("date", T.DateType()), T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", path).parquet(*found)


def start_rule_monitor(points: DataFrame, rules: DataFrame, metrics_path: str, alerts_path: str,
                       checkpoint: str, handlers: dict[str, Callable[[DataFrame, int], None]]
                       | None = None, every: str | None = RULE_CHECK_EVERY) -> StreamingQuery:
    """STR-11: every ``every`` the rules are evaluated on all points of the
    five minutes up to the newest point so far. A batch first joins the
    metric table at ``metrics_path`` (date partitions, one folder a batch, so
    a replayed batch replaces its own rows); the rules then read the last
    minutes back from it, whichever batch they came in. Alerts are written to
    ``alerts_path`` (per batch, replay-safe) and passed to ``handlers``."""
    handlers = handlers or {}

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Date first: a check lists the folders of one or two days, not of all batches.
        (batch.withColumns({"date": F.to_date("ts"), "batch_id": F.lit(batch_id)})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "batch_id").parquet(metrics_path))
        latest = batch.agg(F.max("ts").cast("date"), F.max(F.unix_micros("ts"))).first()
        if latest[1] is None:
            return
        table = _days(spark, batch.schema, metrics_path, latest[0]).where(F.col("batch_id") <= batch_id)
        newest = table.agg(F.max(F.unix_micros("ts")), F.max("ts").cast("date")).first()
        as_of = F.timestamp_micros(F.lit(newest[0]))
        if newest[1] != latest[0]:  # the batch is behind others: take the days of the newest point
            table = _days(spark, batch.schema, metrics_path, newest[1]).where(F.col("batch_id") <= batch_id)
        # The bound on the partition column keeps the read to one or two dates.
        since = F.to_date(as_of - F.expr(f"INTERVAL {AL.RULE_WINDOW_MINUTES} MINUTE"))
        alerts = AL.evaluate_rules(table.where(F.col("date") >= since), rules, as_of)
        alerts.write.mode("overwrite").parquet(os.path.join(alerts_path, f"batch_id={batch_id}"))
        for _name, handler in handlers.items():
            try:
                handler(alerts, batch_id)
            except Exception:  # noqa: BLE001 - a failing handler stays isolated
                LOG.exception("alert handler %s failed on batch %s", _name, batch_id)

    w = points.writeStream.option("checkpointLocation", checkpoint).foreachBatch(check)
    w = w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)
    return w.start()
