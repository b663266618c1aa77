"""Calls on a stream with the previous-record rule (STR-10), from the batch
operator's own parts.

``session_window`` merges overlapping ``[start, end + gap)`` intervals, i.e.
the running-max rule. The batch rule compares each record with the end of
the record just before it in start order. On a stream that order is known
for the time that the watermark has passed, so each micro-batch

* adds its records to the pending ones; a record that starts before the time
  already closed is late and goes to a side table;
* closes all buckets (10 minutes of start) that end before the watermark and
  folds their records into partial calls per (key, bucket), as the batch
  operator does, so a hot key is spread over its buckets;
* merges them with the carry table, which holds one row per key: its last
  call, open or closed, as a partial call of an earlier bucket;
* writes the calls that no later record can join, the new carry table and
  the records still pending.

State is a pair of tables per micro-batch under ``<root>/state``, written
with overwrite and read by the next one, so a replayed micro-batch starts
from the same state and replaces its own output. All work is DataFrame code:
no Python runs per key or record. The carry table is rewritten with every
micro-batch and grows with the keys seen, not with their records.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwood.operators import calls as C
from driftwood.session import ensure_checkpoint_dir, remove_folder

#: Bucket of the carry rows, before all others.
CARRIED = -2 ** 62
CARRY = ["call_no", "ul_bytes", "dl_bytes", "call_start", "call_end", "fdr_count", "_last_e", "done"]


@dataclass
class CallStream:
    """Streaming calls; ``records`` have the keys, start, end and adjusted end
    times, volumes and the ``order`` columns of the batch operator."""
    root: str
    keys: tuple[str, ...] = ("msisdn", "domain")
    order: tuple[str, ...] = ("end_dt", "ulvolume", "dlvolume")
    gap: str = C.CALL_GAP
    bucket: str = "10 minutes"
    watermark: str = "10 minutes"

    def _path(self, name: str, batch_id: int) -> str:
        return os.path.join(self.root, name, f"batch_id={batch_id}")

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._path(name, batch_id))

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch (for ``foreachBatch``)."""
        self._step(batch, batch_id, last=False)

    def finish(self, spark: SparkSession) -> None:
        """The stream has ended: close every bucket and every call. The calls
        come out as one more batch; the state is used up."""
        marks = spark.read.option("basePath", os.path.join(self.root, "state/mark")).parquet(
            os.path.join(self.root, "state/mark"))
        newest = marks.agg(F.max("batch_id")).first()[0]
        pending = spark.read.parquet(self._path("state/pending", newest))
        self._step(pending.limit(0), newest + 1, last=True)

    def _step(self, batch: DataFrame, batch_id: int, last: bool) -> None:
        spark = batch.sparkSession
        ensure_checkpoint_dir(spark)
        names = list(dict.fromkeys([*self.keys, "start_dt", "end_dt", "adjusted_end_dt", "ulvolume", "dlvolume",
                                    *self.order]))
        placeable = batch.select(*names).where(" and ".join(
            f"{c} is not null" for c in (*self.keys, "start_dt", "end_dt")))
        first = batch_id == 0
        closed = None if first else spark.read.parquet(self._path("state/mark", batch_id - 1)).first()["closed"]
        start = F.unix_micros("start_dt")
        rows = placeable
        if closed is not None:
            self._write(placeable.where(start < closed), "late", batch_id)
            rows = placeable.where(start >= closed)
        if not first:
            rows = rows.unionByName(spark.read.parquet(self._path("state/pending", batch_id - 1)))
        # Time up to which no record can come any more, in whole buckets.
        bucket_us = C.interval_micros(self.bucket)
        newest = rows.agg(F.max(start)).first()[0]
        upto = closed
        if last:
            upto = 2 ** 62
        elif newest is not None:
            passed = (newest - C.interval_micros(self.watermark)) // bucket_us * bucket_us
            upto = passed if closed is None else max(closed, passed)
        ready = rows.where(start < upto) if upto is not None else rows.limit(0)
        partials = C.partial_calls(ready, self.keys, "start_dt", "end_dt", "adjusted_end_dt", self.gap, "previous",
                                   self.order, self.bucket)
        if not first:
            carry = spark.read.parquet(self._path("state/carry", batch_id - 1))
            partials = partials.withColumn("done", F.lit(False)).unionByName(carry.select(
                *self.keys, F.lit(CARRIED).alias("_b"), F.lit(0).cast("long").alias("_local_no"),
                "ul_bytes", "dl_bytes", "call_start", "call_end", "fdr_count",
                F.unix_micros("call_start").alias("_first_s"), "_last_e", F.col("call_no").alias("_base"), "done"))
        else:
            partials = partials.withColumn("done", F.lit(False))
        partials = partials.checkpoint(eager=True)
        # A call whose number a finished carry row holds has been written before.
        written = partials.where("done").select(*self.keys, F.col("_base").alias("call_no"), F.lit(True).alias("was"))
        calls = C.merge_partials(partials, self.keys, self.gap, "previous", "call_no").join(
            written, [*self.keys, "call_no"], "left")
        newest_call = calls.groupBy(*self.keys).agg(F.max("call_no").alias("_no"))
        over = F.lit(upto if upto is not None else CARRIED) - F.col("_last_e") > C.interval_micros(self.gap)
        calls = (calls.join(newest_call, list(self.keys))
                 .withColumn("newest", F.col("call_no") == F.col("_no"))
                 .withColumn("done", ~F.col("newest") | over).checkpoint(eager=True))
        self._write(calls.where("done and was is null").select(*self.keys, *CARRY[:6]), "calls", batch_id)
        self._write(calls.where("newest").select(*self.keys, *CARRY), "state/carry", batch_id)
        self._write(rows.where(start >= upto) if upto is not None else rows, "state/pending", batch_id)
        self._write(spark.createDataFrame([(upto,)], "closed long"), "state/mark", batch_id)
        for name in ("state/carry", "state/pending"):  # the one before may still be needed for a replay
            remove_folder(spark, self._path(name, batch_id - 2))

    def start(self, records: DataFrame, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
        """Run over a stream of records; ``trigger=None`` drains it once."""
        w = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.handle)
        w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
        return w.start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The calls written so far."""
        return self._table(spark, "calls")

    def late(self, spark: SparkSession) -> DataFrame:
        """Records that came after their bucket had been closed."""
        return self._table(spark, "late")

    def _table(self, spark: SparkSession, name: str) -> DataFrame:
        path = os.path.join(self.root, name)
        return spark.read.option("basePath", path).parquet(path)
