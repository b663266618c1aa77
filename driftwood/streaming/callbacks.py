"""Callbacks on the normalised messages of a stream (UDF-2).

A callback is a function of a micro-batch of standard messages and its
number, registered for one protocol or for all. Each gets its slice of the
batch as a DataFrame, so its work is Spark's; one that fails is recorded in a
failure table and does not stop the others.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = logging.getLogger(__name__)
Callback = Callable[[DataFrame, int], None]
FAILURE_SCHEMA = "callback string, protocol string, batch_id long, error string"


@dataclass
class CallbackRegistry:
    """Callbacks by name; ``protocol`` None is every protocol."""
    root: str
    callbacks: dict[str, tuple[str | None, Callback]] = field(default_factory=dict)

    def register(self, name: str, callback: Callback, protocol: str | None = None) -> None:
        if name in self.callbacks:
            raise ValueError(f"callback {name!r} is registered already")
        self.callbacks[name] = (protocol, callback)

    def run(self, messages: DataFrame, batch_id: int) -> list[str]:
        """Run all callbacks on a batch; returns the names of those that
        failed. A replayed batch runs them again and replaces its failures."""
        spark, failed = messages.sparkSession, []
        held = messages.persist()
        try:
            for name, (protocol, callback) in self.callbacks.items():
                part = held if protocol is None else held.where(F.col("protocol") == protocol)
                try:
                    callback(part, batch_id)
                except Exception as problem:  # noqa: BLE001 - isolation is the contract
                    LOG.exception("callback %s failed on batch %s", name, batch_id)
                    failed.append((name, protocol, batch_id, f"{type(problem).__name__}: {problem}"))
        finally:
            held.unpersist()
        (spark.createDataFrame(failed, FAILURE_SCHEMA).drop("batch_id").write.mode("overwrite")
         .parquet(os.path.join(self.root, "callback_failures", f"batch_id={batch_id}")))
        return [f[0] for f in failed]

    def failures(self, spark) -> DataFrame:
        """The failure table: ``callback, protocol, batch_id, error``."""
        path = os.path.join(self.root, "callback_failures")
        return spark.read.schema(FAILURE_SCHEMA).option("basePath", path).parquet(path)

    def start(self, messages: DataFrame, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
        """Run the callbacks on every micro-batch of a stream of messages
        (:func:`driftwood.operators.normalize.normalize_all`)."""
        w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, batch_id: self.run(batch, batch_id) and None)
        w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
        return w.start()
