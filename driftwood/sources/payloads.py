"""SRC-6: the landing table of captured protocol payloads (batch or stream).

The network clients of the original (MQTT, SNMP, CoAP, TCP, WebSocket) are
single-machine I/O; a capture process lands their raw payloads in a table
with ``RAW_PAYLOAD_SCHEMA`` and the normalisers in
:mod:`driftwood.operators.normalize` read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.schemas import RAW_PAYLOAD_SCHEMA


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet",
                 stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing rows with a ``source_id`` that identifies each capture."""
    if stream:
        reader = spark.readStream.schema(RAW_PAYLOAD_SCHEMA).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = reader.load(path)
    else:
        df = spark.read.schema(RAW_PAYLOAD_SCHEMA).format(fmt).load(path)
    return df.withColumn("source_id", F.xxhash64(*[F.col(c) for c in RAW_PAYLOAD_SCHEMA.names]))
