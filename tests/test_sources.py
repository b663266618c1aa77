"""Sources and sinks: metric table with date pruning and an inclusive
``since`` (SRC-7, SNK-10, FLT-9), JSON messages, the payload landing table."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood.schemas import RAW_PAYLOAD_SCHEMA
from driftwood.sinks import append_metrics
from driftwood.sources import read_json_messages, read_metrics
from driftwood.sources.payloads import read_landing


def test_metrics_append_and_since_prunes(spark, tmp_path):
    t = dt.datetime(2024, 1, 2, 12)
    pts = spark.createDataFrame(
        [("m", t - dt.timedelta(days=1), 1, 1.0, {}), ("m", t, 2, 2.0, {}),
         ("m", t + dt.timedelta(minutes=1), 3, 3.0, {}), ("n", t, 4, 4.0, {})],
        "name string, ts timestamp, seq long, value double, tags map<string,string>")
    path = str(tmp_path / "metrics")
    append_metrics(pts, path)
    got = read_metrics(spark, path, names=["m"], since=t)
    assert sorted(r.seq for r in got.collect()) == [2, 3]          # since is inclusive
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "date#" in plan


def test_json_messages_keep_absent_and_null_apart(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"a": null}\n{"b": 1}\nnot json\n')
    rows = read_json_messages(spark, str(p)).collect()
    assert rows[2].msg is None
    a = read_json_messages(spark, str(p)).select(
        F.try_variant_get("msg", "$.a", "variant").isNull().alias("absent")).collect()
    assert [r.absent for r in a] == [False, True, True]


def test_landing_reader_batch_and_stream(spark, tmp_path):
    row = tuple(None for _ in RAW_PAYLOAD_SCHEMA.fields)
    df = spark.createDataFrame([row], RAW_PAYLOAD_SCHEMA).withColumn("protocol", F.lit("MQTT"))
    df.write.parquet(str(tmp_path / "landing"))
    batch = read_landing(spark, str(tmp_path / "landing"))
    assert batch.count() == 1 and "source_id" in batch.columns
    assert read_landing(spark, str(tmp_path / "landing"), stream=True).isStreaming
