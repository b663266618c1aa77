"""Sinks: JSON value rows, the JSON health stream, replay-safe quarantine."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood import sinks

from conftest import SF_SMALL

T = dt.datetime(2024, 1, 1)


def test_as_json_value_round_trips(spark):
    df = spark.createDataFrame([("d1", 1.5, T), ("d2", None, T)],
                               "device_id string, score double, ts timestamp")
    out = sinks.as_json_value(df, key="device_id")
    assert out.columns == ["key", "value"]
    back = out.select("key", F.from_json("value", df.schema).alias("r")).select("key", "r.*")
    assert sorted(back.collect()) == sorted(
        (r.device_id, r.device_id, r.score, r.ts) for r in df.collect())


def test_analytics_targets_replace_a_replayed_batch(spark, tmp_path):
    """SNK-3/4/5: two topics and JSON files under one batch id, with sent counts."""
    windows = spark.createDataFrame([("d1", 3, T), ("d2", 4, T)], "device_id string, message_count long, window_start timestamp")
    anomalies = spark.createDataFrame([("d1", "HIGH_VIBRATION", 120.5)], "device_id string, anomaly_type string, anomaly_value double")
    health = spark.createDataFrame([("d1", 0.9, "HEALTHY"), ("d2", 0.4, "CRITICAL"), ("d3", None, None)],
                                   "device_id string, health_score double, health_status string")
    cfg = sinks.SinkConfig(kind="files", path=str(tmp_path / "topics"))
    for batch_id in (0, 1, 0):
        sent = sinks.publish_analytics(windows, anomalies, health, cfg, str(tmp_path / "health"), batch_id)
        assert sent == {"": 3, sinks.RESULTS_TOPIC: 2, sinks.ANOMALIES_TOPIC: 1, "health": 3}
    topics = spark.read.json(str(tmp_path / "topics"))
    got = {(r.batch_id, r.topic, r.key): r.value for r in topics.collect()}
    assert len(got) == topics.count() == 6
    assert '"anomaly_value":120.5' in got[1, sinks.ANOMALIES_TOPIC, "d1"]
    scores = spark.read.schema(health.schema).json(str(tmp_path / "health"))
    assert scores.count() == 6 and scores.where("health_status = 'CRITICAL'").count() == 2


def test_sent_counts_per_topic(spark, tmp_path):
    """SNK-7: observed during the write; topics not asked for only count in all."""
    rows = spark.createDataFrame([("k", "v", "a"), (None, "v", "a"), ("k", None, "b"), ("k", "v", None)],
                                 "key string, value string, topic string")
    cfg = sinks.SinkConfig(kind="files", path=str(tmp_path / "t"))
    assert sinks.publish_rows(rows, cfg, 0, ("a", "c")) == {"": 4, "a": 2, "c": 0}
    assert sinks.publish_rows(rows.limit(0), cfg, 1, ("a",)) == {"": 0, "a": 0}


def test_quarantine_replayed_batch_replaces_its_output(spark, tmp_path):
    bad = spark.createDataFrame([(1, "no_device"), (2, "bad_json"), (3, "bad_json")],
                                "source_id long, reason string")
    path = str(tmp_path / "q")
    sinks.write_quarantine(bad, path, batch_id=7)
    sinks.write_quarantine(bad, path, batch_id=7)   # the same batch, replayed
    sinks.write_quarantine(bad.limit(1), path, batch_id=8)
    got = spark.read.parquet(path)
    assert got.count() == 4
    assert sorted(r.reason for r in got.where(F.col("batch_id") == 7).collect()) == \
        ["bad_json", "bad_json", "no_device"]
    # without a batch id the quarantine appends
    plain = str(tmp_path / "p")
    sinks.write_quarantine(bad, plain)
    sinks.write_quarantine(bad, plain)
    assert spark.read.parquet(plain).count() == 6


def test_published_rows_are_not_dealt_by_topic(spark):
    """SNK-7: the sent counts go to the rows, whatever the join threshold; a
    sort by topic would put a topic's rows into one task."""
    from driftwood.plans.q_io import route_published
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = route_published(spark, SF_SMALL)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert "SortMergeJoin" not in plan and "hashpartitioning(topic" not in plan
    sent = {}
    for r in rows:
        sent.setdefault(r["topic"], []).append(r["sent"])
    assert len(rows) == 1000 and all(set(n) == {len(n)} for n in sent.values())
