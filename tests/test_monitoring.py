"""Metrics, rules, alert state and health (F6), timers and progress (F9)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from driftwood.operators import alerts as AL
from driftwood.operators import metrics as MT

T = dt.datetime(2024, 1, 1, 12, 0, 0)


def _points(spark, rows):
    return spark.createDataFrame(
        [(n, ts, seq, float(v), tags) for n, ts, seq, v, tags in rows],
        "name string, ts timestamp, seq long, value double, tags map<string,string>")


def test_sample_rules_give_two_warnings(spark):
    p = _points(spark, [("messages.per_second", T, 1, 150.0, {"source": "mqtt"}),
                        ("kafka.consumer.lag", T, 2, 1500.0, {"topic": "iot-data"}),
                        ("system.memory.usage_percent", T, 3, 87.5, {})])
    a = AL.evaluate_rules(p, AL.rules_frame(spark), F.lit(T)).collect()
    assert sorted(r.component for r in a) == ["monitor.kafka_lag", "monitor.memory_usage_high"]
    msg = {r.component: r.message for r in a}
    assert msg["monitor.memory_usage_high"] == "Memory usage is high (current: 87.5, threshold: 85)"
    log = spark.createDataFrame(
        [(r.id, "create", r.ts, i, r.severity, r.component, r.message) for i, r in enumerate(a)],
        "id string, action string, ts timestamp, seq long, severity string, component string, "
        "message string")
    h = AL.system_health(AL.active_alerts(AL.alert_state(log))).collect()[0]
    assert (h.status, h.total_alerts, h.critical_alerts, h.warning_alerts) == ("WARNING", 2, 0, 2)


def test_rules_need_recent_data_and_since_is_inclusive(spark):
    old = T - dt.timedelta(minutes=5, seconds=1)
    p = _points(spark, [("kafka.consumer.lag", old, 1, 5000.0, {}),
                        ("system.memory.usage_percent", T - dt.timedelta(minutes=5), 2, 99.0, {})])
    a = AL.evaluate_rules(p, AL.rules_frame(spark), F.lit(T)).collect()
    assert [r.component for r in a] == ["monitor.memory_usage_high"]


def _log(spark, rows):
    return spark.createDataFrame(rows, "id string, action string, ts timestamp, seq long, "
                                       "severity string, component string, message string")


def test_alert_state_overwrite_resolve_and_degraded(spark):
    log = _log(spark, [
        ("a_1", "create", T, 1, "ERROR", "a", "first"),
        ("a_1", "create", T, 2, "ERROR", "a", "same id, same second: replaces"),
        ("b_1", "create", T, 3, "CRITICAL", "b", "x"),
        ("b_1", "resolve", T + dt.timedelta(seconds=1), 4, None, None, None),
        ("zz", "resolve", T, 5, None, None, None),
    ])
    state = {r.id: r for r in AL.alert_state(log).collect()}
    assert set(state) == {"a_1", "b_1"}
    assert state["a_1"].message.startswith("same id") and not state["a_1"].resolved
    assert state["b_1"].resolved
    h = AL.system_health(AL.active_alerts(AL.alert_state(log))).collect()[0]
    assert h.status == "DEGRADED"


def test_retention_keeps_last_1000(spark):
    p = _points(spark, [("m", T, i, float(i), {}) for i in range(1001)])
    kept = MT.retain_last(p).collect()
    assert len(kept) == 1000 and min(r.seq for r in kept) == 1


def test_summary_latest_is_last_appended(spark):
    p = _points(spark, [("m", T, 2, 5.0, {}), ("m", T, 1, 7.0, {})])
    s = MT.metric_summary(p, F.lit(T)).collect()[0]
    assert (s["count"], s["min"], s["max"], s["latest"]) == (2, 5.0, 7.0, 5.0)


def test_timers_ignore_unmatched_end(spark):
    log = spark.createDataFrame([("ingest_1", "start", T),
                                 ("ingest_1", "end", T + dt.timedelta(milliseconds=250)),
                                 ("ghost_2", "end", T)], "timer_id string, phase string, ts timestamp")
    d = MT.timer_durations(log).collect()
    assert [(r.name, r.value) for r in d] == [("performance.ingest.duration_ms", 250.0)]


def test_progress_state_memory_with_and_without_operators(spark):
    base = {"id": "q", "name": "n", "timestamp": "2024-01-01T00:00:00.000Z", "batchId": 1,
            "inputRowsPerSecond": 1.0, "processedRowsPerSecond": 2.0,
            "durationMs": {"triggerExecution": 10}}
    lines = [dict(base, stateOperators=[{"memoryUsedBytes": 1048576, "numRowsTotal": 1,
                                         "numRowsDroppedByWatermark": 3}]),
             dict(base, batchId=2, stateOperators=[])]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines], "json string")
    p = {r.batch_id: r for r in MT.progress_metrics(df).collect()}
    assert p[1].state_store_memory_mb == 1.0 and p[1].rows_dropped_by_watermark == 3
    assert p[2].state_store_memory_mb == 0.0
    assert MT.latest_progress(MT.progress_metrics(df)).collect()[0].batch_id == 2
