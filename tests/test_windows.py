"""Sliding windows, anomaly thresholds and health ladders (F4)."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood.operators import anomalies as A
from driftwood.operators import health as H
from driftwood.operators import windows as W
from driftwood.plans.views import iot

from conftest import SF_SMALL


def test_pane_path_equals_direct_windows(spark):
    rows = iot(spark, SF_SMALL)
    cols = ["device_id", "protocol", "window_duration", "window_start", "message_count",
            "max_temperature", "min_temperature", "max_vibration"]
    r9 = ["avg_temperature", "stddev_temperature", "avg_humidity", "avg_pressure", "avg_vibration"]

    def norm(df):
        return df.select(*cols, *[F.round(c, 6).alias(c) for c in r9])
    panes = norm(W.window_metrics(rows, method="panes"))
    direct = norm(W.window_metrics(rows, method="direct"))
    assert panes.count() == direct.count()
    assert panes.exceptAll(direct).count() == 0


def test_each_event_lands_in_ten_windows(spark):
    df = spark.createDataFrame([("d", "MQTT", dt.datetime(2024, 1, 1, 0, 7, 13), 20.0, 50.0,
                                 1000.0, 1.0)],
                               "device_id string, protocol string, event_time timestamp, "
                               "temperature double, humidity double, pressure double, "
                               "vibration double")
    out = W.window_metrics(df).collect()
    assert len(out) == 10
    assert all(r.window_start <= dt.datetime(2024, 1, 1, 0, 7, 13) < r.window_end for r in out)
    assert all(r.stddev_temperature is None for r in out)


def _one(spark, **kw):
    base = dict(device_id="d", protocol="MQTT", window_start=None, window_end=None,
                window_duration="1 minute", message_count=50, avg_temperature=22.0,
                max_temperature=22.0, min_temperature=22.0, avg_humidity=50.0,
                max_vibration=5.0)
    base.update(kw)
    return spark.createDataFrame([base], "device_id string, protocol string, "
                                 "window_start timestamp, window_end timestamp, "
                                 "window_duration string, message_count long, "
                                 "avg_temperature double, max_temperature double, "
                                 "min_temperature double, avg_humidity double, "
                                 "max_vibration double")


def test_anomaly_thresholds(spark):
    def kinds(**kw):
        return sorted(r.anomaly_type for r in A.detect_anomalies(_one(spark, **kw)).collect())
    assert kinds(max_temperature=80.0) == []
    assert kinds(max_temperature=80.01) == ["TEMPERATURE_EXTREME"]
    assert kinds(min_temperature=-10.0) == []
    assert kinds(min_temperature=-10.01) == ["TEMPERATURE_EXTREME"]
    assert kinds(avg_humidity=95.0) == [] and kinds(avg_humidity=5.0) == []
    assert kinds(avg_humidity=95.01) == ["HUMIDITY_EXTREME"]
    assert kinds(avg_humidity=4.99) == ["HUMIDITY_EXTREME"]
    assert kinds(max_vibration=100.0) == []
    assert kinds(max_vibration=100.01) == ["HIGH_VIBRATION"]
    assert kinds(message_count=5) == []
    assert kinds(message_count=4) == ["LOW_FREQUENCY"]


def test_health_ladders(spark):
    best = H.health_scores(_one(spark, avg_temperature=22.5, avg_humidity=50.0,
                                max_vibration=10.0, message_count=100)).collect()[0]
    worst = H.health_scores(_one(spark, avg_temperature=None, avg_humidity=None,
                                 max_vibration=None, message_count=0)).collect()[0]
    assert (best.health_score, best.health_status) == (100.0, "EXCELLENT")
    assert (round(worst.health_score, 9), worst.health_status) == (24.0, "CRITICAL")
    edge = H.health_scores(_one(spark, avg_temperature=25.0, avg_humidity=60.0,
                                max_vibration=25.0, message_count=50)).collect()[0]
    assert round(edge.health_score, 9) == 30.0 + 20.0 + 24.0 + 16.0
