"""Quality validation and profiling on the hand-computed golden (F5)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from driftwood.operators import profile as P
from driftwood.operators import quality as Q

MESSAGES = [
    {"device_id": "sensor_001", "timestamp": "2024-01-15T10:30:00Z", "protocol": "MQTT",
     "temperature": 23.5, "humidity": 45.2, "pressure": 1013.25},
    {"device_id": "sensor_002", "timestamp": "2024-01-15T10:31:00Z", "protocol": "SNMP",
     "temperature": 85.0, "humidity": 85.0, "pressure": 1015.5},
    {"device_id": "", "timestamp": "invalid-timestamp", "protocol": "UNKNOWN",
     "temperature": "not-a-number"},
]
AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def _msgs(spark, messages=MESSAGES):
    df = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)],
                               "id int, json string")
    return P.parse_messages(df)


def _validate(spark, messages=MESSAGES):
    v = Q.validate(_msgs(spark, messages), as_of=F.lit(AS_OF))
    return {r.id: r.validation for r in v.select("id", "validation").collect()}


def test_golden_rows(spark):
    r = _validate(spark)
    assert r[0].is_valid and r[0].quality_score == 100 and len(r[0].warnings) == 1
    assert r[1].is_valid and r[1].quality_score == 100 and len(r[1].warnings) == 3
    assert not r[2].is_valid and r[2].quality_score == 45 and len(r[2].errors) == 5
    q = r[2].metrics
    assert (q["device_id_quality"], q["timestamp_quality"], q["protocol_quality"],
            q["temperature_quality"]) == (65, 70, 75, 70)
    assert "humidity_quality" not in q


def test_golden_summary_and_profile(spark):
    m = _msgs(spark)
    s = Q.quality_summary(Q.validate(m, as_of=F.lit(AS_OF))).collect()[0]
    assert (s.valid_messages, s.invalid_messages, s.total_errors, s.total_warnings) == (2, 1, 5, 4)
    assert abs(s.validation_rate - 2 / 3) < 1e-9
    assert abs(s.average_quality_score - 245 / 3) < 1e-9
    t = P.profile_timestamps(m).collect()[0]
    assert t.total_timestamps == 2 and abs(t.span_hours - 1 / 60) < 1e-12
    assert t.average_interval_seconds == 60
    assert P.profile_devices(m).count() == 3
    prot = {r.protocol: r.messages for r in P.profile_protocols(m).collect()}
    assert prot == {"MQTT": 1, "SNMP": 1, "UNKNOWN": 1}
    f = {r.field: r for r in P.profile_fields(m).collect()}
    assert f["temperature"]["count"] == 3
    assert f["temperature"].type_distribution == "float=2,str=1"
    assert f["humidity"]["count"] == 2 and f["humidity"].completeness == 1.0


def test_edge_rows(spark):
    r = _validate(spark, [
        {"device_id": None, "timestamp": "2024-01-31T23:00:00Z", "protocol": "TCP"},
        {"timestamp": "2024-01-31T23:00:00Z"},
        {"device_id": "abc", "timestamp": "2024-01-31T23:00:00Z", "protocol": "TCP",
         "temperature": 21, "humidity": "55.5", "pressure": 1000.123},
        {"device_id": "x" * 51, "timestamp": "2024-01-31T23:00:00Z", "protocol": "TCP"},
        {},
    ])
    assert not r[0].is_valid and "Missing required field: device_id" in r[0].errors
    assert r[1].quality_score == 60
    assert r[2].is_valid and r[2].warnings == ["pressure: Too many decimal places"]
    assert r[3].is_valid and r[3].warnings == ["device_id: Too long (max: 50)"]
    assert r[4].quality_score == 40


def test_field_stats_and_nulls(spark):
    msgs = [{"k": i, "n": None if i % 2 else i, "big": 12345678901234567890, "x": 25.0 if i % 3 else 25}
            for i in range(150)]
    f = {r.field: r for r in P.profile_fields(_msgs(spark, msgs)).collect()}
    assert f["k"].distinct_values == 150 and f["k"]["count"] == 150 and f["k"].uniqueness == 1
    assert f["n"].null_count == 75 and f["n"].completeness == 0.5
    assert len(f["k"].sample_values.split("|")) == 100  # the list alone is cut
    assert f["big"].type_distribution == "int=150" and f["big"].sample_values == "12345678901234567890"
    assert f["x"].type_distribution == "float=100,int=50" and f["x"].sample_values == "25|25.0"
