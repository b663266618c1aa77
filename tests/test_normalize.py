"""Protocol payload normalisation (F7), shifts and routing (F8)."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood.functions.text import topic_matches
from driftwood.operators import messages as M
from driftwood.operators import normalize as N
from driftwood.schemas import RAW_PAYLOAD_SCHEMA

T = dt.datetime(2024, 1, 1)


def _raw(spark, rows):
    full = []
    for r in rows:
        d = {f.name: None for f in RAW_PAYLOAD_SCHEMA.fields}
        d.update(r)
        full.append(tuple(d[f.name] for f in RAW_PAYLOAD_SCHEMA.fields))
    return spark.createDataFrame(full, RAW_PAYLOAD_SCHEMA).withColumn(
        "source_id", F.monotonically_increasing_id())


def test_mqtt_device_and_payloads(spark):
    raw = _raw(spark, [
        dict(protocol="MQTT", received_at=T, topic="sensors/dev7/data", qos=1, retain=False,
             payload=b'{"temperature": 21.5}'),
        dict(protocol="MQTT", received_at=T, topic="x", qos=0, retain=True, payload=b"42"),
        dict(protocol="MQTT", received_at=T, topic="sensors/dev8/data", qos=0, retain=True,
             payload=b"hello"),
    ])
    out = {r.device_id: r for r in N.normalize_mqtt(raw).collect()}
    assert out["dev7"].data == {"temperature": "21.5"}
    assert out["unknown"].data == {"raw_message": "42"}
    assert out["dev8"].data == {"raw_message": "hello"}
    assert out["dev7"].metadata == {"topic": "sensors/dev7/data", "qos": "1", "retain": "false"}


def test_tcp_binary_text_json(spark):
    raw = _raw(spark, [
        dict(protocol="TCP", received_at=T, host="h", port=1, payload=bytes.fromhex("FF00")),
        dict(protocol="TCP", received_at=T, host="h", port=1, payload=b"plain"),
        dict(protocol="TCP", received_at=T, host="h", port=1, device_id="plc", payload=b'{"a": 1}'),
    ])
    out = N.normalize_tcp(raw).collect()
    data = sorted([r.data for r in out], key=str)
    assert {"raw_binary": "ff00", "size": "2"} in data
    assert {"raw_text": "plain"} in data and {"a": "1"} in data
    assert sorted(r.device_id for r in out) == ["plc", "tcp_h_1", "tcp_h_1"]


def test_snmp_and_coap_folds(spark):
    oids = ["1.3.6.1.2.1.1.1.0", "1.3.6.1.2.1.1.3.0"]
    raw = _raw(spark, [
        dict(protocol="SNMP", received_at=T, host="10.0.0.1", port=161, community="public",
             poll_id="p1", oid=oids[0], oid_value="desc"),
        dict(protocol="SNMP", received_at=T, host="10.0.0.1", port=161, community="public",
             poll_id="p1", oid=oids[1], oid_value="123"),
        dict(protocol="CoAP", received_at=T, host="c", port=5683, poll_id="q1",
             resource="/sensors/temperature", response_code="2.05", payload=b'{"v": 1}'),
        dict(protocol="CoAP", received_at=T, host="c", port=5683, poll_id="q1",
             resource="/sensors/humidity", response_code="4.04", payload=b"x"),
        dict(protocol="CoAP", received_at=T, host="c", port=5683, poll_id="q2",
             resource="/sensors/humidity", response_code="5.00", payload=b"x"),
    ])
    s = N.fold_snmp(raw).collect()
    assert len(s) == 1 and s[0].device_id == "snmp_10.0.0.1"
    assert s[0].data == {oids[0]: "desc", oids[1]: "123"}
    c = N.fold_coap(raw).collect()
    assert len(c) == 1 and c[0].data == {"/sensors/temperature": '{"v":1}'}
    assert N.normalize_all(raw).count() == 2



def test_poll_fold_keeps_last_arrival_per_oid(spark):
    """A value repeated within a poll keeps its last arrival (as a
    dictionary update does); the message id is the poll's first arrival."""
    poll = dict(protocol="SNMP", received_at=T, host="h", port=161, community="c", poll_id="p")
    rows = [dict(poll, oid="b", oid_value="b1"), dict(poll, oid="a", oid_value="a1"),
            dict(poll, oid="b", oid_value="b2"), dict(poll, oid="a", oid_value="a2"),
            dict(poll, oid="c", oid_value="c1"),
            dict(poll, oid="b", oid_value="b3", received_at=T + dt.timedelta(seconds=1))]
    raw = _raw(spark, rows)
    first = raw.agg(F.min("source_id")).first()[0]
    s = N.fold_snmp(raw).collect()
    assert len(s) == 1
    assert s[0].data == {"a": "a2", "b": "b3", "c": "c1"}
    assert s[0].source_id == first and s[0].timestamp == T + dt.timedelta(seconds=1)

def test_topic_filter():
    from driftwood.functions.text import topic_pattern_regex
    import re
    rx = re.compile(topic_pattern_regex("sensors/+/data"))
    assert rx.match("sensors/a/data") and not rx.match("sensors/a/b/data")
    assert topic_matches is not None


def test_shift_and_route(spark):
    docs = spark.createDataFrame([
        ('{"timestamp": "t1", "deviceId": "d1", "sensorData": {"t": 1.5}, "location": "z", "fw": "v1"}',),
        ('{"deviceId": "d2", "sensorData": {}}',),
    ], "doc string")
    s = docs.select(M.shift_document(F.col("doc")).alias("s")).select("s.*")
    r = {x.device_id: x for x in M.route_valid(s).collect()}
    assert r["d1"].metrics == {"t": "1.5"} and r["d1"].extra == {"fw": "v1"}
    assert r["d1"].geo_location == "z" and r["d1"].route == "valid"
    assert r["d2"].route == "invalid"
    nested = spark.createDataFrame([(
        '{"timestamp": "t", "deviceId": "d", "temperature": 1.0, "humidity": 2.0, "pressure": 3.0,'
        ' "location": {"lat": 1.5, "lon": 2.5}, "metadata": {"fw": "x"}, "junk": 1}',)], "doc string")
    n = nested.select(M.shift_nested(F.col("doc")).alias("s")).collect()[0].s
    assert n.geo_location.latitude == 1.5 and n.device_metadata == {"fw": "x"}
    assert "junk" not in n.asDict()


def test_text_behind_a_json_value_is_no_json(spark):
    """NRM-2/5/6: what follows a value may not close the parser's wrapping."""
    from driftwood.operators.normalize import whole_json
    bad = ['{"a":1}] x', '{"a":1}]', '{"a":1}}', '{"a":1},"b":2', '{"a":1}] , [2', "1,2", "1],[2", '1,"b":2', '{"a":1} x',
           "", "x", '{"a":1}}x', '{"a":1}, "k": 3', '{"a":1}],"', '{"a":1}]}', '{"a":1}}]', "[1]]", "[1],[2]", '{"a":[1]}] x']
    good = ['{"a":1}', "1", '"x"', "[1,2]", '{"a":{"b":[1]}}', '{"a":"]"}', "[[1],[2]]", '{"a":"}]"}']
    rows = spark.createDataFrame([(x, False) for x in bad] + [(x, True) for x in good] + [(" " + x + " ", True) for x in good],
                                 "t string, good boolean")
    wrong = rows.where(whole_json(F.col("t")).isNotNull() != F.col("good"))
    assert [r.t for r in wrong.collect()] == []
