"""Message path: parse, flatten and processed records on edge rows, and the
parse evaluated once per row in the executed plan."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood.operators import messages as M

ENV_TS = "2024-03-01T10:00:00.000000Z"


def _kafka(spark, values):
    rows = [(f"k{i}".encode(), v.encode(), "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, "
                                       "partition int, offset long")


VALUES = [
    # complete message
    '{"timestamp": "%s", "data": {"timestamp": "2024-03-01T09:59:58.500000Z", '
    '"device_id": "d1", "protocol": "MQTT", "data": {"temperature": "81.5"}, '
    '"metadata": {"event_id": "1"}}}' % ENV_TS,
    # no inner timestamp: event time falls back to the envelope's
    '{"timestamp": "%s", "data": {"device_id": "d2", "protocol": "TCP", '
    '"data": {"temperature": "20"}}}' % ENV_TS,
    # null inner timestamp counts as missing
    '{"timestamp": "%s", "data": {"timestamp": null, "device_id": "d3"}}' % ENV_TS,
    # no device
    '{"timestamp": "%s", "data": {"timestamp": "%s", "protocol": "MQTT"}}' % (ENV_TS, ENV_TS),
    # not JSON
    "not json at all",
]


def test_flatten_drops_deviceless_and_falls_back_to_envelope_time(spark):
    flat = M.flatten_messages(M.parse_envelope(_kafka(spark, VALUES)))
    got = {r.device_id: r for r in flat.collect()}
    assert sorted(got) == ["d1", "d2", "d3"]
    assert got["d1"].event_time == dt.datetime(2024, 3, 1, 9, 59, 58, 500000)
    assert got["d2"].event_time == dt.datetime(2024, 3, 1, 10, 0, 0)
    assert got["d3"].event_time == dt.datetime(2024, 3, 1, 10, 0, 0)
    assert got["d1"].sensor_data == {"temperature": "81.5"}
    assert got["d1"].offset == 0 and got["d2"].topic == "t"


def test_processed_records_need_device_and_timestamp(spark):
    p = M.processed_records(M.parse_envelope(_kafka(spark, VALUES)))
    rows = p.collect()
    assert [r.device_id for r in rows] == ["d1"]
    assert rows[0].metadata == {"event_id": "1"}
    alerts = M.temperature_alerts(p).collect()
    assert [(a.device_id, a.value) for a in alerts] == [("d1", 81.5)]
    # a message without maps still forwards, with empty maps
    bare = ('{"timestamp": "%s", "data": {"timestamp": "%s", "device_id": "d9"}}'
            % (ENV_TS, ENV_TS))
    r = M.processed_records(M.parse_envelope(_kafka(spark, [bare]))).collect()[0]
    assert r.metrics == {} and r.metadata == {}


def test_parse_runs_once_per_row(spark):
    """The row filter must not inline the JSON parse below the projection
    (that parses every value twice)."""
    kafka = _kafka(spark, VALUES).withColumn("value", F.concat(F.col("value"), F.lit(" ")))
    for df in (M.flatten_messages(M.parse_envelope(kafka)),
               M.processed_records(M.parse_envelope(kafka))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1, plan
