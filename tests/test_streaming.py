"""Streaming: stream = batch, open windows and the final flush, joins, calls,
tables of versions and commits, callbacks, the fan-out pipeline, and the Kafka option map."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from driftwood.operators import windows as W
from driftwood.plans.q_streaming import events_stream
from driftwood.plans.views import iot, iot_from
from driftwood.sources.stream import SourceConfig, kafka_options
from driftwood.streaming.pipeline import END_OF_STREAM, PipelineConfig, run_available_now, run_bounded, start_pipeline, window_versions
from driftwood.streaming.sessions import CallStream
from driftwood.streaming.tables import BatchManifest, VersionedTable

from conftest import SF_SMALL


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_drained_stream_keeps_open_windows(spark):
    """Without a flush, windows that the watermark has not passed stay out."""
    readings = iot_from(events_stream(spark, SF_SMALL)).withWatermark("event_time", "10 minutes")
    batch = W.window_metrics(iot(spark, SF_SMALL))
    cut = iot(spark, SF_SMALL).agg(F.max("event_time")).collect()[0][0]
    batch = batch.where(F.col("window_end") <= F.lit(cut - dt.timedelta(minutes=10)))
    cols = ["device_id", "protocol", "window_duration", "window_start", "message_count"]
    for method in ("direct", "stream"):
        stream = run_available_now(W.window_metrics(readings, method=method), spark, "t-stream")
        assert same(stream.select(*cols), batch.select(*cols))


def test_chained_windows_read_once_and_flush(spark, tmp_path):
    """STR-2: one source, two states, all windows of a bounded stream."""
    def plan(readings):
        return W.window_metrics(readings.withWatermark("event_time", "10 minutes"), method="stream")
    source = iot_from(events_stream(spark, SF_SMALL))
    got = run_bounded(source, plan, "t-bounded", [{"device_id": "<end>", "event_time": END_OF_STREAM}])
    cols = ["device_id", "protocol", "window_duration", "window_start", "window_end", "message_count",
            "max_temperature", "min_temperature", "max_vibration"]
    assert same(got.select(*cols), W.window_metrics(iot(spark, SF_SMALL)).select(*cols))
    q = (plan(source).writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    first = q.recentProgress[0]
    assert first.numInputRows == iot(spark, SF_SMALL).count() and len(first.sources) == 1
    assert len(first.stateOperators) == 2


def test_polls_fold_on_a_stream(spark):
    """NRM-3/4 and SET-2: the stream gives the batch's messages; repeated
    values keep the last arrival, rows without a poll id stay alone."""
    from driftwood.operators import normalize as N
    from driftwood.plans import q_normalize as QN
    got = run_bounded(QN.landing_from(iot_from(events_stream(spark, SF_SMALL))),
                      lambda raw: N.normalize_all(raw.withWatermark("received_at", "10 minutes"), resources=QN.RESOURCES),
                      "t-landing", [{"protocol": "SNMP", "received_at": END_OF_STREAM}])
    want = N.normalize_all(QN.landing(spark, SF_SMALL), resources=QN.RESOURCES)
    assert same(QN.shown(got), QN.shown(want))


def test_timers_on_streams_equal_the_batch_rule(spark):
    """JOI-3: ids used again, starts that start anew, ends without a start,
    second ends, equal times, and timers longer than the range."""
    from driftwood.operators.metrics import timer_durations, timer_durations_stream
    from driftwood.session import scratch_path
    r, log, t = random.Random(5), [], dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for k in range(60):
        at = t + dt.timedelta(seconds=r.randrange(600))
        for _ in range(r.randrange(1, 7)):
            log.append((f"op{k % 3}_{k}", r.choice(["start", "end"]), at))
            at += dt.timedelta(seconds=r.choice([0, 1, 30, 400, 4000]))
    path = scratch_path(spark, "t-timers")
    frame = spark.createDataFrame(log, "timer_id string, phase string, ts timestamp").distinct()
    frame.coalesce(1).write.parquet(path)
    source = spark.readStream.schema(frame.schema).parquet(path)

    def plan(rows):
        return timer_durations_stream(*(rows.where(F.col("phase") == p) for p in ("start", "end")))
    got = run_bounded(source, plan, "t-timers", [
        {"timer_id": f"<{p}>_0", "phase": p, "ts": END_OF_STREAM} for p in ("start", "end")])
    want = timer_durations(frame).where("value <= 3600000")
    assert want.count() > 20 and same(got, want)


def test_late_ends_are_ignored(spark, tmp_path):
    from driftwood.operators.metrics import timer_durations_stream
    t = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)

    def at(seconds):
        return t + dt.timedelta(seconds=seconds)
    files = [[("a_1", "start", at(0)), ("b_1", "start", at(5)), ("b_1", "end", at(9)), ("c_1", "start", at(20_000)), ("c_1", "end", at(20_001))],
             [("d_1", "start", at(40_000)), ("d_1", "end", at(40_002))],
             [("a_1", "end", at(30)), ("e_1", "start", at(60_000)), ("e_1", "end", at(60_004))]]
    schema = "timer_id string, phase string, ts timestamp"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    got = run_bounded(log, lambda rows: timer_durations_stream(*(rows.where(F.col("phase") == p) for p in ("start", "end"))),
                      "t-late", [{"timer_id": f"<{p}>_0", "phase": p, "ts": END_OF_STREAM} for p in ("start", "end")])
    assert {(x.timer_id, x.value) for x in got.collect()} == {("b_1", 4000.0), ("c_1", 1000.0), ("d_1", 2000.0), ("e_1", 4000.0)}


def call_rows(spark, n=600, seed=3):
    """Records of a few keys, one of them a third of all."""
    r = random.Random(seed)
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = []
    for i in range(n):
        key = (1, "x") if r.random() < 0.34 else (r.randrange(2, 9), r.choice("xy"))
        start = t + dt.timedelta(seconds=r.randrange(8 * 3600))
        rows.append((*key, start, start + dt.timedelta(seconds=r.choice([0, 30, 200, 900])), r.randrange(99), r.randrange(99), i))
    return spark.createDataFrame(rows, "msisdn long, domain string, start_dt timestamp, end_dt timestamp, "
                                       "ulvolume long, dlvolume long, event_id long")


ORDER = ("end_dt", "ulvolume", "dlvolume", "event_id")


def test_call_stream_equals_batch_and_survives_replays(spark, tmp_path):
    """STR-10: any cut into micro-batches in time order, each run twice."""
    from driftwood.operators import calls as C
    records = C.idle_trim(call_rows(spark)).withColumn("h", F.hour("start_dt"))
    want = C.call_sessions(records, order=ORDER)
    for cuts in ([2, 5, 8],):
        s = CallStream(str(tmp_path / f"calls{len(cuts)}"), order=ORDER)
        for n, (a, b) in enumerate(zip([0, *cuts], cuts)):
            for _ in range(2):
                s.handle(records.where(F.col("h").between(a, b - 1)), n)
        s.finish(spark)
        got = s.read(spark)
        assert same(got.select(*want.columns), want) and s.late(spark).count() == 0
        assert got.select("batch_id").distinct().count() > 1  # calls come out as they close


def test_call_stream_sets_late_records_aside(spark, tmp_path):
    from driftwood.operators import calls as C
    records = C.idle_trim(call_rows(spark))
    s = CallStream(str(tmp_path / "late"), order=ORDER)
    late = F.col("start_dt") < F.lit(dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc))
    second = late & (F.col("event_id") % 2 == 0)
    s.handle(records.where(~second), 0)
    s.handle(records.where(second), 1)
    s.finish(spark)
    kept = records.where(~second)
    assert same(s.read(spark).drop("batch_id"), C.call_sessions(kept, order=ORDER).select(*s.read(spark).drop("batch_id").columns))
    assert s.late(spark).count() == records.where(second).count() > 0


def test_versioned_table(spark, tmp_path):
    """STR-4: later batches win, compaction and replays change nothing."""
    t = VersionedTable(str(tmp_path / "v"), ("k",))
    batches = [[(1, "a"), (2, "a")], [(2, "b"), (None, "b")], [(1, "c"), (3, None)], [(3, "d")]]
    held = {}
    for n, rows in enumerate(batches):
        held.update(rows)
        for _ in range(2):
            t.write(spark.createDataFrame(rows, "k long, v string"), n)
        if n in (1, 2):
            before = sorted(map(str, t.read(spark).collect()))
            t.compact(spark, n)
            assert sorted(map(str, t.read(spark).collect())) == before
        assert {r.k: r.v for r in t.read(spark).collect()} == held
    assert os.listdir(tmp_path / "v" / "base") == ["upto=2"]
    assert os.listdir(tmp_path / "v" / "deltas") == ["batch_id=3"]


def test_manifest_hides_a_batch_without_its_commit(spark, tmp_path):
    m = BatchManifest(str(tmp_path))
    for n in range(3):
        spark.range(n + 1).write.parquet(str(tmp_path / "out" / f"batch_id={n}"))
        if n != 1:
            m.commit(spark, n, {"out": n + 1})
    assert m.read(spark, "out").groupBy("batch_id").count().where("batch_id = 1").count() == 0
    assert m.read(spark, "out").count() == 4
    m.commit(spark, 1, {"out": 2})
    m.commit(spark, 1, {"out": 2})
    assert m.read(spark, "out").count() == 6 and m.committed(spark).count() == 3


def test_callbacks_are_isolated(spark, tmp_path):
    """UDF-2: by protocol, failures in a table, a replay replaces them."""
    from driftwood.streaming.callbacks import CallbackRegistry
    messages = spark.createDataFrame([("a", "TCP"), ("b", "MQTT"), ("c", "TCP")], "device_id string, protocol string")
    reg, seen = CallbackRegistry(str(tmp_path)), []
    reg.register("bad", lambda part, n: 1 / 0, "TCP")
    reg.register("tcp", lambda part, n: seen.append(("tcp", n, part.count())), "TCP")
    reg.register("all", lambda part, n: seen.append(("all", n, part.count())))
    reg.register("none", lambda part, n: seen.append(("none", n, part.count())), "CoAP")
    for n in (0, 0, 1):
        assert reg.run(messages, n) == ["bad"]
    assert seen[:3] == [("tcp", 0, 2), ("all", 0, 3), ("none", 0, 0)] and len(seen) == 9
    got = sorted(tuple(r) for r in reg.failures(spark).select("callback", "protocol", "batch_id", "error").collect())
    assert got == [("bad", "TCP", n, "ZeroDivisionError: division by zero") for n in (0, 1)]
    with pytest.raises(ValueError):
        reg.register("bad", print)


def test_kafka_options():
    o = kafka_options(SourceConfig(topics=("a", "b"), starting_offsets="earliest",
                                   include_headers=True, max_offsets_per_trigger=500))
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and o["includeHeaders"] == "true"
    assert o["maxOffsetsPerTrigger"] == "500"


def test_pipeline_fan_out_and_quarantine(spark, tmp_path):
    from driftwood.plans.q_messages import kafka_rows
    src = tmp_path / "src"
    rows = kafka_rows(spark, SF_SMALL).withColumn("partition", F.lit(0)) \
        .withColumn("offset", F.monotonically_increasing_id())
    rows.write.json(str(src))
    cfg = PipelineConfig(source=SourceConfig(kind="files", path=str(src), topics=()),
                         trigger=None, output_root=str(tmp_path / "out"),
                         checkpoint=str(tmp_path / "ckpt"))
    seen = []
    cfg.hooks["probe"] = lambda df, epoch: seen.append(epoch)
    cfg.hooks["broken"] = lambda df, epoch: 1 / 0
    for q in start_pipeline(spark, cfg):
        q.awaitTermination()
    out = tmp_path / "out"
    assert spark.read.parquet(str(out / "windows")).count() > 0
    assert spark.read.parquet(str(out / "health")).count() > 0
    reasons = {r.reason for r in spark.read.parquet(str(out / "quarantine")).select("reason")
               .distinct().collect()}
    assert "missing_device_id" in reasons
    assert seen and os.path.isdir(out / "anomalies")


def test_progress_listener_and_rule_monitor(spark, tmp_path):
    from driftwood.operators import alerts as AL
    from driftwood.operators.metrics import progress_metrics
    from driftwood.streaming.monitor import ProgressRecorder, read_progress, start_rule_monitor
    pts = tmp_path / "points"
    t = dt.datetime(2024, 1, 1, 12)
    spark.createDataFrame([("kafka.consumer.lag", t, 1, 1500.0), ("messages.per_second", t, 2, 3.0)],
                          "name string, ts timestamp, seq long, value double") \
        .write.parquet(str(pts))
    listener = ProgressRecorder(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("name string, ts timestamp, seq long, value double") \
            .parquet(str(pts))
        handled = []

        def drain():  # UDF-3: a failing handler does not stop the other
            start_rule_monitor(stream, AL.rules_frame(spark), str(tmp_path / "metrics"),
                               str(tmp_path / "alerts"), str(tmp_path / "ckpt"), every=None, handlers={
                                   "bad": lambda a, n: 1 / 0,
                                   "good": lambda a, n: handled.append((n, a.count()))}).awaitTermination()
        drain()
        # A second batch without the lagging metric: the rules still see it.
        spark.createDataFrame([("system.cpu.usage_percent", t + dt.timedelta(seconds=30), 3, 1.0)],
                              "name string, ts timestamp, seq long, value double") \
            .write.mode("append").parquet(str(pts))
        drain()
        spark.streams.awaitAnyTermination(1)
    finally:
        import time
        time.sleep(2)
        spark.streams.removeListener(listener)
    alerts = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert sorted(a.component for a in alerts) == ["monitor.kafka_lag", "monitor.kafka_lag",
                                                   "monitor.message_rate_low", "monitor.message_rate_low"]
    assert handled == [(0, 2), (1, 2)]
    days = [n for n in os.listdir(tmp_path / "metrics") if n.startswith("date=")]
    assert days == ["date=2024-01-01"]  # date first: a check lists one or two days
    prog = progress_metrics(read_progress(spark, str(tmp_path / "progress"))).collect()
    assert prog and all(p.state_store_memory_mb == 0.0 for p in prog)


def test_sinks_files_stand_in(spark, tmp_path):
    from driftwood.plans.q_messages import message_rows
    from driftwood.sinks import SinkConfig, write_messages, write_result_csv
    m = message_rows(spark, SF_SMALL).where(F.col("device_id").isNotNull())
    sent = write_messages(m, SinkConfig(kind="files", topic="iot-processed-data",
                                        path=str(tmp_path / "kafka")),
                          headers={"source": F.lit("events")})
    assert sent["sent"] == m.count()
    back = spark.read.json(str(tmp_path / "kafka"))
    assert back.count() == m.count() and set(back.columns) >= {"key", "value", "topic"}
    write_result_csv(m.select("event_id", "device_id"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == m.count()


def test_pipeline_update_mode(spark, tmp_path):
    from driftwood.plans.q_messages import kafka_rows
    src = tmp_path / "src"
    kafka_rows(spark, SF_SMALL).withColumn("partition", F.lit(0)) \
        .withColumn("offset", F.monotonically_increasing_id()).write.json(str(src))
    cfg = PipelineConfig(source=SourceConfig(kind="files", path=str(src), topics=()),
                         trigger=None, output_mode="update",
                         output_root=str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
    for q in start_pipeline(spark, cfg):
        q.awaitTermination()
    # update mode emits every window touched by the batch, open ones included
    windows = window_versions(str(tmp_path / "out")).read(spark)
    good = kafka_rows(spark, SF_SMALL)
    from driftwood.streaming.pipeline import parsed_messages
    want = W.window_metrics(parsed_messages(good))
    cols = ["device_id", "protocol", "window_duration", "window_start", "message_count"]
    assert same(windows.select(*cols), want.select(*cols))


def test_route_isolates_failing_handler(spark):
    from driftwood.operators.messages import dispatch_counts, route
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "topic string, v int")
    seen = {}
    failed = route(df, 0, {"a": lambda d, e: seen.setdefault("a", d.count()),
                           "b": lambda d, e: 1 / 0,
                           "c": lambda d, e: seen.setdefault("c", d.count())})
    assert failed == ["b"] and seen == {"a": 2, "c": 0}
    counts = {r.topic: (r.messages, r.handled) for r in dispatch_counts(df, ["a"]).collect()}
    assert counts == {"a": (2, True), "b": (1, False)}


def test_processing_flow_replay_and_topics(spark, tmp_path):
    """ALR-2: a replayed batch changes nothing; each row goes to its topic."""
    from driftwood.plans.q_messages import kafka_rows
    from driftwood.sinks import SinkConfig
    from driftwood.streaming.pipeline import processing_flow
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    step = processing_flow(str(tmp_path / "out"), at, publish=SinkConfig(kind="files", path=str(tmp_path / "topics")))
    rows = kafka_rows(spark, SF_SMALL)

    def counts():
        found = {n: spark.read.parquet(str(tmp_path / "out" / n)).count() for n in ("processed", "alerts", "quarantine")}
        topics = {r["topic"]: r["count"] for r in spark.read.json(str(tmp_path / "topics")).groupBy("topic").count().collect()}
        return found, topics
    step(rows, 0)
    first = counts()
    step(rows, 0)
    assert counts() == first
    assert first[0]["processed"] + first[0]["quarantine"] == rows.count()
    assert first[1] == {"iot-processed-data": first[0]["processed"], "iot-alerts": first[0]["alerts"]}


def test_a_stretch_of_events_is_read_by_many_tasks(spark, tmp_path):
    """STR-9: every micro-batch holds one stretch of time, in as many files as
    its rows need, also where the stretches are of unequal size or empty."""
    from driftwood.plans.q_streaming import timed_stream
    t = dt.datetime(2024, 1, 1)
    at = [t + dt.timedelta(seconds=k) for k in range(50)] + [t + dt.timedelta(hours=9)] * 3 + [None] * 2
    want = [50, 0, 5]
    spark.createDataFrame([(k, s) for k, s in enumerate(at)], "event_id long, ts timestamp_ntz").coalesce(1).write.parquet(
        str(tmp_path / "events.parquet"))
    seen = {}

    def each(batch, n):
        files = batch.select(F.input_file_name().alias("f"), "event_id").groupBy("f").count().collect()
        seen[n] = [r["count"] for r in files]
    (timed_stream(spark, str(tmp_path), rows_per_file=10).writeStream.foreachBatch(each)
     .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination())
    assert [sum(seen.get(n, [])) for n in range(3)] == want and len(seen) == 3
    assert max(max(n) for n in seen.values() if n) <= 10 and len(seen[0]) == 5


def test_a_deliberate_stop_does_not_fail_the_session(spark):
    """STR-9: a restarted query leaves no failure to the session's streams."""
    from driftwood.plans.q_streaming import flow_restart
    spark.streams.resetTerminated()
    assert flow_restart(spark, SF_SMALL).count() > 0
    spark.streams.awaitAnyTermination(1)


def test_committed_rows_are_not_dealt_by_batch(spark, tmp_path):
    """STR-9: the committed batches go to the rows, whatever the join
    threshold; a sort by batch would put a batch's rows into one task."""
    for n in range(3):
        spark.range(10 * n, 10 * n + 10).write.parquet(str(tmp_path / "processed" / f"batch_id={n}"))
    for n in (0, 2):
        BatchManifest(str(tmp_path)).commit(spark, n, {"processed": 10})
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = BatchManifest(str(tmp_path)).read(spark, "processed")
        ids = sorted(r["id"] for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert "SortMergeJoin" not in plan and ids == [*range(10), *range(20, 30)]


def test_pipeline_targets_work_is_spread_over_the_cluster(spark):
    """SNK-3/4/5: the messages of one small file are made by all tasks, and
    the windows' state has a partition a task, not one a batch shuffle."""
    from driftwood.plans.q_streaming import pipeline_targets
    from driftwood.session import ensure_checkpoint_dir, folder_exists, folder_names
    root, tasks = os.path.join(ensure_checkpoint_dir(spark), "driftwood"), spark.sparkContext.defaultParallelism
    before = set(folder_names(spark, root)) if folder_exists(spark, root) else set()
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * tasks))
    try:
        assert pipeline_targets(spark, SF_SMALL).count() > 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(3 * tasks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    made = {n.rsplit("-", 1)[0]: os.path.join(root, n) for n in set(folder_names(spark, root)) - before}
    assert sum(n.startswith("part-") for n in folder_names(spark, made["kafka-in"])) > tasks  # and the row that ends the stream
    state = os.path.join(made["pipeline-ckpt"], "windows", "state", "0")
    assert sum(n.isdigit() for n in folder_names(spark, state)) == tasks
