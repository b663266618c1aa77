"""Registered source and sink queries: rows derived from the driver tables
are written to the shared checkpoint folder and read back through the
sources (SRC-1/2/5/6/7, SNK-1/8/9/10).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from driftwood import sinks, sources
from driftwood.operators import messages as M
from driftwood.operators import metrics as MT
from driftwood.operators import normalize as N
from driftwood.plans import q_messages as QM
from driftwood.plans import q_monitoring as QMON
from driftwood.plans import q_normalize as QN
from driftwood.plans import q_timestamps as QT
from driftwood.plans.q_quality import quality_messages
from driftwood.plans.registry import ORACLE, register
from driftwood.plans.views import SQL_CDR, cdr, utc
from driftwood.session import scratch_path
from driftwood.sources.files import split_corrupt
from driftwood.sources.payloads import read_landing
from driftwood.streaming.pipeline import rejected

_STAMP = "yyyy-MM-dd HH:mm:ss"


@register("csv_roundtrip", f"WITH {SQL_CDR}" + """
SELECT strftime(start_dt, '%Y-%m-%d %H:%M:%S') AS starttime, strftime(end_dt, '%Y-%m-%d %H:%M:%S') AS endtime,
       msisdn, ulvolume, dlvolume, domain FROM cdr""")
def csv_roundtrip(spark, sf_dir):
    """SNK-1 then SRC-1: call records as CSV with a header."""
    path = scratch_path(spark, "csv")
    c = cdr(spark, sf_dir)
    sinks.write_result_csv(c.select(
        F.date_format("start_dt", _STAMP).alias("starttime"), F.date_format("end_dt", _STAMP).alias("endtime"),
        "msisdn", "ulvolume", "dlvolume", "domain"), path)
    good, _ = split_corrupt(sources.read_cdr_csv(spark, path))
    return good


@register("csv_corrupt_rows", """
SELECT CAST(event_id AS VARCHAR) || ',not,enough' AS line FROM events WHERE event_id % 9 = 0""")
def csv_corrupt_rows(spark, sf_dir):
    """SRC-1: malformed lines are set aside whole."""
    path = scratch_path(spark, "csv-bad")
    utc(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = F.when(F.col("event_id") % 9 == 0, F.concat(F.col("event_id").cast("string"), F.lit(",not,enough"))
                  ).otherwise(F.concat_ws(",", F.lit("a"), F.lit("b"), "user_id", F.lit(1), F.lit(2), "event_type"))
    (ev.select(line.alias("starttime,endtime,msisdn,ulvolume,dlvolume,domain"))
     .write.option("header", True).option("sep", "\t").csv(path))
    _, bad = split_corrupt(sources.read_cdr_csv(spark, path))
    return bad.select(F.col("_corrupt_record").alias("line"))


@register("pairs_from_text", QT._SQL_CASES + """
, n AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY case_id) - 1 AS k FROM cases)
SELECT file, CAST(k AS INTEGER) AS case_id, t1, t2, NULL::VARCHAR AS error FROM n
UNION ALL
SELECT file, CAST(count(*) AS INTEGER), NULL, NULL, 'missing cases' FROM n WHERE file % 7 = 0 GROUP BY file
UNION ALL
SELECT DISTINCT -file, NULL::INTEGER, NULL, NULL, 'invalid case count' FROM n WHERE file % 5 = 0""")
def pairs_from_text(spark, sf_dir):
    """SRC-2: request texts; every 7th promises two billion cases, and every
    5th comes a second time (under its negative name) without a count."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("case_id", "t1", "t2"))),
                                    lambda c: F.concat(c["t1"], F.lit("\n"), c["t2"])), "\n")
    texts = QT._cases(spark, sf_dir).groupBy("file").agg(body.alias("body"), F.count(F.lit(1)).alias("n"))
    count = F.when(F.col("file") % 7 == 0, F.lit("2000000000")).otherwise(F.col("n").cast("string"))
    rows = texts.select("file", F.concat(count, F.lit("\n"), "body").alias("value"))
    return sources.read_pairs_text(rows.unionByName(
        texts.where("file % 5 = 0").select((-F.col("file")).alias("file"), F.lit("many\nx").alias("value"))))


@register("json_messages_read", ORACLE["quality_errors_by_rule"])
def json_messages_read(spark, sf_dir):
    """SRC-5: messages as JSON lines, read back and validated."""
    from driftwood.operators import quality as Q
    from driftwood.plans.q_quality import AS_OF
    path = scratch_path(spark, "json")
    quality_messages(spark, sf_dir).select(F.col("json").alias("value")).write.text(path)
    return Q.errors_by_rule(Q.validate(sources.read_json_messages(spark, path), as_of=F.lit(AS_OF)))


@register("landing_read", QN.SQL_PROTOCOLS + f"""
SELECT device_id, protocol, timestamp_us, data, metadata FROM ({QN.SQL_MESSAGES})""")
def landing_read(spark, sf_dir):
    """SRC-6: captured payloads of all protocols from a landing table, normalised."""
    path = scratch_path(spark, "landing")
    QN.landing(spark, sf_dir).drop("source_id").write.parquet(path)
    # Repeated values of a poll keep the last arrival: here, by capture time.
    rows = read_landing(spark, path).withColumn("source_id", F.unix_micros("received_at"))
    return QN.shown(N.normalize_all(rows, resources=QN.RESOURCES)).drop("source_id")


SINCE = dt.datetime(2024, 1, 10, 6, tzinfo=dt.timezone.utc)


@register("metrics_read", QMON._SQL_POINTS + """
SELECT name, seq, epoch_us(ts) AS ts_us, value FROM p
WHERE name IN ('errors.per_minute', 'kafka.consumer.lag') AND ts >= TIMESTAMP '2024-01-10 06:00:00'""")
def metrics_read(spark, sf_dir):
    """SNK-10 then SRC-7: the date-partitioned metric table by name and time."""
    path = scratch_path(spark, "metrics")
    MT.append_metrics(QMON.points(spark, sf_dir), path)
    got = sources.read_metrics(spark, path, names=["errors.per_minute", "kafka.consumer.lag"], since=SINCE)
    return got.select("name", "seq", F.unix_micros("ts").alias("ts_us"), "value")


@register("quarantine_read", QM._SQL_MSG + """
SELECT CASE WHEN dev IS NULL THEN 'missing_device_id' ELSE 'missing_timestamp' END AS reason, count(*) AS n
FROM msg WHERE dev IS NULL OR NOT has_ts GROUP BY 1""")
def quarantine_read(spark, sf_dir):
    """SNK-9: rejected messages partitioned by reason; a replay changes nothing."""
    path = scratch_path(spark, "quarantine")
    bad = rejected(M.parse_envelope(QM.kafka_rows(spark, sf_dir)))
    for _ in range(2):
        sinks.write_quarantine(bad, path, batch_id=0)
    return spark.read.parquet(path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("route_published", QM._SQL_MSG + """,
routed AS (SELECT *, CASE WHEN dev IS NOT NULL AND has_ts THEN topic ELSE 'iot-invalid' END AS target FROM msg)
SELECT target AS topic, dev AS key, event_id,
       CASE WHEN has_ts THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,
       CASE WHEN has_data THEN temp_text END AS temperature,
       count(*) OVER (PARTITION BY target) AS sent
FROM routed""")
def route_published(spark, sf_dir):
    """FLT-3, SNK-7/8: valid messages published to their own topics, the others
    to ``iot-invalid`` (file stand-in), beside the sent counts."""
    path = scratch_path(spark, "topics")
    parsed = M.parse_envelope(QM.kafka_rows(spark, sf_dir))
    routed = M.route_valid(parsed.withColumns({"device_id": F.col("message.device_id"),
                                               "event_time": F.col("message.timestamp")}))
    rows = routed.select(F.col("device_id").alias("key"), F.to_json("message").alias("value"),
                         F.when(F.col("route") == "valid", F.col("topic")).otherwise("iot-invalid").alias("topic"))
    names = sorted({*QM.TOPIC_OF.values(), "unknown", "iot-invalid"})
    sent = sinks.publish_rows(rows, sinks.SinkConfig(kind="files", path=path), 0, tuple(names))
    counts = spark.createDataFrame([(t, sent[t]) for t in names], "topic string, sent long")
    value = F.from_json("value", "timestamp string, data map<string,string>, metadata map<string,string>")
    back = spark.read.schema("key string, value string, topic string").json(path).withColumn("m", value)
    # Few topics hold most rows, so these stay where they are read.
    return back.join(F.broadcast(counts), "topic").select(
        "topic", "key", F.col("m.metadata")["event_id"].cast("long").alias("event_id"), "m.timestamp",
        F.col("m.data")["temperature"].alias("temperature"), "sent")
