"""Threshold rules, alert log state and system health.

Operators: ALR-3..6, JOI-1, JOI-4, FLT-10..12, AGG-13, WIN-5, SRT-3.

Alerts live in an append-only log of ``create`` and ``resolve`` actions. The
state of an alert id is its latest ``create`` (a create with an id already
seen replaces it, as the original dictionary does) and it is resolved when a
``resolve`` for that id comes after that create. A resolve for an unknown id
changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.metrics import metric_summary


@dataclass(frozen=True)
class MonitoringRule:
    name: str
    metric: str
    threshold: float
    operator: str
    severity: str
    message: str


# The five monitoring rules.
DEFAULT_RULES = (
    MonitoringRule("kafka_lag", "kafka.consumer.lag", 1000, ">", "WARNING",
                   "Kafka consumer lag is high"),
    MonitoringRule("message_rate_low", "messages.per_second", 10, "<", "WARNING",
                   "Message ingestion rate is low"),
    MonitoringRule("error_rate_high", "errors.per_minute", 5, ">", "ERROR",
                   "Error rate is too high"),
    MonitoringRule("memory_usage_high", "system.memory.usage_percent", 85, ">", "WARNING",
                   "Memory usage is high"),
    MonitoringRule("disk_space_low", "system.disk.usage_percent", 90, ">", "CRITICAL",
                   "Disk space is critically low"),
)
RULE_WINDOW_MINUTES = 5
SEVERITIES = ("INFO", "WARNING", "ERROR", "CRITICAL")
LAST_ALERTS = 10

RULE_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("threshold_text", T.StringType()),
    T.StructField("operator", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
])


def rules_frame(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    """The rule set as a small frame (its size is the number of rules)."""
    rows = [(r.name, r.metric, float(r.threshold),
             str(int(r.threshold)) if float(r.threshold).is_integer() else repr(r.threshold),
             r.operator, r.severity, r.message) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def breached(value: Column, operator: Column, threshold: Column) -> Column:
    """FLT-12: the comparison named by the rule row."""
    return (F.when(operator == ">", value > threshold)
             .when(operator == "<", value < threshold)
             .when(operator == ">=", value >= threshold)
             .when(operator == "<=", value <= threshold)
             .when(operator == "==", value == threshold)
             .otherwise(F.lit(False)))


def value_text(c: Column) -> Column:
    """Python's text of a float value (``87.5``, ``1500.0``)."""
    return c.cast("string")


def evaluate_rules(points: DataFrame, rules: DataFrame, as_of: Column,
                   minutes: int = RULE_WINDOW_MINUTES) -> DataFrame:
    """ALR-3/4: summaries of the last ``minutes`` joined with the rules
    (rules without data are skipped), compared on the latest value; each
    breach is an alert row. No broadcast hint: a rule table built from the
    configuration is a local relation of a few rows, which the planner's
    size check (``spark.sql.autoBroadcastJoinThreshold``) broadcasts, while a
    large rule table passed in gets a shuffle join instead."""
    summary = metric_summary(points, as_of, minutes).withColumnRenamed("name", "metric")
    j = summary.join(rules, "metric", "inner")
    hit = j.where(breached(F.col("latest"), F.col("operator"), F.col("threshold")))
    component = F.concat(F.lit("monitor."), F.col("rule"))
    details = F.to_json(F.struct(
        F.col("metric"), F.col("latest").alias("current_value"), F.col("threshold"),
        F.col("operator"), F.struct("count", "min", "max", "avg", "latest").alias("summary")))
    return hit.select(
        F.concat(component, F.lit("_"), F.unix_seconds(as_of).cast("string")).alias("id"),
        as_of.alias("ts"),
        F.col("severity"),
        component.alias("component"),
        F.concat(F.col("message"), F.lit(" (current: "), value_text(F.col("latest")),
                 F.lit(", threshold: "), F.col("threshold_text"), F.lit(")")).alias("message"),
        details.alias("details"),
        F.col("metric"), F.col("latest").alias("current_value"), F.col("threshold"))


def alert_state(log: DataFrame) -> DataFrame:
    """WIN-5 / JOI-4 / ALR-5: one row per alert id with its latest create
    and whether a later resolve exists. ``log`` has (id, action, ts, seq,
    severity, component, message).

    One aggregate on ``id`` (one read of the log, no join): the latest
    create by ``max_by`` over create rows only, the latest resolve by a
    conditional ``max``; ids that were never created drop out."""
    key = F.struct("ts", "seq")
    is_create = F.col("action") == "create"
    g = log.groupBy("id").agg(
        F.max_by(F.struct("ts", "seq", "severity", "component", "message"),
                 F.when(is_create, key)).alias("c"),
        F.max(F.when(F.col("action") == "resolve", key)).alias("r"),
        F.count_if(is_create).alias("_creates"))
    j = g.where(F.col("_creates") > 0)
    is_resolved = F.coalesce(
        (F.col("r.ts") > F.col("c.ts")) | ((F.col("r.ts") == F.col("c.ts")) & (F.col("r.seq") > F.col("c.seq"))),
        F.lit(False))
    return j.select("id", F.col("c.ts").alias("created_at"), F.col("c.seq").alias("seq"),
                    F.col("c.severity").alias("severity"), F.col("c.component").alias("component"),
                    F.col("c.message").alias("message"), is_resolved.alias("resolved"),
                    F.when(is_resolved, F.col("r.ts")).alias("resolved_at"))


def active_alerts(state: DataFrame) -> DataFrame:
    """FLT-10: alerts not resolved."""
    return state.where(~F.col("resolved"))


def by_severity(state: DataFrame, severity: str) -> DataFrame:
    """FLT-11."""
    return state.where(F.col("severity") == severity)


def last_alerts(active: DataFrame, n: int = LAST_ALERTS) -> DataFrame:
    """SRT-3: the ``n`` most recently created active alerts (a top-k: each
    task keeps ``n`` rows, only those meet at the end)."""
    return active.orderBy(F.col("created_at").desc(), F.col("seq").desc()).limit(n)


def system_health(active: DataFrame) -> DataFrame:
    """AGG-13: CRITICAL if any critical alert, else WARNING if any warning,
    else DEGRADED if any alert, else HEALTHY."""
    a = active.agg(F.count(F.lit(1)).alias("total_alerts"),
                   F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"),
                   F.count_if(F.col("severity") == "WARNING").alias("warning_alerts"))
    status = (F.when(F.col("critical_alerts") > 0, F.lit("CRITICAL"))
               .when(F.col("warning_alerts") > 0, F.lit("WARNING"))
               .when(F.col("total_alerts") > 0, F.lit("DEGRADED"))
               .otherwise(F.lit("HEALTHY")))
    return a.select(status.alias("status"), "total_alerts", "critical_alerts", "warning_alerts")


def dashboard(points: DataFrame, state: DataFrame, as_of: Column, key_metrics,
              panel_minutes: int = 15) -> DataFrame:
    """ALR-6: the dashboard as one JSON row per section (``system_health``,
    ``performance_metrics``, ``active_alerts``), each of bounded size: the
    health counts, at most ``len(key_metrics)`` summaries, the last 10
    alerts. Sections are unioned, not joined."""
    active = active_alerts(state)
    health = system_health(active).select(
        F.lit("system_health").alias("section"),
        F.to_json(F.struct("status", "total_alerts", "critical_alerts", "warning_alerts"))
         .alias("json"))
    panel = metric_summary(points, as_of, panel_minutes, names=list(key_metrics)).withColumn(
        "avg", F.round(F.round("avg", 9), 6)).agg(  # no summation noise in the text
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(
            "name", F.struct("count", "min", "max", "avg", "latest")))))).alias("json")
    ).select(F.lit("performance_metrics").alias("section"), "json")
    alerts = last_alerts(active).agg(
        F.to_json(F.transform(
            F.reverse(F.array_sort(F.collect_list(F.struct("created_at", "seq", "id", "severity", "component",
                                                           "message")))),
            lambda a: F.struct(a["id"].alias("id"), a["created_at"].alias("created_at"),
                               a["severity"].alias("severity"), a["component"].alias("component"),
                               a["message"].alias("message")))).alias("json")
    ).select(F.lit("active_alerts").alias("section"), "json")
    return (health.unionByName(panel).unionByName(alerts)
                  .withColumn("timestamp", as_of))
