"""Rule-based anomalies (ANO-1..5, FLT-6).

Two forms (D2): the windowed form reads the window aggregates (maximum and
minimum temperature, mean humidity, maximum vibration, message count); the
row form reads raw readings and has no frequency rule. Empty rule slots are
removed before exploding (D3), so only rows with an anomaly survive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    condition: Column
    value: Column
    description: str


def windowed_rules() -> list[Rule]:
    # Thresholds and texts of the four rules.
    hot = F.col("max_temperature") > 80
    return [
        Rule("TEMPERATURE_EXTREME", hot | (F.col("min_temperature") < -10),
             F.when(hot, F.col("max_temperature")).otherwise(F.col("min_temperature")),
             "Temperature outside normal range"),
        Rule("HUMIDITY_EXTREME",
             (F.round("avg_humidity", 9) > 95) | (F.round("avg_humidity", 9) < 5),
             F.col("avg_humidity"), "Humidity outside normal range"),
        Rule("HIGH_VIBRATION", F.col("max_vibration") > 100, F.col("max_vibration"),
             "Excessive vibration detected"),
        Rule("LOW_FREQUENCY", F.col("message_count") < 5,
             F.col("message_count").cast("double"), "Low message frequency detected"),
    ]


def row_rules() -> list[Rule]:
    return [
        Rule("TEMPERATURE_EXTREME", (F.col("temperature") > 80) | (F.col("temperature") < -10),
             F.col("temperature"), "Temperature outside normal range"),
        Rule("HUMIDITY_EXTREME", (F.col("humidity") > 95) | (F.col("humidity") < 5),
             F.col("humidity"), "Humidity outside normal range"),
        Rule("HIGH_VIBRATION", F.col("vibration") > 100, F.col("vibration"),
             "Excessive vibration detected"),
    ]


def detect_anomalies(df: DataFrame, rules: list[Rule] | None = None,
                     keep: tuple[str, ...] = ("device_id", "protocol", "window_start",
                                              "window_end", "window_duration"),
                     detected_at: Column | None = None) -> DataFrame:
    """One output row per (input row, rule that fires)."""
    rules = windowed_rules() if rules is None else rules
    slots = F.array(*[
        F.when(r.condition, F.struct(F.lit(r.kind).alias("type"),
                                     r.value.cast("double").alias("value"),
                                     F.lit(r.description).alias("description")))
        for r in rules])
    found = df.select(*keep, F.array_compact(slots).alias("_a")).where(F.size("_a") > 0)
    out = found.select(*keep, F.explode("_a").alias("_x")).select(
        *keep,
        F.col("_x.type").alias("anomaly_type"),
        F.col("_x.value").alias("anomaly_value"),
        F.col("_x.description").alias("anomaly_description"))
    if detected_at is not None:
        out = out.withColumn("detected_at", detected_at)
    return out
