"""Device health scores (HLT-1/2): four weighted ladders, summed; a status
ladder on the total. Nulls fall to each ladder's last step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (lower, upper, score) bands tried in order, the fallback, and
# the weight of each ladder.
TEMPERATURE_BANDS = [(20, 25, 100), (15, 30, 80), (10, 35, 60), (5, 40, 40)]
TEMPERATURE_ELSE, TEMPERATURE_WEIGHT = 20, 0.3
HUMIDITY_BANDS = [(40, 60, 100), (30, 70, 80), (20, 80, 60)]
HUMIDITY_ELSE, HUMIDITY_WEIGHT = 40, 0.2
VIBRATION_AT_MOST = [(10, 100), (25, 80), (50, 60), (75, 40)]
VIBRATION_ELSE, VIBRATION_WEIGHT = 20, 0.3
COUNT_AT_LEAST = [(100, 100), (50, 80), (25, 60), (10, 40)]
COUNT_ELSE, COUNT_WEIGHT = 20, 0.2
STATUS_AT_LEAST = [(90, "EXCELLENT"), (80, "GOOD"), (70, "FAIR"), (60, "POOR")]
STATUS_ELSE = "CRITICAL"


def _bands(c: Column, bands, fallback) -> Column:
    expr = None
    for lo, hi, score in bands:
        cond = (c >= lo) & (c <= hi)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(fallback))


def _steps(c: Column, steps, fallback, at_most: bool) -> Column:
    expr = None
    for edge, score in steps:
        cond = (c <= edge) if at_most else (c >= edge)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(fallback))


def stable_mean(c: Column) -> Column:
    """A mean rounded to 9 decimals before it meets a band edge, so the
    summation order of a distributed average cannot move it across."""
    return F.round(c, 9)


def health_score(avg_temperature="avg_temperature", avg_humidity="avg_humidity",
                 max_vibration="max_vibration", message_count="message_count") -> Column:
    t = _bands(stable_mean(F.col(avg_temperature)), TEMPERATURE_BANDS, TEMPERATURE_ELSE)
    h = _bands(stable_mean(F.col(avg_humidity)), HUMIDITY_BANDS, HUMIDITY_ELSE)
    v = _steps(F.col(max_vibration), VIBRATION_AT_MOST, VIBRATION_ELSE, at_most=True)
    n = _steps(F.col(message_count), COUNT_AT_LEAST, COUNT_ELSE, at_most=False)
    return (t * F.lit(TEMPERATURE_WEIGHT) + h * F.lit(HUMIDITY_WEIGHT)
            + v * F.lit(VIBRATION_WEIGHT) + n * F.lit(COUNT_WEIGHT))


def health_status(score: Column) -> Column:
    expr = None
    for edge, name in STATUS_AT_LEAST:
        expr = F.when(score >= edge, F.lit(name)) if expr is None else expr.when(
            score >= edge, F.lit(name))
    return expr.otherwise(F.lit(STATUS_ELSE))


def health_scores(df: DataFrame) -> DataFrame:
    """Adds ``health_score`` (24..100) and ``health_status``."""
    return (df.withColumn("health_score", health_score())
              .withColumn("health_status", health_status(F.col("health_score"))))
