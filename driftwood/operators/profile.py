"""Data-set profiling (PRO-1, AGG-5..8, AGG-10, WIN-3, SRT-4).

Input: a column of VARIANT messages (see :func:`parse_messages`). Each
section is an aggregate over one pass; nothing is collected to the driver.
The interval section uses the closed form of the mean gap between sorted
timestamps, (max - min) / (n - 1), so no global sort is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.operators.quality import ISO_8601

SAMPLE_CAP = 100          # fixed value: length of a field's list of sample values


def parse_messages(df: DataFrame, json_col: str = "json", out: str = "msg") -> DataFrame:
    """JSON text -> VARIANT (null when the text is not JSON)."""
    return df.withColumn(out, F.try_parse_json(F.col(json_col)))


def _get(msg: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(msg, "$['" + name + "']", kind)


def _ts(msg: Column, field: str) -> Column:
    text = _get(msg, field, "string")
    return F.when(text.rlike(ISO_8601), F.try_to_timestamp(text))


def profile_total(df: DataFrame) -> DataFrame:
    """AGG-5."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def profile_timestamps(df: DataFrame, msg: str = "msg", field: str = "timestamp") -> DataFrame:
    """AGG-6: earliest, latest, span in hours, mean interval in seconds and
    the number of parsed timestamps (unparsable ones are skipped)."""
    t = _ts(F.col(msg), field)
    a = df.select(t.alias("_t")).agg(F.min("_t").alias("earliest"), F.max("_t").alias("latest"),
                                     F.count("_t").alias("total_timestamps"))
    span_us = F.unix_micros("latest") - F.unix_micros("earliest")
    return a.select(
        "earliest", "latest",
        (span_us / F.lit(3_600_000_000.0)).alias("span_hours"),
        F.when(F.col("total_timestamps") > 1,
               span_us / F.lit(1_000_000.0) / (F.col("total_timestamps") - 1))
         .otherwise(F.lit(0.0)).alias("average_interval_seconds"),
        "total_timestamps")


def _key_or_unknown(msg: Column, field: str) -> Column:
    """Absent -> 'unknown'; a present null stays null (kept apart: D6)."""
    v = _get(msg, field)
    return F.when(v.isNull(), F.lit("unknown")).otherwise(_get(msg, field, "string"))


def profile_devices(df: DataFrame, msg: str = "msg") -> DataFrame:
    """AGG-7: per device message count, protocols seen, first/last seen.
    A device's protocol set is bounded by the number of protocols."""
    m = F.col(msg)
    return (df.select(_key_or_unknown(m, "device_id").alias("device_id"),
                      _get(m, "protocol", "string").alias("_p"),
                      _ts(m, "timestamp").alias("_t"))
              .groupBy("device_id")
              .agg(F.count(F.lit(1)).alias("message_count"),
                   F.sort_array(F.collect_set("_p")).alias("protocols"),
                   F.min("_t").alias("first_seen"), F.max("_t").alias("last_seen")))


def profile_protocols(df: DataFrame, msg: str = "msg") -> DataFrame:
    """AGG-8: messages per protocol (absent -> 'unknown')."""
    return (df.select(_key_or_unknown(F.col(msg), "protocol").alias("protocol"))
              .groupBy("protocol").agg(F.count(F.lit(1)).alias("messages")))


def value_type(kind: Column, text: Column) -> Column:
    """Type names of the original profile. A number is an int unless its
    source text has a point or an exponent, whatever its size."""
    return (F.when(kind == "STRING", F.lit("str"))
             .when(kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"),
                   F.when(text.rlike("[.eE]"), F.lit("float")).otherwise(F.lit("int")))
             .when(kind == "BOOLEAN", F.lit("bool"))
             .when(kind.startswith("OBJECT"), F.lit("dict"))
             .when(kind.startswith("ARRAY"), F.lit("list"))
             .otherwise(F.lower(kind)))


def field_values(df: DataFrame, msg: str = "msg", json_col: str = "json") -> DataFrame:
    """One row per (message, top-level key): field, is_null, type, text.

    The types come from the VARIANT, the texts from the JSON itself, so that
    ``25.0`` and ``25`` stay two values. Both are plain generators (no
    shuffle); non-object messages contribute no fields.
    """
    text = F.from_json(F.col(json_col), "map<string,string>")
    kv = (df.select(F.try_variant_get(F.col(msg), "$", "map<string,variant>").alias("_m"), text.alias("_t"))
          .select(F.explode("_m").alias("field", "_v"), "_t"))
    kv = kv.select("field", "_v", F.try_element_at("_t", F.col("field")).alias("_text"))
    return kv.select(
        "field",
        F.is_variant_null("_v").alias("is_null"),
        value_type(F.schema_of_variant("_v"), F.col("_text")).alias("type"),
        F.when(~F.is_variant_null("_v"), F.col("_text")).alias("text"))


def profile_fields(df: DataFrame, msg: str = "msg", samples: int = SAMPLE_CAP,
                   salt: int = 16, json_col: str = "json") -> DataFrame:
    """AGG-10 + SRT-4: per field: present count (nulls included), null
    count, completeness, type histogram, exact number of distinct values,
    uniqueness (distinct values over the count) and the ``samples`` smallest
    distinct values, which is the length of that list only.

    Counts and types are one aggregate per field and type. The distinct
    values are spread over the tasks by (field, text); each keeps the
    smallest of its (field, salt) before the field's are compared, so a field
    with billions of distinct values is never sorted or counted in one task.
    """
    kv = field_values(df, msg, json_col)
    per_type = kv.groupBy("field", "type", "is_null").agg(F.count(F.lit(1)).alias("n"))
    stats = per_type.groupBy("field").agg(
        F.sum("n").alias("count"),
        F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(F.lit(0))).alias("null_count"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(~F.col("is_null"), F.struct("type", "n")))),
            lambda e: F.concat(e["type"], F.lit("="), e["n"].cast("string"))), ",").alias("type_distribution"))
    distinct = (kv.where(~F.col("is_null")).select("field", "text").distinct()
                .withColumn("_s", F.pmod(F.xxhash64("text"), F.lit(salt))))
    bucket = Window.partitionBy("field", "_s").orderBy("text")
    whole = Window.partitionBy("field").orderBy("text")
    # Per (field, salt) the count and the smallest values, then per field.
    counted = distinct.groupBy("field", "_s").agg(F.count(F.lit(1)).alias("n")).groupBy("field").agg(
        F.sum("n").alias("distinct_values"))
    sample = (distinct.withColumn("_r", F.row_number().over(bucket)).where(F.col("_r") <= samples)
                      .withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= samples)
                      .groupBy("field")
                      .agg(F.array_join(F.array_sort(F.collect_list("text")), "|")
                           .alias("sample_values")))
    out = stats.join(counted, "field", "left").join(sample, "field", "left")
    n = F.coalesce("distinct_values", F.lit(0))
    return out.select(
        "field", "count", "null_count",
        ((F.col("count") - F.col("null_count")) / F.col("count")).alias("completeness"),
        F.coalesce(F.col("type_distribution"), F.lit("")).alias("type_distribution"),
        n.alias("distinct_values"),
        (n / F.col("count")).alias("uniqueness"),
        F.coalesce(F.col("sample_values"), F.lit("")).alias("sample_values"))


def device_gaps(df: DataFrame, msg: str = "msg", device: str = "device_id", field: str = "timestamp",
                hours: int = 1) -> DataFrame:
    """WIN-3 per device: number of gaps between consecutive timestamps, and
    the smallest, largest and mean gap in seconds.

    A device may hold a third of all rows, so timestamps are ordered within
    (device, ``hours``-hour bucket); only each bucket's first and last
    timestamp meet per device, to add the gaps between buckets.
    """
    rows = df.select(_key_or_unknown(F.col(msg), device).alias("device_id"),
                     F.unix_micros(_ts(F.col(msg), field)).alias("us")).where("us is not null")
    rows = rows.withColumn("bucket", F.floor(F.col("us") / (hours * 3_600_000_000)))
    inside = Window.partitionBy("device_id", "bucket").orderBy("us")
    gap = (rows.withColumn("gap", F.col("us") - F.lag("us").over(inside))
           .groupBy("device_id", "bucket").agg(
               F.min("us").alias("first"), F.max("us").alias("last"), F.count("gap").alias("n"),
               F.min("gap").alias("least"), F.max("gap").alias("most")))
    between = F.col("first") - F.lag("last").over(Window.partitionBy("device_id").orderBy("bucket"))
    edge = gap.withColumn("edge", between)
    total = F.max("last") - F.min("first")
    count = F.sum("n") + F.count("edge")
    return edge.groupBy("device_id").agg(
        count.alias("gaps"),
        (F.least(F.min("least"), F.min("edge")) / 1e6).alias("min_gap_seconds"),
        (F.greatest(F.max("most"), F.max("edge")) / 1e6).alias("max_gap_seconds"),
        F.when(count > 0, total / 1e6 / count).alias("mean_gap_seconds"))


def profile(df: DataFrame, msg: str = "msg", json_col: str = "json") -> DataFrame:
    """PRO-1: the whole profile as rows ``(section, json)``: ``total``,
    ``timestamps``, ``devices``, ``protocols``, ``fields`` and ``device_gaps``;
    one row per device, protocol and field, so no section is gathered."""
    sections = {
        "total": profile_total(df), "timestamps": profile_timestamps(df, msg),
        "devices": profile_devices(df, msg), "protocols": profile_protocols(df, msg),
        "fields": profile_fields(df, msg, json_col=json_col), "device_gaps": device_gaps(df, msg)}
    parts = [s.select(F.lit(name).alias("section"), F.to_json(F.struct(*s.columns)).alias("json"))
             for name, s in sections.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
