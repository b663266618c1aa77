"""Call-detail-record analysis: idle trim, sessionisation, bitrate classes.

Operators: PRJ-7..11, WIN-1/2, AGG-2/3/4, FLT-4/5.

Sessionisation semantics: within one key (msisdn, domain) ordered by start,
a record opens a new call when its start is more than ``gap`` after the end
of the *immediately preceding* record (``gap_from="previous"``) or after the
largest end seen so far (``gap_from="running_max"``, the rule that Spark's
``session_window`` follows).

Scale: a single msisdn may carry a large share of all records, so the window
is never partitioned by the key alone. Records are split by (key, time
bucket of start, 10 minutes by default); each bucket is ordered locally and only a tiny per-bucket
summary (last end, largest end, number of call breaks) crosses bucket
boundaries. The summary has one row per (key, bucket); joining it back is
broadcast by adaptive execution when it is small and shuffle-joined on the
bucket-aligned partitioning otherwise.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions.timestamps import repair_glued_datetime
from driftwood.session import ensure_checkpoint_dir

# Fixed values of the call analysis.
CALL_GAP = "5 minutes"          # a larger gap starts a new call
IDLE_TRIM = "10 minutes"        # idle tail removed from each record
MIN_BITRATE = 10.0              # calls below this rate are dropped
VIDEO_ABOVE = 200.0             # audio <= 200 < video

_UNIT_US = {
    "microsecond": 1, "millisecond": 1000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """``"5 minutes"`` -> 300000000."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNIT_US:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


def parse_record_times(df: DataFrame, start_text: str = "starttime",
                       end_text: str = "endtime") -> DataFrame:
    """PRJ-7/8: repair glued datetimes and parse them (null if unparsable)."""
    return (df
            .withColumn("start_dt", F.try_to_timestamp(repair_glued_datetime(start_text)))
            .withColumn("end_dt", F.try_to_timestamp(repair_glued_datetime(end_text))))


def idle_trim(df: DataFrame, start: str = "start_dt", end: str = "end_dt",
              idle: str = IDLE_TRIM) -> DataFrame:
    """PRJ-9/10: raw duration, and the end moved back by the idle time unless
    that would precede the start."""
    idle_us = interval_micros(idle)
    s_us, e_us = F.unix_micros(start), F.unix_micros(end)
    adj_us = F.when(e_us - idle_us < s_us, e_us).otherwise(e_us - idle_us)
    return (df
            .withColumn("duration_sec", (e_us - s_us) / F.lit(1_000_000.0))
            .withColumn("adjusted_end_dt", F.timestamp_micros(adj_us))
            .withColumn("adjusted_duration_sec", (adj_us - s_us) / F.lit(1_000_000.0)))


def _flagged(df: DataFrame, keys: tuple[str, ...], start: str, end: str, gap_us: int,
             bucket_us: int, gap_from: str, order_cols: list[str]) -> DataFrame:
    """The ordered pass shared by :func:`sessionize` and :func:`call_sessions`:
    records split by (key, bucket of start), each bucket ordered locally;
    ``_flag`` marks a record that breaks from its predecessor in the bucket
    and ``_local_no`` counts the breaks so far. For the running-max rule the
    largest end of all earlier buckets is carried in (a partial aggregate of
    the records, then a window over that small per-bucket table), so every
    flag is final; for the previous-record rule only a bucket's first record
    may still break from the previous bucket, which the caller settles."""
    if gap_from not in ("previous", "running_max"):
        raise ValueError("gap_from must be 'previous' or 'running_max'")
    kb = [*keys, "_b"]
    placeable = reduce(lambda a, b: a & b,
                       [F.col(c).isNotNull() for c in (*keys, start, end)])
    d = (df.where(placeable)
           .withColumn("_s_us", F.unix_micros(start))
           .withColumn("_e_us", F.unix_micros(end))
           .withColumn("_b", F.floor(F.col("_s_us") / F.lit(bucket_us)).cast("long")))
    local = Window.partitionBy(*kb).orderBy(*order_cols)
    if gap_from == "previous":
        prev = F.lag("_e_us").over(local)
    else:
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1)
        carry = (d.groupBy(*kb).agg(F.max("_e_us").alias("_max_e"))
                  .withColumn("_carry", F.max("_max_e").over(before))
                  .select(*kb, "_carry"))
        d = d.join(carry, kb, "left")
        prev = F.greatest(F.max("_e_us").over(
            local.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    d = d.withColumn("_flag", F.when(F.col("_s_us") - prev > F.lit(gap_us),
                                     F.lit(1)).otherwise(F.lit(0)))
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("_local_no", F.sum("_flag").over(running))


def sessionize(df: DataFrame, keys: tuple[str, ...] = ("msisdn", "domain"),
               start: str = "start_dt", end: str = "end_dt",
               gap: str = CALL_GAP, gap_from: str = "previous",
               order: tuple[str, ...] = ("end_dt", "ulvolume", "dlvolume"),
               bucket: str = "10 minutes", out: str = "call_no") -> DataFrame:
    """WIN-1/2: number the calls of each key (0, 1, 2, ... in start order),
    on every record.

    Rows with a null key, start or end cannot be placed and are left out
    (they fall out of grouping in the reference too). ``order`` breaks ties
    on equal starts.

    Plan: one ordered pass per (key, bucket) gives each record its local
    break count; a per-bucket summary (first start, last end, break count)
    is windowed across the buckets of a key to give each bucket its call
    offset, and joined back on (key, bucket). The summary and the numbered
    records both read the ordered pass, so Spark runs it twice. When only
    the calls are needed, :func:`call_sessions` runs it once.
    """
    gap_us = interval_micros(gap)
    keys = tuple(keys)
    order_cols = [start, *[c for c in order if c != start]]
    kb = [*keys, "_b"]
    d = _flagged(df, keys, start, end, gap_us, interval_micros(bucket), gap_from, order_cols)
    summary = _offsets(d.groupBy(*kb).agg(
        F.min("_s_us").alias("_first_s"),
        F.max_by("_e_us", F.struct(*order_cols)).alias("_last_e"),
        F.sum("_flag").alias("_n")), keys, gap_us, gap_from)
    d = d.join(summary, kb, "left")
    d = d.withColumn(out, (F.col("_offset") + F.col("_local_no")).cast("long"))
    return d.drop("_s_us", "_e_us", "_b", "_carry", "_flag", "_local_no", "_offset")


def _offsets(buckets: DataFrame, keys: tuple[str, ...], gap_us: int,
             gap_from: str) -> DataFrame:
    """Per (key, bucket): the number of calls that start before the bucket's
    local call 0, from one row per bucket with ``_n`` (breaks inside the
    bucket) and, for the previous-record rule, ``_first_s``/``_last_e`` and
    optionally ``_base``
    (added from this bucket on; null for 0). The window is over
    buckets only, so a hot key costs one row per bucket."""
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    if gap_from == "running_max":
        off = F.coalesce(F.sum("_n").over(before), F.lit(0))
        return buckets.select(*keys, "_b", off.alias("_offset"))
    first_flag = F.when(F.col("_first_s") - F.lag("_last_e").over(by_bucket) > F.lit(gap_us),
                        F.lit(1)).otherwise(F.lit(0))
    if "_base" in buckets.columns:
        first_flag = first_flag + F.coalesce("_base", F.lit(0))
    return (buckets.withColumn("_first_flag", first_flag)
                   .select(*keys, "_b",
                           (F.coalesce(F.sum(F.col("_n") + F.col("_first_flag")).over(before),
                                       F.lit(0)) + F.col("_first_flag")).alias("_offset")))


def partial_calls(df: DataFrame, keys: tuple[str, ...], start: str, end: str, adjusted_end: str,
                  gap: str, gap_from: str, order: tuple[str, ...], bucket: str) -> DataFrame:
    """One row per local call of a (key, bucket), from one ordered pass."""
    order_cols = [start, *[c for c in order if c != start]]
    d = _flagged(df, keys, start, end, interval_micros(gap), interval_micros(bucket), gap_from, order_cols)
    aggs = [F.sum("ulvolume").alias("ul_bytes"), F.sum("dlvolume").alias("dl_bytes"),
            F.min(start).alias("call_start"), F.max(adjusted_end).alias("call_end"),
            F.count(F.lit(1)).alias("fdr_count")]
    if gap_from == "previous":
        aggs += [F.min("_s_us").alias("_first_s"),
                 F.max_by("_e_us", F.struct(*order_cols)).alias("_last_e"),
                 F.lit(None).cast("long").alias("_base")]
    return d.groupBy(*keys, "_b", "_local_no").agg(*aggs)


def merge_partials(partials: DataFrame, keys: tuple[str, ...], gap: str, gap_from: str, out: str) -> DataFrame:
    """Calls from the partial calls of all buckets of each key; for the
    previous-record rule with ``_last_e``, the end of a call's last record.
    ``partials`` is read twice, so it should be a written table."""
    keys = tuple(keys)
    kb = [*keys, "_b"]
    bucket_aggs, last = [F.max("_local_no").alias("_n")], []
    if gap_from == "previous":
        bucket_aggs += [F.min("_first_s").alias("_first_s"), F.max("_base").alias("_base"),
                        F.max_by("_last_e", "_local_no").alias("_last_e")]
        last = [F.max_by("_last_e", "_b").alias("_last_e")]
    summary = _offsets(partials.groupBy(*kb).agg(*bucket_aggs), keys, interval_micros(gap), gap_from)
    numbered = (partials.join(summary, kb, "left")
                        .withColumn(out, (F.col("_offset") + F.col("_local_no")).cast("long")))
    return (numbered.groupBy(*keys, out)
                    .agg(F.sum("ul_bytes").alias("ul_bytes"),
                         F.sum("dl_bytes").alias("dl_bytes"),
                         F.min("call_start").alias("call_start"),
                         F.max("call_end").alias("call_end"),
                         F.sum("fdr_count").alias("fdr_count"), *last))


def call_sessions(df: DataFrame, keys: tuple[str, ...] = ("msisdn", "domain"),
                  start: str = "start_dt", end: str = "end_dt",
                  adjusted_end: str = "adjusted_end_dt", gap: str = CALL_GAP,
                  gap_from: str = "previous",
                  order: tuple[str, ...] = ("end_dt", "ulvolume", "dlvolume"),
                  bucket: str = "10 minutes", out: str = "call_no") -> DataFrame:
    """WIN-1/2 + AGG-2: the calls of :func:`sessionize` aggregated as
    :func:`call_aggregates` aggregates them, reading, shuffling and ordering
    the records once.

    The ordered pass per (key, bucket) folds the records into partial calls
    (one row per local call of a bucket) on the partitioning it already has.
    The partials are written once as a reliable checkpoint in the shared
    folder, since two branches read them: the per-bucket summary (windowed
    across the buckets of a key) and the numbering that joins it back. A
    final aggregate merges partials of calls that span buckets. A hot key
    is spread over its buckets throughout; only the one-row-per-bucket
    summary is ordered per key. Batch only: the checkpoint is an action. The
    stream form is ``driftwood.streaming.sessions``.
    """
    partials = partial_calls(df, tuple(keys), start, end, adjusted_end, gap, gap_from, order, bucket)
    ensure_checkpoint_dir(df.sparkSession)
    return merge_partials(partials.checkpoint(eager=True), keys, gap, gap_from, out).drop("_last_e")


def call_aggregates(sessions: DataFrame, keys: tuple[str, ...] = ("msisdn", "domain"),
                    call: str = "call_no", start: str = "start_dt",
                    end: str = "adjusted_end_dt") -> DataFrame:
    """AGG-2: per call volumes, first start, last (adjusted) end, record count.

    A plain hash aggregate: partial aggregation runs before the shuffle, so
    one very long call costs no more than a short one.
    """
    return (sessions.groupBy(*keys, call)
            .agg(F.sum("ulvolume").alias("ul_bytes"),
                 F.sum("dlvolume").alias("dl_bytes"),
                 F.min(start).alias("call_start"),
                 F.max(end).alias("call_end"),
                 F.count(F.lit(1)).alias("fdr_count")))


def bitrate_column(volume_kb: Column, duration_sec: Column, unit: str) -> Column:
    """AGG-3 bitrate. ``reference`` divides by hours (as the original job,
    3,600x the true rate); ``kbps`` is kilobits per second."""
    if unit == "reference":
        return (volume_kb * F.lit(8)) / (duration_sec / F.lit(3600))
    if unit == "kbps":
        return (volume_kb * F.lit(8)) / duration_sec
    raise ValueError("bitrate_unit must be 'reference' or 'kbps'")


def classify_calls(calls: DataFrame, bitrate_unit: str = "reference",
                   min_rate: float = MIN_BITRATE, video_above: float = VIDEO_ABOVE,
                   keys: tuple[str, ...] = ("msisdn", "domain")) -> DataFrame:
    """AGG-3, FLT-4/5: duration, bitrate, audio/video; drops calls with
    duration <= 0 or bitrate < ``min_rate`` (both tested unrounded)."""
    dur = (F.unix_micros("call_end") - F.unix_micros("call_start")) / F.lit(1_000_000.0)
    volume_kb = (F.col("ul_bytes") + F.col("dl_bytes")) / F.lit(1024.0)
    c = (calls.withColumn("_dur", dur)
         .where(F.col("_dur") > 0)
         .withColumn("_rate", bitrate_column(volume_kb, F.col("_dur"), bitrate_unit))
         .where(F.col("_rate") >= F.lit(min_rate)))
    return c.select(
        *keys,
        F.floor("_dur").cast("long").alias("duration_sec"),
        F.col("fdr_count"),
        F.round("_rate", 2).alias("kbps"),
        (F.col("_rate") <= F.lit(video_above)).alias("is_audio"),
        (F.col("_rate") > F.lit(video_above)).alias("is_video"),
        F.round(volume_kb, 2).alias("total_volume_kb"),
        F.col("call_start"),
        F.col("call_end"),
    )


def analyze_calls(records: DataFrame, keys: tuple[str, ...] = ("msisdn", "domain"),
                  bitrate_unit: str = "reference", order: tuple[str, ...] =
                  ("end_dt", "ulvolume", "dlvolume"), gap_from: str = "previous",
                  bucket: str = "10 minutes") -> DataFrame:
    """Parsed records (start_dt, end_dt, volumes) -> classified calls."""
    trimmed = idle_trim(records)
    sessions = sessionize(trimmed, keys=keys, order=order, gap_from=gap_from,
                          bucket=bucket)
    return classify_calls(call_aggregates(sessions, keys=keys),
                          bitrate_unit=bitrate_unit, keys=keys)


def result_columns(calls: DataFrame) -> DataFrame:
    """PRJ-11: the published result columns, in order."""
    return calls.select("msisdn", "domain", "duration_sec", "fdr_count", "kbps",
                        "is_audio", "is_video")


def summarize_calls(calls: DataFrame) -> DataFrame:
    """AGG-4: one row; counts are 0 and means null on an empty input."""
    return calls.agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if("is_audio").alias("audio_calls"),
        F.count_if("is_video").alias("video_calls"),
        F.avg("duration_sec").alias("avg_duration_sec"),
        F.avg("kbps").alias("avg_bitrate_kbps"),
        F.count_distinct("msisdn").alias("total_msisdns"),
        F.count_distinct("domain").alias("total_domains"),
    )
