"""Registered call-record queries (WIN-1/2, PRJ-7..11, AGG-2..4, FLT-4/5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import calls as C
from driftwood.plans.registry import register, sql_round, with_views
from driftwood.plans.views import SQL_CDR, cdr, table

# cdr rows carry event_id, the final tie-break on equal starts.
ORDER = ("end_dt", "ulvolume", "dlvolume", "event_id")


def _calls(spark, sf_dir, gap_from="previous"):
    trimmed = C.idle_trim(cdr(spark, sf_dir))
    return C.call_sessions(trimmed, order=ORDER, gap_from=gap_from)


def _classified(spark, sf_dir, unit, min_rate=C.MIN_BITRATE):
    return C.classify_calls(_calls(spark, sf_dir), bitrate_unit=unit, min_rate=min_rate)


_SQL_SESSIONS = with_views(SQL_CDR, """
trimmed AS (
  SELECT *, CASE WHEN end_dt - INTERVAL 10 MINUTE < start_dt THEN end_dt
                 ELSE end_dt - INTERVAL 10 MINUTE END AS adjusted_end_dt
  FROM cdr
  WHERE msisdn IS NOT NULL AND domain IS NOT NULL
    AND start_dt IS NOT NULL AND end_dt IS NOT NULL)""", """
flagged AS (
  SELECT *, CASE WHEN epoch_us(start_dt) - epoch_us(lag(end_dt) OVER w) > 300000000
                 THEN 1 ELSE 0 END AS new_call
  FROM trimmed
  WINDOW w AS (PARTITION BY msisdn, domain
               ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id))""", """
sessions AS (
  SELECT *, sum(new_call) OVER (PARTITION BY msisdn, domain
               ORDER BY start_dt, end_dt, ulvolume, dlvolume, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS call_no
  FROM flagged)""", """
calls AS (
  SELECT msisdn, domain, CAST(call_no AS BIGINT) AS call_no,
         CAST(sum(ulvolume) AS BIGINT) AS ul_bytes,
         CAST(sum(dlvolume) AS BIGINT) AS dl_bytes,
         min(start_dt) AS call_start, max(adjusted_end_dt) AS call_end,
         count(*) AS fdr_count
  FROM sessions GROUP BY msisdn, domain, call_no)""", """
timed AS (
  SELECT *, CAST(epoch_us(call_end) - epoch_us(call_start) AS DOUBLE) / 1000000 AS dur,
         CAST(ul_bytes + dl_bytes AS DOUBLE) / 1024 AS volume_kb
  FROM calls)""")


def _sql_classified(rate_expr: str, min_rate: float = 10) -> str:
    return _SQL_SESSIONS + f""",
rated AS (SELECT *, {rate_expr} AS rate FROM timed WHERE dur > 0),
classified AS (
  SELECT msisdn, domain, CAST(floor(dur) AS BIGINT) AS duration_sec, fdr_count,
         {sql_round('rate', 2)} AS kbps, rate <= 200 AS is_audio, rate > 200 AS is_video
  FROM rated WHERE rate >= {min_rate})
"""


_REF_RATE = "(volume_kb * 8) / (dur / 3600)"
_KBPS_RATE = "(volume_kb * 8) / dur"


@register("calls_sessionize", _SQL_SESSIONS + """
SELECT msisdn, domain, call_no, fdr_count, ul_bytes, dl_bytes,
       epoch_us(call_start) AS call_start_us, epoch_us(call_end) AS call_end_us
FROM calls""")
def calls_sessionize(spark, sf_dir):
    a = _calls(spark, sf_dir)
    return a.select("msisdn", "domain", "call_no", "fdr_count", "ul_bytes", "dl_bytes",
                    F.unix_micros("call_start").alias("call_start_us"),
                    F.unix_micros("call_end").alias("call_end_us"))


# WIN-1/2 as users call it: the call number on every record.
@register("calls_record_numbers", _SQL_SESSIONS + """
SELECT msisdn, domain, event_id, CAST(call_no AS BIGINT) AS call_no
FROM sessions""")
def calls_record_numbers(spark, sf_dir):
    s = C.sessionize(C.idle_trim(cdr(spark, sf_dir)), order=ORDER)
    return s.select("msisdn", "domain", "event_id", "call_no")


@register("calls_bitrate", _sql_classified(_REF_RATE) + "SELECT * FROM classified")
def calls_bitrate(spark, sf_dir):
    return C.result_columns(_classified(spark, sf_dir, "reference"))


# True kilobits per second (D8). The derived records carry a few KB each, so
# every call is far below 10 kbps; the query reports all calls (min_rate 0).
@register("calls_true_kbps", _sql_classified(_KBPS_RATE, 0) + "SELECT * FROM classified")
def calls_true_kbps(spark, sf_dir):
    return C.result_columns(_classified(spark, sf_dir, "kbps", min_rate=0.0))


@register("calls_summary", _sql_classified(_REF_RATE) + f"""
SELECT count(*) AS total_calls,
       CAST(count(*) FILTER (WHERE is_audio) AS BIGINT) AS audio_calls,
       CAST(count(*) FILTER (WHERE is_video) AS BIGINT) AS video_calls,
       {sql_round('avg(duration_sec)', 6)} AS avg_duration_sec,
       {sql_round('avg(kbps)', 6)} AS avg_bitrate_kbps,
       count(DISTINCT msisdn) AS total_msisdns,
       count(DISTINCT domain) AS total_domains
FROM classified""")
def calls_summary(spark, sf_dir):
    s = C.summarize_calls(_classified(spark, sf_dir, "reference"))
    return (s.withColumn("avg_duration_sec", F.round("avg_duration_sec", 6))
             .withColumn("avg_bitrate_kbps", F.round("avg_bitrate_kbps", 6)))


@register("calls_idle_trim", with_views(SQL_CDR) + """
SELECT msisdn, domain, event_id,
       CAST(epoch_us(end_dt) - epoch_us(start_dt) AS DOUBLE) / 1000000 AS duration_sec,
       CAST(CASE WHEN epoch_us(end_dt) - 600000000 < epoch_us(start_dt)
                 THEN epoch_us(end_dt) ELSE epoch_us(end_dt) - 600000000 END
            - epoch_us(start_dt) AS DOUBLE) / 1000000 AS adjusted_duration_sec
FROM cdr""")
def calls_idle_trim(spark, sf_dir):
    t = C.idle_trim(cdr(spark, sf_dir))
    return t.select("msisdn", "domain", "event_id", "duration_sec", "adjusted_duration_sec")


# Glued "date+time" text built from orders; every 97th order gets junk text.
@register("cdr_datetime_repair", """
WITH glued AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
              ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d%H:%M:%S')
         END AS raw
  FROM orders)
SELECT o_orderkey, raw,
       regexp_replace(raw, '(\\d{4}-\\d{2}-\\d{2})(\\d{2}:\\d{2}:\\d{2})', '\\1 \\2') AS repaired,
       epoch_us(try_strptime(
         regexp_replace(raw, '(\\d{4}-\\d{2}-\\d{2})(\\d{2}:\\d{2}:\\d{2})', '\\1 \\2'),
         '%Y-%m-%d %H:%M:%S')) AS parsed_us
FROM glued""")
def cdr_datetime_repair(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp"))
                            + (F.col("o_orderkey") % 86400) * 1_000_000)
    raw = F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(
        F.date_format(ts, "yyyy-MM-ddHH:mm:ss"))
    g = o.select("o_orderkey", raw.alias("raw"))
    g = C.parse_record_times(g.withColumn("_end", F.col("raw")), "raw", "_end")
    return g.select("o_orderkey", "raw",
                    C.repair_glued_datetime("raw").alias("repaired"),
                    F.unix_micros("start_dt").alias("parsed_us"))
