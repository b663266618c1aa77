"""Registered timestamp-difference queries (SCL-1/2, SRC-2, AGG-14).

Test cases are built from ``orders``: the first timestamp of a case is the
order date plus ``o_orderkey % 86400`` seconds written with offset +0530, the
second the order date plus ``o_custkey * 37 % 86400`` seconds with -0700.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwood.functions.timestamps import parse_offset_timestamp, timestamp_diff
from driftwood.operators.timediff import case_results_json
from driftwood.plans.registry import register
from driftwood.plans.views import table


def _cases(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    base = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    a = F.timestamp_micros(base + (F.col("o_orderkey") % 86400) * 1_000_000)
    b = F.timestamp_micros(base + (F.col("o_custkey") * 37 % 86400) * 1_000_000)
    fmt = "EEE dd MMM yyyy HH:mm:ss"
    return o.select(
        F.col("o_custkey").alias("file"),
        F.col("o_orderkey").alias("case_id"),
        F.concat(F.date_format(a, fmt), F.lit(" +0530")).alias("t1"),
        F.concat(F.date_format(b, fmt), F.lit(" -0700")).alias("t2"))


def _diffs(spark, sf_dir):
    c = _cases(spark, sf_dir)
    return c.select("file", "case_id", "t1", "t2",
                    timestamp_diff(parse_offset_timestamp("t1"),
                                   parse_offset_timestamp("t2")).alias("diff_seconds"))


_SQL_CASES = """
WITH cases AS (
  SELECT o_custkey AS file, o_orderkey AS case_id,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%a %d %b %Y %H:%M:%S')
           || ' +0530' AS t1,
         strftime(o_orderdate + to_seconds((o_custkey * 37) % 86400), '%a %d %b %Y %H:%M:%S')
           || ' -0700' AS t2
  FROM orders),
diffs AS (
  SELECT file, case_id, t1, t2,
         abs(CAST(epoch(strptime(regexp_replace(trim(t1), '^\\S+\\s+', ''), '%d %b %Y %H:%M:%S %z')) AS BIGINT)
           - CAST(epoch(strptime(regexp_replace(trim(t2), '^\\S+\\s+', ''), '%d %b %Y %H:%M:%S %z')) AS BIGINT))
           AS diff_seconds
  FROM cases)
"""


@register("timestamp_diff", _SQL_CASES + "SELECT * FROM diffs")
def timestamp_diff_query(spark, sf_dir):
    return _diffs(spark, sf_dir)


@register("timestamp_case_array", _SQL_CASES + """
SELECT file, list_reduce(list_prepend('[', list_append(
         list_transform(list_zip(r, range(len(r))),
                        lambda x: CASE WHEN x[2] = 0 THEN '' ELSE ',' END || '"' || x[1] || '"'), ']')),
         lambda a, b: a || b) AS results,
       len(r) AS n_cases
FROM (SELECT file, list(CAST(diff_seconds AS VARCHAR) ORDER BY case_id) AS r FROM diffs GROUP BY file)""")
def timestamp_case_array(spark, sf_dir):
    """One array per input; a case's id is its position in the input, from 0."""
    position = F.row_number().over(Window.partitionBy("file").orderBy("case_id")) - 1
    return case_results_json(_diffs(spark, sf_dir).withColumn("case_id", position))
