"""Timestamp-pair test cases: differences and per-input result arrays
(SCL-1/2, SRC-2, AGG-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.functions.timestamps import parse_offset_timestamp, timestamp_diff


def case_differences(cases: DataFrame) -> DataFrame:
    """(file, case_id, t1, t2) -> absolute difference in whole seconds.

    A case whose timestamps do not parse keeps a null difference and an
    ``error`` text instead of failing the whole input (D17).
    """
    p1, p2 = parse_offset_timestamp("t1"), parse_offset_timestamp("t2")
    out = cases.withColumn("diff_seconds", timestamp_diff(p1, p2))
    err = F.when(F.col("diff_seconds").isNull(), F.lit("unparsable timestamp"))
    if "error" in cases.columns:
        err = F.coalesce(F.col("error"), err)
    return out.withColumn("error", err)


def case_results_json(diffs: DataFrame, file_col: str = "file") -> DataFrame:
    """AGG-14: the results of one input as one JSON array of strings in case
    order, e.g. ``["25200","88200"]``; one row per input.

    An input is one request text that SRC-2 reads as a single row, so its
    cases fit a row again; inputs spread over the tasks by their name.
    """
    return (diffs.groupBy(file_col)
            .agg(F.sort_array(F.collect_list(F.struct("case_id", "diff_seconds"))).alias("_c"),
                 F.count(F.lit(1)).alias("n_cases"))
            .select(file_col,
                    F.to_json(F.transform("_c", lambda x: x["diff_seconds"].cast("string")))
                    .alias("results"),
                    "n_cases"))
