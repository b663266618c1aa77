"""File scans: call-record CSV, timestamp-pair text, JSON messages, metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.schemas import CDR_SCHEMA_WITH_CORRUPT
from driftwood.session import ensure_checkpoint_dir


def read_cdr_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: call-detail CSV with a header, declared schema (no inference).

    Malformed lines are kept: their fields are null and the raw line is in
    ``_corrupt_record``, so a quarantine can pick them up.
    """
    return (spark.read
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .schema(CDR_SCHEMA_WITH_CORRUPT)
            .csv(path))


def split_corrupt(df: DataFrame, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) of a permissive CSV/JSON scan.

    Spark rejects queries on a raw scan that read only the corrupt-record
    column, so the parsed scan is first materialised with a reliable
    ``checkpoint()`` in the shared checkpoint folder (which also cuts the
    lineage: both outputs are read from it, the source is parsed once)."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    cols = df.columns
    bad = df.where(F.col(corrupt).isNotNull()).select(*cols)
    good = df.where(F.col(corrupt).isNull()).select(*[c for c in cols if c != corrupt])
    return good, bad


def read_pairs_text(text_df: DataFrame, file_col: str = "file",
                    value_col: str = "value") -> DataFrame:
    """SRC-2 on rows of whole texts: line 1 is the case count ``T``, then
    ``2T`` lines of timestamps. One output row per (file, case), in input
    order (``case_id`` 0-based). A missing second line gives a null ``t2``.
    The lines present bound the cases: a count beyond them adds one row with
    the ``error`` "missing cases" (its ``case_id`` is the first missing one),
    and a bad count gives no cases and one row with ``error`` set.
    """
    lines = F.split(F.regexp_replace(F.trim(F.col(value_col)), r"\r\n", "\n"), "\n")
    t = F.trim(F.element_at(lines, 1)).try_cast("int")
    base = text_df.select(F.col(file_col).alias("file"), lines.alias("_lines"), t.alias("_t"))
    there = F.least(F.col("_t"), F.ceil((F.size("_lines") - 1) / 2).cast("int"))
    none = F.lit(None).cast("string")
    kind = "array<struct<case_id:int,t1:string,t2:string,error:string>>"

    def failed(at, why: str):
        return F.array(F.struct(at.cast("int").alias("case_id"), none.alias("t1"), none.alias("t2"),
                                F.lit(why).alias("error"))).cast(kind)
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(there, F.lit(1)) - 1), lambda k: F.struct(
        k.cast("int").alias("case_id"), F.get("_lines", k * 2 + 1).alias("t1"),
        F.get("_lines", k * 2 + 2).alias("t2"), none.alias("error"))).cast(kind)
    cases = F.when(there > 0, pairs).otherwise(F.array().cast(kind))
    rows = F.when(F.coalesce(F.col("_t") > 0, F.lit(False)),
                  F.when(there < F.col("_t"), F.concat(cases, failed(there, "missing cases"))).otherwise(cases)
                  ).otherwise(failed(F.lit(None), "invalid case count"))
    return base.select("file", F.inline(rows))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: read timestamp-pair files (one file = one request)."""
    texts = (spark.read.text(path, wholetext=True)
             .select(F.input_file_name().alias("file"), "value"))
    return read_pairs_text(texts)


def read_json_messages(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: JSON lines -> VARIANT, which keeps 'absent' apart from 'null'
    and the per-value type. Lines that are not JSON become a null ``msg``."""
    return spark.read.text(path).select(
        F.col("value").alias("raw"), F.try_parse_json("value").alias("msg"))


def read_metrics(spark: SparkSession, path: str, names: list[str] | None = None,
                 since: dt.datetime | None = None) -> DataFrame:
    """SRC-7 / FLT-9: metric points, optionally by name and ``ts >= since``.

    Metrics are written partitioned by ``date`` (SNK-10), so the ``since``
    bound also prunes whole date partitions.
    """
    df = spark.read.parquet(path)
    if names:
        df = df.where(F.col("name").isin(list(names)))
    if since is not None:
        df = df.where((F.col("date") >= F.lit(since.date())) & (F.col("ts") >= F.lit(since)))
    return df
