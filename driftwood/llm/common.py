"""Helpers shared by the text operators: stable ids, balanced key ranges and
connected components, all as DataFrame code."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.session import ensure_checkpoint_dir, scratch_path


def crc_of_id(col: str | Column) -> Column:
    """crc32 of an id's decimal text (null for a null id)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary"))


#: Whether a query's shuffle files go when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of a batch that Spark hands to Python.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """What runs inside has the session's setting ``name`` at ``value``."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Plans made inside remove their shuffle files at the end of their query."""
    return setting(spark, CLEANUP, "true")


def small_batches(spark: SparkSession, rows: int = 1000):
    """Plans run inside hand texts to Python ``rows`` at a time, so the JVM and
    Python hold a few MB of a batch, not tens."""
    return setting(spark, ARROW_ROWS, str(rows))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder. Nothing
    reads the shuffles behind it again, so their files go at once."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, of which a reader takes
    only the columns it needs, and its path, for ``remove_folder``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), path


def key_ranges(keys: DataFrame, key: str, rows_per_range: int) -> tuple[np.ndarray, int]:
    """Lower bounds of ranges of the integer column ``key`` that hold about
    ``rows_per_range`` rows each (range 0 also takes nulls), and the number
    of rows.

    Only the ids are read. The bounds are as many as the partitions of a
    range exchange would be, which Spark keeps on the driver as well.
    """
    n, lo = keys.agg(F.count(F.lit(1)), F.min(key)).first()
    parts = max(1, math.ceil(n / rows_per_range))
    if parts == 1 or lo is None:
        return np.zeros(0, np.int64), n
    # Equal-frequency cuts from a mergeable sketch; exact balance is not needed.
    points = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(key, points, max(10_000, 20 * parts))).first()[0]
    return np.unique(np.asarray(found, np.int64)), n


#: Stands for a null id, before all others.
NO_ID = -2 ** 63


def range_of(bounds: np.ndarray, key: str):
    """Number of the range that the id column ``key`` falls in (null: 0)."""
    @F.pandas_udf(T.IntegerType())
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))
    return place(F.coalesce(F.col(key), F.lit(NO_ID)))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list ``(a, b)`` of longs.

    Returns ``(node, root)`` for every node of an edge, ``root`` being the
    smallest node of its component. Alternates the two star contractions of
    Kiveris et al. (2014); a hub's neighbours stay rows of a join, which
    adaptive execution splits, and are never gathered. Every round is
    checkpointed. An empty edge list gives an empty result.
    """
    e = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        # Large star: every larger neighbour of u points at u's smallest neighbour.
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: u and its smaller neighbours point at the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        e = cut(small)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def unconnected(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes that the links ``a, b`` do not connect."""
    found = components(links)
    sides = [found.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab"]
    apart = F.coalesce(F.col("root_a") != F.col("root_b"), F.lit(True))
    return pairs.join(sides[0], "a", "left").join(sides[1], "b", "left").where(apart).select("a", "b")
