"""Exact top-k search by inner product as a Voronoi kNN join.

Queries and data are grouped by their nearest pivot. Per group the driver
sees a summary alone: the pivot, the radius, the number of rows and the
largest norm. From the summaries follow, for each group of queries, a score
that its k-th best answer reaches at least, and for each pair of groups a
score that no member can exceed. A data row is replicated to a group of
queries only if its own bound reaches that score; there it is scored against
the group's queries in blocks, and partial top lists are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Integers of up to 53 bits are exact in doubles, and so are sums of such products.
EXACT = 2.0 ** 53


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v array<double>`` with every component x as floor(scale * x).
    Rows that are null, empty or hold null or non-finite components, and rows
    with a null id, are left out. Rows that repeat whole count once."""
    # floor() to a long would saturate; whole doubles stay as they are.
    v = F.transform(F.col(vector_col), lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0 ** 52,
                                                        F.floor(x.cast("double") * scale).cast("double"))
                    .otherwise(x.cast("double") * scale))
    good = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()
                          & (F.size(vector_col) > 0) & good)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).distinct())


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as exact whole numbers."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(r, s)) for s in x] for r in q], object)
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, pivots: int = 32,
          queries_per_block: int = 512, rows_per_task: int = 20_000) -> DataFrame:
    """The ``k`` highest inner products of each query with every other row.

    ``vectors``: ``vec_id, v`` as from ``quantised``. Queries are the rows
    whose id is divisible by ``every``. Returns ``query_id, rank`` (from 1),
    ``vec_id, score``; ties go to the smaller id, and a query with fewer
    candidates has fewer rows. Vectors meet those of their own dimension
    only. Different vectors under one id are candidates each, and a query is
    never answered by a row of its own id.
    """
    parts = [_one_dimension(vectors.where(F.size("v") == r["n"]), k, every, pivots, queries_per_block, rows_per_task)
             for r in vectors.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()]
    out = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for p in parts:
        out = out.unionAll(p)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _one_dimension(vectors: DataFrame, k: int, every: int, pivots: int, queries_per_block: int,
                   rows_per_task: int) -> DataFrame:
    spark = vectors.sparkSession
    # Pivots: the rows with the smallest hashes of their vectors, a fixed number.
    centre = np.array([r["v"] for r in vectors.select("v").distinct()
                       .orderBy(F.xxhash64("v")).limit(pivots).collect()])
    norms = (centre ** 2).sum(axis=1)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "v")
            square = (x ** 2).sum(axis=1)
            d = square[:, None] - 2 * (x @ centre.T) + norms[None, :]
            group = d.argmin(axis=1)
            away = np.sqrt(((x - centre[group]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(group.astype(np.int32)), pa.array(away),
                 pa.array(np.sqrt(square))], names=["vec_id", "v", "cell", "away", "norm"])

    placed = vectors.mapInArrow(nearest, "vec_id long, v array<double>, cell int, away double, norm double")
    placed = placed.withColumn("is_query", F.pmod("vec_id", F.lit(every)) == 0)
    cells = [r.asDict() for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.max("norm").alias("norm"),
        F.count(F.when(F.col("is_query"), 1)).alias("queries"),
        F.max(F.when(F.col("is_query"), F.col("away"))).alias("reach"),
        F.max(F.when(F.col("is_query"), F.col("norm"))).alias("query_norm")).collect()]
    asked = [c for c in cells if c["queries"]]
    if not asked:
        return spark.createDataFrame([], "query_id long, vec_id long, score long")

    # Least score of the k-th best answer, per query group. For q in the
    # group of pivot p, |q - p| <= reach, and x in the cell of pivot c,
    # |x - c| <= radius:  q.x = p.c + p.(x - c) + (q - p).x
    #     >= p.c - |p| radius - reach * norm.
    slack = 1e-9
    floor = {}
    for g in asked:
        p = centre[g["cell"]]
        size = math.sqrt(p @ p)
        lows = sorted(((p @ centre[c["cell"]] - size * c["radius"] - g["reach"] * c["norm"], c["n"])
                       for c in cells), reverse=True)
        have, least = 0, -math.inf
        for low, n in lows:
            have += n
            if have > k:  # one more, for the query itself is no answer
                least = low - slack * (abs(low) + 1)
                break
        floor[g["cell"]] = least
    group = np.array([g["cell"] for g in asked], np.int32)
    reach = np.array([g["reach"] for g in asked])
    least = np.array([floor[g["cell"]] for g in asked])
    blocks = np.array([max(1, math.ceil(g["queries"] / queries_per_block)) for g in asked], np.int64)
    pieces = max(1, math.ceil(sum(c["n"] for c in cells) / rows_per_task))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send a row where its bound, p.x + reach |x|, attains the least score."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x, norm = _matrix(part, "v"), part.column("norm").to_numpy()
                high = x @ centre[group].T + norm[:, None] * reach[None, :]
                row, to = np.nonzero(high + slack * (np.abs(high) + 1) >= least[None, :])
                # Every block of a group's queries gets the row.
                row, to = np.repeat(row, blocks[to]), np.repeat(to, blocks[to])
                first = np.r_[True, (row[1:] != row[:-1]) | (to[1:] != to[:-1])] if len(row) else np.zeros(0, bool)
                start = np.maximum.accumulate(np.where(first, np.arange(len(row)), 0)) if len(row) else row
                take = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[to]), pa.array((np.arange(len(row)) - start).astype(np.int32)),
                     take.column("vec_id"), take.column("v")], names=["cell", "block", "vec_id", "v"])

    data = (placed.mapInArrow(replicate, "cell int, block int, vec_id long, v array<double>")
            .withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.lit(pieces)).cast("int"))
            .withColumn("query", F.lit(False)))
    block_of = F.element_at(F.create_map(*(F.lit(int(x)) for pair in zip(group, blocks) for x in pair)), F.col("cell"))
    queries = (placed.where("is_query").select(
        "cell", F.pmod(F.xxhash64("vec_id", "v"), block_of).cast("int").alias("block"), "vec_id", "v",
        F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece")).withColumn("query", F.lit(True)))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries of a (cell, block, piece) come first, then its data rows in steps."""
        at, ids, q, best = None, None, None, None

        def answer():
            rows = [(int(i), v, s) for i, found in zip(ids, best) for s, v in found] if ids is not None else []
            cols = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              names=["query_id", "vec_id", "score"])
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                key = np.stack([part.column(c).to_numpy() for c in ("cell", "block", "piece")], axis=1)
                asks = part.column("query").to_numpy(zero_copy_only=False)
                vec, x = part.column("vec_id").to_numpy(), _matrix(part, "v")
                turn = np.r_[True, (key[1:] != key[:-1]).any(axis=1) | (asks[1:] != asks[:-1])]
                starts = np.append(np.nonzero(turn)[0], len(key))
                for a, b in zip(starts, starts[1:]):
                    if tuple(key[a]) != at:
                        if ids is not None:
                            yield answer()
                        at, ids = tuple(key[a]), None
                    if asks[a]:
                        ids = vec[a:b] if ids is None else np.r_[ids, vec[a:b]]
                        q = x[a:b] if len(ids) == b - a else np.r_[q, x[a:b]]
                        best = [[] for _ in ids]
                    elif ids is not None:
                        score = _scores(q, x[a:b])
                        for i in range(len(ids)):
                            s, v = score[i], vec[a:b]
                            own = v != ids[i]
                            s, v = s[own], v[own]
                            if len(s) > k:
                                edge = np.partition(s, len(s) - k)[len(s) - k]
                                s, v = s[s >= edge], v[s >= edge]
                            order = np.lexsort((v, -s))[:k]
                            merged = best[i] + list(zip(s[order].tolist(), v[order].tolist()))
                            best[i] = sorted(merged, key=lambda t: (-t[0], t[1]))[:k]
        if ids is not None:
            yield answer()

    return (data.select("cell", "block", "piece", "query", "vec_id", "v")
            .unionAll(queries.select("cell", "block", "piece", "query", "vec_id", "v"))
            .repartition("cell", "block", "piece")
            .sortWithinPartitions("cell", "block", "piece", F.desc("query"))
            .mapInArrow(solve, "query_id long, vec_id long, score long"))
