"""Best-fit packing by exact-complement hashing.

Token counts are bounded by the sequence length, so every decision needs
only the histogram of piece lengths, which has at most ``capacity`` entries
however many pieces there are. The plan is made on that histogram: for each
length, longest first, the gap it leaves is looked up among single lengths,
pair sums and triple sums of what is still available, and a combination that
fills the gap exactly is used as often as its availability counts allow.
Lengths that no combination completes are placed best-fit, again by whole
counts. Spark then deals the pieces to the plan: a piece's number among the
pieces of its length names its place.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftwood.llm import bpe_ids
from driftwood.llm.common import cut, small_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document's ids and its end id.

    A document of at most ``capacity`` ids is one piece. A longer one is cut
    into full pieces; only its first piece may be shorter. Null text counts
    as empty (the end id alone).
    """
    end = np.uint32(end_id).tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = bpe_ids.Memo()
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column("d").to_pylist(), bpe_ids.encode(batch.column("t"), tokenizer, memo)):
                ids = body + end
                n = len(ids) // 4
                first = n % capacity or min(n, capacity)
                starts = [0, *range(first, n, capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
            columns = list(zip(*rows)) or [()] * len(_PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    return docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")
                       ).mapInArrow(cut_up, PIECES)


def _fill(histogram: dict[int, int], capacity: int, passes: tuple[tuple[int, ...], ...]
          ) -> list[tuple[tuple[int, ...], int]]:
    """One plan: for each pass, every length (longest first) looks up the
    combinations of the given sizes that fill its gap exactly; what is left
    goes best-fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        """Use a combination as often as its counts allow."""
        need = defaultdict(int)
        for x in lengths:
            need[int(x)] += 1
        times = min(int(left[x]) // k for x, k in need.items())
        if times > 0:
            for x, k in need.items():
                left[x] -= k * times
            patterns.append((tuple(int(x) for x in lengths), times))

    def singles(long: int, gap: int) -> None:
        take(long, gap)

    def pairs(long: int, gap: int) -> None:
        for a in np.nonzero(left[:gap])[0][::-1]:  # the larger part first: small pieces last
            if not left[long] or 2 * a < gap:
                break
            take(long, a, gap - a)

    def triples(long: int, gap: int) -> None:
        for a in np.nonzero(left[:gap])[0][::-1]:
            if not left[long] or 3 * a < gap:
                break
            rest = gap - a
            b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
            for x in b[(left[b] > 0) & (left[rest - b] > 0)][::-1]:
                if not left[long] or not left[a]:
                    break
                take(long, a, x, rest - x)

    take(capacity)  # full pieces stand alone
    for sizes in passes:
        for long in range(capacity - 1, 0, -1):
            for find in (f for k, f in enumerate((singles, pairs, triples), 1) if k in sizes):
                if left[long]:
                    find(long, capacity - long)
    # Residuals: best fit by whole counts into groups of equal open patterns.
    open_by_gap: dict[int, list[list]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = next((g for g in range(length, capacity) if open_by_gap[g]), None)
            if gap is None:
                per = min(n, capacity // length)  # that many share a sequence of their own
                open_by_gap[capacity - per * length].append([(length,) * per, n // per])
                n %= per
                continue
            lengths, times = open_by_gap[gap].pop()
            used = min(times, n)
            if times > used:
                open_by_gap[gap].append([lengths, times - used])
            open_by_gap[gap - length].append([(*lengths, length), used])
            n -= used
    return patterns + [(lengths, times) for groups in open_by_gap.values()
                       for lengths, times in groups]


#: Orders in which combination sizes are looked up. Which of them wastes least
#: depends on how many small pieces there are to spare for the long ones.
PASSES = (((1, 2, 3),), ((1,), (2,), (3,)), ((1,), (2,)), ((1,),), ())


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, times)`` that use every piece of the histogram
    once; the lengths of a pattern add up to ``capacity`` at most. Of the
    lookup orders in ``PASSES``, the one with the fewest sequences."""
    return min((_fill(histogram, capacity, passes) for passes in PASSES),
               key=lambda patterns: sum(times for _, times in patterns))


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first piece number of each run of places, then the run's
    first sequence and the offset in it."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            runs[x].append((given[x], sequence, offset))
            given[x] += times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = 1024, rows_per_salt: int = 500_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (columns of
    ``token_pieces``, ``length`` from 1 to ``capacity``).

    The driver sees the histogram alone (at most ``capacity`` rows). Pieces
    are numbered within (length, salt), so that a length that holds most rows
    still spreads over many tasks. No pieces give no rows; repeated rows are
    packed once each.
    """
    with small_batches(pieces.sparkSession):
        pieces = cut(pieces)  # read twice below; tokenising is not repeated
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"piece lengths must lie between 1 and {capacity}")
    slots = _slots(plan(histogram, capacity))
    salts = max(1, math.ceil(max(histogram.values(), default=0) / rows_per_salt))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = (salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("__before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("__salt")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    order = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("__k", F.row_number().over(order) - 1)
              .join(before, ["length", "__salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("__k") + F.col("__before")).alias("__rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.nonzero(length == x)[0]
                first, sequence, offset = slots[int(x)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                seq[at] = sequence[run] + rank[at] - first[run]
                off[at] = offset[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(seq), pa.array(off)],
                names=[*_PIECES.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
