"""Word shingles, MinHash bands and exact verification in blocks.

Shared by the document join and the paragraph dedup. Candidates come from
bands; bucket mates are linked to their bucket's smallest member only, and
the candidate groups (components of these stars) are verified on the full
shingle sets. A large group is split into blocks and compared block against
block, so a task holds two blocks at most, and only link counts and a
spanning forest leave it, never the pairs. Where no link counts are asked,
``linked`` holds only sets against each other that share a first shingle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftwood.llm.common import components, cut, unconnected, written
from driftwood.session import remove_folder

words_of = re.compile(r"\w+").findall
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _Q
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words."""
    n = len(hashes) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _P + hashes[i:i + n]
    return mixed(out)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles; fewer than ``k`` words are one shingle, no words none."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(hashes, min(k, len(hashes))))


def bands_for(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows) with the most rows per band, hence the fewest false
    candidates, whose chance to bring together a pair at ``threshold`` is at
    least ``recall`` with at most ``most_hashes`` hashes."""
    for rows in range(most_hashes, 0, -1):
        meet = threshold ** rows  # chance that one band brings a pair together
        bands = 1 if meet >= recall else math.log1p(-recall) / math.log1p(-meet) if meet > 1e-12 else math.inf
        if bands * rows <= most_hashes and math.ceil(bands) * rows <= most_hashes:
            return math.ceil(bands), rows
    raise ValueError("more hashes are needed for this recall")


class Banding:
    """Hash family and band keys."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = rng.integers(1, 2 ** 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.salts = rng.integers(0, 2 ** 63, bands, np.uint64)

    def keys(self, shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Band keys (sets x bands, int64) of the sets that lie one after the
        other in ``shingles``; ``starts`` holds where each (non-empty) begins."""
        out = np.empty((len(starts), self.bands), np.uint64)
        for b in range(self.bands):
            key = np.full(len(starts), self.salts[b], np.uint64)
            for f in self.factors[b * self.rows:(b + 1) * self.rows]:
                low = np.minimum.reduceat((shingles ^ (shingles >> np.uint64(32))) * f, starts)
                key = key * _P + low
            out[:, b] = mixed(key)
        return out.view(np.int64)


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows (as tuples) with equal first ``keys`` columns."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != at:
                if held:
                    yield at, held
                held, at = [], row[:keys]
            held.append(row)
    if held:
        yield at, held


def _linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard likeness reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total, width = int(shared.sum()), 4096
    for lo in range(0, total, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((n, min(width, total - lo)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        common += part @ part.T
    both = sizes[:, None] + sizes[None, :]
    near = common.astype(np.float64) * (1 + threshold) >= (threshold - 1e-9) * both
    np.fill_diagonal(near, False)
    return near


def _forest(near: np.ndarray) -> np.ndarray:
    """Smallest position that each position is connected to."""
    root = np.arange(len(near))
    while True:
        low = np.where(near, root[None, :], len(near)).min(axis=1, initial=len(near))
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


#: Nodes of a group beyond which its sets are held against each other by their rarest shingles.
LARGE = 32


def _wanted(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """So many first shingles of two sets have one in common if they reach the threshold."""
    return np.minimum(sizes, sizes - np.ceil((threshold - 1e-9) * sizes).astype(np.int64) + 1)


def first_shingles(members: DataFrame, threshold: float) -> tuple[DataFrame, str]:
    """A table ``root, node, size, shingle, last``, and its path: of each set so many of its first
    shingles, in an order of all shingles of the group, that two sets of a
    likeness of ``threshold`` have one of them in common, and the place of the
    last in that order. In a group of more than ``LARGE`` nodes the rarest come
    first, so what many sets have makes few pairs; else the order is that of
    the sets."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            large = batch.column("large").to_numpy(zero_copy_only=False)
            wanted = _wanted(sizes, threshold)
            sent = np.where(large, sizes, wanted)
            # Sets are sorted as unsigned numbers.
            last = np.array([x[n - 1] if n else 0 for x, n in zip(sets, wanted.tolist())], np.int64) ^ np.int64(-2 ** 63)
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("root", "node")]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(c, sent)) for c in (*columns, sizes, wanted, large, last)),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *(x[:n] for x, n in zip(sets, sent.tolist()))]))],
                names=["root", "node", "size", "wanted", "large", "last", "shingle"])
    large = members.groupBy("root").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > LARGE).select(
        "root", F.lit(True).alias("large"))
    sent, path = written(
        members.select("root", "node", "shingles").join(large, "root", "left")
        .select("root", "node", "shingles", F.coalesce("large", F.lit(False)).alias("large"))
        .mapInArrow(first, "root long, node long, size long, wanted long, large boolean, last long, shingle long"), "shingles")
    few = sent.where("not large").select("root", "node", "size", "shingle", F.struct(
        F.lit(0).cast("long").alias("rank"), F.col("last").alias("shingle")).alias("last"))
    many = sent.where("large").select("root", "node", "size", "wanted", "shingle")
    ranked = many.join(many.groupBy("root", "shingle").agg(F.count(F.lit(1)).alias("rank")), ["root", "shingle"])
    place = F.struct("rank", "shingle")
    rarest = (ranked.withColumn("at", F.row_number().over(Window.partitionBy("root", "node").orderBy("rank", "shingle")))
              .where("at <= wanted").withColumn("last", F.max(place).over(Window.partitionBy("root", "node")))
              .select("root", "node", "size", "shingle", "last"))
    out = written(few.unionAll(rarest), "shingles")
    remove_folder(members.sparkSession, path)
    return out


def _reached(pairs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` of nodes whose full sets reach the threshold."""
    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                near.append(common * (1 + threshold) >= (threshold - 1e-9) * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    sides = [members.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "set_a", "set_b").mapInArrow(
        hold, "a long, b long")


def linked(members: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` that connect all nodes of a group (``members`` of
    ``verify``, one row a node; materialised) whose sets reach the threshold.

    Only nodes that share first shingles are held against each other: at
    first against the least node that has one, then all others that these links
    do not connect yet and that share enough of them. The sets of as many pairs
    as nodes move at a time, and what links found meanwhile connect does not
    move any more. So a large group of near copies makes few pairs, and a group
    that chance alone holds together next to none."""
    opening, path = first_shingles(members, threshold)
    least = (opening.groupBy("root", "shingle").agg(F.min(F.struct("node", "size")).alias("least"),
                                                    F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))
    shared, shared_path = written(opening.join(least, ["root", "shingle"]), "shingles")
    remove_folder(members.sparkSession, path)

    def alike(a: str, b: str) -> Column:
        return F.least(a, b) >= (threshold - 1e-9) * F.greatest(a, b)

    stars = (shared.where((F.col("node") != F.col("least.node")) & alike("size", "least.size"))
             .select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct())
    near = cut(_reached(stars, members, threshold))
    parts = components(near).withColumnRenamed("root", "part")
    parted, path = written(shared.drop("least").join(parts, "node", "left")
                           .withColumn("part", F.coalesce("part", "node")), "shingles")
    remove_folder(members.sparkSession, shared_path)
    a, b = (parted.select("root", "shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "size", "last", "part")))
            for x in "ab")
    apart = ((F.col("node_a") < F.col("node_b")) & (F.col("part_a") != F.col("part_b")) & alike("size_a", "size_b"))
    # All first shingles of the set whose last comes first that the other one has are
    # first ones there, too. So at most these and all its others are common to both.
    rest = F.ceil((threshold - 1e-9) * F.when(F.col("last_a") <= F.col("last_b"), F.col("size_a")).otherwise(F.col("size_b"))) - 1
    wanted = F.ceil((threshold - 1e-9) * (F.col("size_a") + F.col("size_b")) / (1 + threshold) - 1e-6)
    left = cut(a.join(b, ["root", "shingle"]).where(apart)
               .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), (wanted - rest).cast("int").alias("least"))
               .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("least").alias("least"))
               .where("shared >= least").select("a", "b"))
    remove_folder(members.sparkSession, path)
    most, turn = max(1, members.count()), 0
    while n := left.count():
        turn += 1
        drawn = F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(math.ceil(n / most))) == 0
        found = cut(_reached(left.where(drawn), members, threshold))
        near = cut(near.unionAll(found))
        left = left.where(~drawn)
        if n <= most:
            break
        left = cut(unconnected(left, near))
    return near


def verify(members: DataFrame, threshold: float, block_rows: int = 256,
           block_shingles: int = 1_500_000) -> DataFrame:
    """Check candidate groups on full sets.

    ``members``: ``root long`` (group), ``node long``, ``weight long``
    (copies that the node stands for), ``shingles binary`` (sorted distinct
    64-bit hashes). Returns rows ``node, links, to``: ``links`` sums the
    weights of linked nodes (once per pair over all rows of a node), and
    ``to`` is a node of the same connected group, or null.
    """
    sized = members.withColumn("size", (F.length("shingles") / 8).cast("long"))
    blocks = sized.groupBy("root").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / block_rows,
                          F.sum("size") / block_shingles)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (sized.join(blocks, "root").withColumn("own", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      "own", "node", "weight", "shingles"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              names=["node", "links", "to"])
        for (_, i, j), rows in groups_of(batches, 3):
            rows = list({r[4]: r for r in rows}.values())  # a repeated node counts once
            own = np.array([r[3] for r in rows])
            nodes = [r[4] for r in rows]
            weight = np.array([r[5] for r in rows], np.int64)
            near = _linked([np.frombuffer(r[6], np.uint64) for r in rows], threshold)
            if i != j:
                near &= own[:, None] != own[None, :]  # pairs inside a block are its own task's
            root = _forest(near)
            links = near @ weight
            out += [(nodes[k], int(links[k]), nodes[root[k]]) for k in np.nonzero(links)[0]]
            if len(out) > 50_000:
                yield flush()
        yield flush()

    parted = spread.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return parted.mapInArrow(compare, "node long, links long, to long")
