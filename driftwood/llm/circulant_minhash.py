"""Near copies of documents through circulant MinHash.

Two permutations of the 64-bit numbers give every signature coordinate: the
first scatters a shingle's hash, the second is applied to the result shifted
round by 1, 2, 3, ... places, and a coordinate is the least value over the
set. Signatures are cut into bands. Sets that share a band are first held
against the least set of the band's bucket only, a join of as many rows as
there are sets, which settles large groups of copies; buckets that these
links leave in several parts are compared in full, block by block. All
decisions are made on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm import minhash
from driftwood.llm.common import components, cut


def _bijection(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 64-bit numbers: xor-shifts and odd factors."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(a)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(b)
    return x ^ (x >> np.uint64(32))


class CirculantBands:
    """Band keys of shingle sets: coordinate ``k`` is the least ``second(first(x) - k)``."""

    def __init__(self, bands: int, rows: int, seed: int = 23):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        odd = [int(x) | 1 for x in rng.integers(2 ** 62, 2 ** 63, 4, np.uint64)]
        self.first, self.second = odd[:2], odd[2:]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Coordinates of one non-empty set, all at once for a piece of it that
        fits the cache. The second permutation's last xor-shift is left out: it
        keeps the upper half of a number, by which the least is found."""
        shift = np.arange(1, self.bands * self.rows + 1, dtype=np.uint64)[:, None]
        out = np.full(len(shift), np.uint64(2 ** 64 - 1))
        a, b = map(np.uint64, self.second)
        for lo in range(0, len(shingles), 256):
            x = _bijection(shingles[lo:lo + 256], *self.first)[None, :] - shift
            high = x >> np.uint64(32)
            x ^= high
            x *= a
            np.right_shift(x, np.uint64(29), out=high)
            x ^= high
            x *= b
            np.minimum(out, x.min(axis=1), out=out)
        return out

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        s = self.signature(shingles).reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            key = minhash.mixed(key * np.uint64(0x9E3779B97F4A7C15) + s[:, r])
        return key.view(np.int64)


def shingles_of(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles: words are parted by
    ASCII white space, A-Z lower-cased; fewer words than a shingle are one."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return minhash.shingle_set(hashes, words)


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set as two signed longs."""
    key = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (key >> 64) - 2 ** 63, (key & (2 ** 64 - 1)) - 2 ** 63


def alike(a: Column, b: Column, percent: int) -> Column:
    """Whether two sets (sorted distinct 64-bit hashes, binary) reach the Jaccard likeness."""
    @F.pandas_udf("boolean")
    def decide(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                out.append(False)
                continue
            common = len(x) + len(y) - len(np.union1d(x, y))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)
    return decide(a, b)


def near_copies(docs: DataFrame, percent: int = 85, words: int = 3, recall: float = 0.9999,
                most_hashes: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents whose sets of word ``words``-shingles have a Jaccard
    likeness of ``percent`` hundredths or more.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (size of its
    set), ``component_id`` (smallest doc_id that links lead to, its own
    included) and ``kept`` (it is that document). A null text and one without
    words have an empty set and link to nothing. A null id is not compared:
    it has a null component and is kept. Rows that repeat, or whose texts have
    equal sets, are one node; two different texts under one id are two nodes.
    Bands are chosen so that a pair at the threshold meets with a chance of
    ``recall``; no bucket is capped.
    """
    threshold = percent / 100
    banding = CirculantBands(*minhash.bands_for(threshold, recall, most_hashes))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, high, low, bands = [], [], [], []
            for t in batch.column("t").to_pylist():
                s = shingles_of(t, words)
                key = _set_key(s) if len(s) else (None, None)
                n.append(len(s))
                high.append(key[0])
                low.append(key[1])
                bands.append(banding.keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["d", "n", "high", "low", "bands"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, t in zip(batch.column("node").to_pylist(), batch.column("t").to_pylist()):
                s = shingles_of(t, words)
                if len(s) and _set_key(s)[0] == node:  # rows may share an id, but not its set
                    out.append((node, s.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                              pa.array([x for _, x in out], pa.binary())], names=["node", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    sketched = cut(rows.mapInArrow(sketch, "d long, n long, high long, low long, bands array<long>"))
    # One node per distinct set, named by the first half of its key.
    nodes = cut(sketched.where("d is not null and high is not null").groupBy("high", "low")
                .agg(F.min("d").alias("doc"), F.min_by("bands", "d").alias("bands"))
                .withColumnRenamed("high", "node"))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = (keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .where("least <> most").select("key", "least"))
    met = cut(keyed.join(shared, "key"))
    wanted = met.select("node").distinct().join(nodes.select("node", "doc"), "node")
    sets = cut(rows.join(wanted, F.col("d") == F.col("doc")).select("d", "node", "t").distinct()
               .mapInArrow(full, "node long, shingles binary"))
    others = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("other"))
    # Each set against one least set of its buckets; then, where a bucket is
    # still in several parts, against one that it is not connected to.
    linked, apart = None, met.select("key", "node", F.col("least").alias("pivot"))
    for _ in range(2):
        pairs = apart.where("node <> pivot").groupBy("node").agg(F.min("pivot").alias("pivot"))
        found = cut(pairs.join(sets, "node").join(others, "pivot")
                    .where(alike(F.col("shingles"), F.col("other"), percent))
                    .select(F.col("node").alias("a"), F.col("pivot").alias("b")))
        linked = found if linked is None else linked.unionAll(found)
        rooted = (met.select("key", "node").join(components(linked), "node", "left")
                  .withColumn("root", F.coalesce("root", "node")))
        parted = (rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                            F.min(F.struct("node", "root")).alias("first"))
                  .where("low < high").select("key", "first"))
        apart = cut(rooted.join(parted, "key").select(
            "key", "node", F.when(F.col("root") == F.col("first.root"), F.col("node"))
            .otherwise(F.col("first.node")).alias("pivot")))
    # What is left is compared in full.
    pivots = apart.groupBy("key").agg(F.min("node").alias("least"))
    groups = components(apart.join(pivots, "key").select(F.col("node").alias("a"), F.col("least").alias("b")))
    members = groups.join(sets, "node").select("root", "node", F.lit(1).cast("long").alias("weight"), "shingles")
    checked = cut(minhash.verify(members, threshold))
    found = components(linked.unionAll(checked.select(F.col("node").alias("a"), F.col("to").alias("b"))))
    named = nodes.select("node", "low", "doc").join(found, "node", "left")
    first = named.where("root is not null").groupBy("root").agg(F.min("doc").alias("first"))
    classed = named.join(first, "root", "left").select(F.col("node").alias("high"), "low",
                                                       F.coalesce("first", "doc").alias("first"))
    component = F.when(F.col("d").isNotNull(), F.coalesce("first", "d"))
    return (sketched.select("d", "n", "high", "low").join(classed, ["high", "low"], "left")
            .select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(F.col("d") == component, F.lit(True)).alias("kept")))
