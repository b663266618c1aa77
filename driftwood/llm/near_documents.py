"""N-gram Jaccard join of documents through MinHash bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm import minhash
from driftwood.llm.common import components, cut


def near_documents(docs: DataFrame, threshold: float = 0.8, words: int = 5, recall: float = 0.9999,
                   most_hashes: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Join documents whose sets of word ``words``-grams have a Jaccard
    likeness of ``threshold`` or more.

    Words are runs of letters, digits and underscores in lower case. Returns
    one row per input row: ``doc_id``, ``class_id`` (smallest doc_id that the
    document is connected to, its own if to none), ``n_links`` (other rows
    that it is linked to, copies included) and ``copies`` (rows with the same
    words). A text without words, a null text and a null id link to nothing;
    a null id has a null class. Rows that repeat count as copies.

    Texts with equal words are one node. Bands and rows per band are chosen
    for ``recall`` at the threshold; every candidate group is verified on
    full sets, so that all its pairs are found, also those that no band
    brought together.
    """
    banding = minhash.Banding(*minhash.bands_for(threshold, recall, most_hashes))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, bands = [], [], []
            for t in batch.column("t").to_pylist():
                found = minhash.words_of((t or "").lower())
                if not found:
                    for column in (high, low, bands):
                        column.append(None)
                    continue
                a, b = _key(found)
                high.append(a)
                low.append(b)
                s = minhash.shingle_set(minhash.word_hashes(found), words)
                bands.append(banding.keys(s, np.zeros(1, np.int64))[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["d", "high", "low", "bands"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for root, node, weight, t in zip(*(c.to_pylist() for c in batch.columns)):
                found = minhash.words_of((t or "").lower())
                if found and _key(found)[0] == node:  # rows may share an id, but not its words
                    out.append((root, node, weight,
                                minhash.shingle_set(minhash.word_hashes(found), words).tobytes()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.binary()))],
                names=["root", "node", "weight", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    sketched = cut(rows.mapInArrow(sketch, "d long, high long, low long, bands array<long>"))
    # One node per distinct word sequence, named by the first half of its key.
    nodes = cut(sketched.where("d is not null and high is not null").groupBy("high", "low")
                .agg(F.min("d").alias("doc"), F.count(F.lit(1)).alias("weight"),
                     F.min_by("bands", "d").alias("bands")).withColumnRenamed("high", "node"))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = (keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .where("least <> most").select("key", "least"))
    stars = keyed.join(shared, "key").where("node <> least").select(
        F.col("node").alias("a"), F.col("least").alias("b"))
    groups = components(stars).join(nodes.select("node", "doc", "weight"), "node")
    members = (rows.join(groups, F.col("d") == F.col("doc")).select("root", "node", "weight", "t")
               .mapInArrow(shingled, "root long, node long, weight long, shingles binary"))
    checked = cut(minhash.verify(members, threshold))
    found = components(checked.select(F.col("node").alias("a"), F.col("to").alias("b")))
    first = (found.join(nodes, "node").groupBy("root").agg(F.min("doc").alias("class_id")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    classed = (nodes.select("node", "low", "doc", "weight").join(found.join(first, "root"), "node", "left")
               .join(links, "node", "left")
               .select(F.col("node").alias("high"), "low", F.coalesce("class_id", "doc").alias("class_id"),
                       "weight", F.coalesce("links", F.lit(0)).alias("links")))
    known = F.col("d").isNotNull()
    return sketched.join(classed, ["high", "low"], "left").select(
        F.col("d").alias("doc_id"),
        F.when(known, F.coalesce("class_id", "d")).alias("class_id"),
        F.when(known, F.coalesce(F.col("weight") - 1 + F.col("links"), F.lit(0)))
        .otherwise(0).cast("long").alias("n_links"),
        F.when(known, F.coalesce("weight", F.lit(1))).otherwise(1).cast("long").alias("copies"))


def _key(words: list[str]) -> tuple[int, int]:
    """128-bit key of a word sequence as two signed longs."""
    key = xxhash.xxh3_128_intdigest(" ".join(words))
    return (key >> 64) - 2 ** 63, (key & (2 ** 64 - 1)) - 2 ** 63
