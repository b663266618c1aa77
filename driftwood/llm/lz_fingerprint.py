"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed into dictionary phrases: the longest known
phrase is extended by one byte, the extension becomes a phrase, and parsing
goes on behind it. The set of phrases is hashed, and the smallest hashes are
the signature. Two texts that compress well together share phrases, so the
share of common smallest hashes estimates the Jaccard likeness of their
phrase sets, a stand-in for compression distance that needs no pairs of
texts side by side.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.common import NO_ID, key_ranges, range_of

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MASK = (1 << 30) - 1  # phrase hashes stay small integers while parsing


class Phrases:
    """Dictionary of the phrases of a growing text."""

    def __init__(self, other: Phrases | None = None):
        self.next = dict(other.next) if other else {}  # (phrase number << 8 | byte) -> phrase number
        self.hashes = list(other.hashes) if other else [1]
        self.at = other.at if other else 0

    def feed(self, data: bytes) -> Phrases:
        known, hashes, at = self.next, self.hashes, self.at
        for byte in data:
            step = at << 8 | byte
            to = known.get(step)
            if to is None:
                known[step] = len(hashes)
                hashes.append((hashes[at] * 69069 + byte + 1) & _MASK)
                at = 0
            else:
                at = to
        self.at = at
        return self

    def signature(self, size: int) -> np.ndarray:
        """The ``size`` smallest 32-bit hashes of the phrase set, ascending.
        An unfinished phrase at the end is a known one and adds nothing."""
        h = np.array(self.hashes[1:], np.uint64)
        h *= _MIX
        h ^= h >> np.uint64(29)
        h *= _MIX
        h = np.unique((h >> np.uint64(32)).astype(np.uint32))
        return h[:size]


def as_text(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype(">u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """Estimated Jaccard likeness of two phrase sets: 1 for two empty sets,
    0 if one alone is empty; exact for sets of up to ``size`` phrases."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:size]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(np.isin(least, both, assume_unique=True)) / len(least))


def fingerprints(docs: DataFrame, size: int = 128, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every whole text (null counts as empty,
    whose fingerprint is the empty string). No shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [as_text(Phrases().feed((t or "").encode()).signature(size))
                   for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(out, pa.string())],
                                             names=["doc_id", "fingerprint"])
    return (docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
            .mapInArrow(work, "doc_id long, fingerprint string"))


def with_next(docs: DataFrame, rows_per_range: int = 4000, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``place int, d, t, lone`` ordered within partitions so that every row
    is followed by the next document in ascending id order (nulls first, equal
    ids by text; the last one by the first).

    Ids are dealt to ranges by bounds from an ids-only pass; the texts are
    shuffled once. A range's first document also goes behind the range
    before it (``lone`` true: it is there to be read, not to be answered).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("d"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    bounds, _ = key_ranges(rows.select("d"), "d", rows_per_range)
    placed = rows.withColumn("place", range_of(bounds, "d"))
    # Ranges that hold rows, and the id that each begins with: as many rows as ranges.
    heads = sorted((r["place"], r["d"]) for r in
                   rows.select("d").withColumn("place", range_of(bounds, "d")).groupBy("place")
                   .agg(F.min(F.coalesce("d", F.lit(NO_ID))).alias("d")).collect())
    # The range before each range, by its first id.
    first = np.array([d for _, d in heads], np.int64)
    before = np.roll([p for p, _ in heads], 1) if heads else np.zeros(0, np.int64)

    @F.pandas_udf(T.IntegerType())
    def echo_to(ids: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(first, ids.to_numpy()), max(0, len(first) - 1))
        return pd.Series(before[at], dtype="Int32").where(first[at] == ids.to_numpy())

    # Of several rows with the first id, the one with the smallest text.
    echo = (rows.withColumn("to", echo_to(F.coalesce("d", F.lit(NO_ID)))).where("to is not null")
            .groupBy("to").agg(F.min("t").alias("t"))
            .select(F.col("to").alias("place"), F.lit(None).cast("long").alias("d"), "t",
                    F.lit(True).alias("lone")))
    parts = max(1, len(heads))
    return (placed.select("place", "d", "t", F.lit(False).alias("lone")).unionAll(echo)
            .repartition(parts, "place")
            .sortWithinPartitions("place", "lone", F.asc_nulls_first("d"), "t"))


def edited_fingerprints(docs: DataFrame, size: int = 128, rows_per_range: int = 4000,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text and its edited text: the last half of its
    code points (rounded down) replaced by as many from the start of the next
    document, or all it has.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Null text counts as empty; a single document is
    its own next one; repeated rows follow one another; no rows give no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def answer(row: dict, text: str, sign: np.ndarray) -> tuple:
        whole, edited = row["sign"], row["text"][:row["keep"]] + text[:row["n"] - row["keep"]]
        if edited == row["text"]:
            changed = whole
        else:
            changed = row["half"].feed(edited[row["keep"]:].encode()).signature(size)
        return (row["d"], row["n"], hashlib.sha256(edited.encode()).hexdigest(), as_text(whole),
                as_text(changed), likeness(whole, changed, size), likeness(whole, sign, size))

    def parse(d, text: str) -> dict:
        keep = len(text) - len(text) // 2
        half = Phrases().feed(text[:keep].encode())
        whole = Phrases(half).feed(text[keep:].encode()).signature(size)
        return {"d": d, "text": text, "n": len(text), "keep": keep, "half": half, "sign": whole}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = place = None
        for batch in batches:
            out = []
            for p, d, text, lone in zip(*(batch.column(c).to_pylist() for c in ("place", "d", "t", "lone"))):
                row = parse(d, text)
                if last is not None and p == place:
                    out.append(answer(last, text, row["sign"]))
                last, place = (None if lone else row), p
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                      pa.string(), pa.float64(), pa.float64()))],
                names=names)

    return with_next(docs, rows_per_range, id_col, text_col).mapInArrow(
        work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
