"""Exact substring dedup over all documents by bucketed suffix sorting with a
difference cover.

A byte goes if a string of ``min_bytes`` bytes that covers it also starts in a
document with a smaller id. Only the order of suffixes up to that depth
matters, and only suffixes that tie with one of another document:

0. A whole text that a smaller id holds too goes as one run and takes no
   further part: whatever it has, that other document has.
1. Documents lie in blocks of ascending ids; a task holds one block.
2. Of each document the suffixes at the positions of a difference cover
   (5 of every 21) are sampled. For any two suffixes some offset below 21
   puts both on the cover, so suffixes that tie for ``min_bytes`` bytes have
   sampled suffixes that tie for ``min_bytes - 20``. Samples are sorted one
   bucket at a time over all blocks; those that tie with another document's
   are flagged. A flag may be wrong, a missing one never is.
3. The suffixes within reach of a flag, few against all, are sorted one
   bucket at a time by a hash of their first ``min_bytes`` bytes, and every
   block learns which of its own start in an earlier block too. Inside a
   block a sort settles the documents, and every tie is held byte for byte.

Buckets are ranges of hash values, not of the bytes themselves: equal strings
still fall together, which is all that is asked, and a suffix takes some seven
bytes of shuffle instead of fifty or more. Blocks compare strings by a hash
from a strongly universal family, drawn anew for every run: two different
strings, whatever they are, agree in all its bits with chance 2 ** -bits, and
there are so many bits that the chance of any wrong tie in a run stays below
2 ** -12 if every byte started a string that is sent (some eighth do, which
makes it 2 ** -18). A block sends each bucket its distinct values as a packed ascending
list and gets one bit back for each, in the same order, so a string that a
third of all documents hold costs one value a block. Blocks and buckets bound
the memory of every task.
"""

from __future__ import annotations

import functools
import hashlib
import math
import secrets
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import cut, key_ranges, range_of
from driftwood.llm.minhash import groups_of

# A perfect difference set modulo 21.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)

_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 17


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _SLICE + 4096)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _SLICE + 4096)


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending."""
    ordered = np.sort(values)
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)]]


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, ascending, the first place of each, and the number
    among them of every value."""
    order = np.argsort(values)
    ordered = values[order]
    start = np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)]
    at = np.flatnonzero(start)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(start) - 1
    return ordered[at], np.minimum.reduceat(order, at) if len(at) else order, number


def fingerprints(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit fingerprint of the ``width`` bytes from each position (ascending)."""
    out = np.empty(len(at), np.uint64)
    for lo in range(0, len(data), _SLICE):
        a, b = np.searchsorted(at, [lo, lo + _SLICE])
        if a == b:
            continue
        part = data[lo:lo + _SLICE + width].astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _UP[:len(part)], out=total[1:])
        here = at[a:b] - lo
        out[a:b] = (total[here + width] - total[here]) * _DOWN[here]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each value, one after the other."""
    wide = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 64 - width:]).tobytes()


def _from_bits(data: bytes, n: int, width: int) -> np.ndarray:
    wide = np.zeros((n, 64), np.uint8)
    if width:
        wide[:, 64 - width:] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)


def packed(values: np.ndarray) -> bytes:
    """Ascending values: low bits as they are, high bits as steps in unary,
    some two bits a value above what their number and range ask."""
    n = len(values)
    low = max(0, int(values[-1]).bit_length() - n.bit_length())
    high = (values >> np.uint64(low)).astype(np.int64)
    steps = np.zeros(n + int(high[-1]), np.uint8)
    steps[high + np.arange(n)] = 1
    return struct.pack("<IB", n, low) + _bits(values, low) + np.packbits(steps).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n, low = struct.unpack_from("<IB", data)
    middle = 5 + (n * low + 7) // 8
    steps = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=middle)))
    high = (steps - np.arange(n)).astype(np.uint64)
    return (high << np.uint64(low)) | _from_bits(data[5:middle], n, low)


class Multilinear:
    """Hashes of strings of ``width`` bytes: sums of random multiples of their
    32-bit words modulo 2 ** 64, of which the upper half is strongly universal.
    Two sums give the value (64 bits), two more up to 64 further bits."""

    def __init__(self, width: int, extra: int):
        self.width, self.extra = width, extra
        self.at = [*range(0, width - 3, 4), *([width - 4] if width % 4 else [])]
        self.times = np.array([[secrets.randbits(64) for _ in range(len(self.at) + 1)] for _ in range(4)], np.uint64)

    def _pair(self, words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        out = np.empty(len(at), np.uint64)
        (a0, *a), (b0, *b) = self.times[k], self.times[k + 1]
        for lo in range(0, len(at), 1 << 14):  # as much as a core's cache holds
            here = at[lo:lo + (1 << 14)]
            high, low = np.full(len(here), a0, np.uint64), np.full(len(here), b0, np.uint64)
            for place, x, y in zip(self.at, a, b):
                word = words[place:].take(here).astype(np.uint64)
                high += word * x
                low += word * y
            out[lo:lo + (1 << 14)] = (high & np.uint64(0xFFFFFFFF00000000)) | (low >> np.uint64(32))
        return out

    def values(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the strings at the places ``at``; ``words[i]`` is the word that starts at byte i."""
        return self._pair(words, at, 0)

    def further(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._pair(words, at, 2) >> np.uint64(64 - self.extra)


def words_at(data: np.ndarray) -> np.ndarray:
    """The 32-bit word that starts at each byte but the last three."""
    n = max(0, len(data) - 3)
    out = np.zeros(n, np.uint32)
    for k in range(min(4, n)):
        out[k::4] = np.frombuffer(data, "<u4", (n - k + 3) // 4, k)
    return out


class Block:
    """The documents of one block, one after the other by ascending id,
    without those that are whole copies."""

    def __init__(self, table: pa.Table, replies: pa.Table, min_bytes: int):
        told = replies.filter(pc.equal(replies.column("phase"), 0))
        copies = set(zip(told.column("bucket").to_pylist(), told.column("blob").to_pylist()))
        several = {d for d, _ in copies}
        is_copy = pa.array([d in several and (d, hashlib.sha256(t.as_py().encode()).digest()) in copies
                            for d, t in zip(table.column("d").to_pylist(), table.column("t"))], pa.bool_())
        self.copies = table.filter(is_copy)
        table = table.filter(pc.invert(is_copy))
        rows = sorted(zip(table.column("d").to_pylist(), (t.as_py().encode() for t in table.column("t"))),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        self.ids, raw = [d for d, _ in rows], [b for _, b in rows]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(b) for b in raw], np.int64)
        self.edge = np.concatenate([[0], np.cumsum(size)])
        self.min_bytes, self.depth = min_bytes, min_bytes - PERIOD + 1
        # Rows with one id are one document; null ids are not compared.
        rank = np.cumsum([0] + [a != b for a, b in zip(self.ids, self.ids[1:])]).astype(np.int32)[:len(rows)]
        self.doc = np.repeat(rank, size)
        self.room = np.repeat(np.where([i is None for i in self.ids], 0, self.edge[1:]), size) - np.arange(len(self.data))
        self.local = np.arange(len(self.data)) - np.repeat(self.edge[:-1], size)

    @functools.cached_property
    def words(self) -> np.ndarray:
        return words_at(self.data)

    def _several(self, at: np.ndarray, first: np.ndarray, number: np.ndarray):
        """First document of each distinct string, and whether a second has it."""
        lead = self.doc[at[first]] if len(at) else np.zeros(0, np.int32)
        several = np.zeros(len(first), bool)
        several[number[self.doc[at] != lead[number]]] = True
        return lead, several

    def _named(self, at: np.ndarray, family: Multilinear):
        """Distinct strings of ``min_bytes`` bytes, held byte for byte: hash
        values, ascending, places in ``at`` of the first of each, and each
        position's number among them."""
        value, first, number = numbered(family.values(self.words, at))
        if not len(at):
            return value, first, number
        lead = at[first][number]

        def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.ones(len(a), bool)
            for k in family.at:
                out &= self.words[k:].take(a) == self.words[k:].take(b)
            return out

        # Where a position and its leader both follow those before them, the last byte settles it.
        head = np.r_[True, (np.diff(at) != 1) | (np.diff(lead) != 1)]
        last = self.data[self.min_bytes - 1:]
        if (last.take(at) == last.take(lead)).all() and same(at[head], lead[head]).all():
            return value, first, number
        more: dict[bytes, int] = {}
        new = []
        for i in np.flatnonzero(~same(at, lead)).tolist():
            text = self.data[at[i]:at[i] + self.min_bytes].tobytes()
            if text not in more:
                more[text] = len(first) + len(more)
                new.append(i)
            number[i] = more[text]
        first = np.r_[first, np.array(new, first.dtype)]
        value = family.values(self.words, at[first])
        order = np.argsort(value, kind="stable")
        rank = np.empty(len(order), number.dtype)
        rank[order] = np.arange(len(order))
        return value[order], first[order], rank[number]

    def marks(self, bits: int) -> np.ndarray:
        """Fingerprints of the sampled suffixes."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        self.sampled = np.nonzero(cover[self.local % PERIOD] & (self.room >= self.depth))[0]
        return fingerprints(self.data, self.sampled, self.depth) >> np.uint64(64 - bits)

    def samples(self, bits: int):
        value, first, number = numbered(self.marks(bits))
        return value, number, self._several(self.sampled, first, number)[1]

    def candidates(self, samples, told: np.ndarray, family: Multilinear, further: bool):
        """Name the suffixes with a flagged sample at an offset below the
        period. Hash values, ascending, and further bits of those distinct
        ones of which other blocks have a sample too."""
        _, number, several = samples
        self.suffixes = np.nonzero(self._reaching((several | told)[number]))[0]
        value, first, self.number = self._named(self.suffixes, family)
        self.lead, _ = self._several(self.suffixes, first, self.number)
        # Other blocks need those alone whose samples they have too.
        self.shared = np.zeros(len(first), bool)
        self.shared[self.number[self._reaching(told[number])[self.suffixes]]] = True
        rest = family.further(self.words, self.suffixes[first[self.shared]]) if further else None
        return value[self.shared], rest

    def _reaching(self, flagged: np.ndarray) -> np.ndarray:
        """Whether a full-length suffix has one of the flagged samples in reach."""
        n = len(self.data)
        mark = np.zeros(n + PERIOD, np.int32)
        mark[self.sampled[flagged]] = 1
        total = np.concatenate([[0], np.cumsum(mark)])  # samples before each position
        return (total[PERIOD:PERIOD + n] > total[:n]) & (self.room >= self.min_bytes)

    def covered(self, told: np.ndarray) -> np.ndarray:
        """Whether each byte goes; ``told``: whether an earlier block has each shared suffix."""
        earlier = np.zeros(len(self.lead), bool)
        earlier[self.shared] = told
        mark = np.zeros(len(self.data) + self.min_bytes, np.int32)
        mark[self.suffixes[earlier[self.number] | (self.doc[self.suffixes] > self.lead[self.number])] + self.min_bytes] = 1
        total = np.cumsum(mark)
        n = len(self.data)
        # total[i + m] counts the strings that start at i or before.
        return (total[self.min_bytes:self.min_bytes + n] - total[:n]) > 0


def _split(block: int, phase: int, value: np.ndarray, bits: int, bucket_bits: int,
           rest: np.ndarray | None = None, extra: int = 0) -> pa.Table:
    """A row per bucket that holds any of the values (and their further bits)."""
    bucket = (value >> np.uint64(bits - bucket_bits)).astype(np.int64)
    names, start = np.unique(bucket, return_index=True)
    low = value & np.uint64((1 << (bits - bucket_bits)) - 1)
    blobs = [packed(p) for p in np.split(low, start[1:])] if len(names) else []
    more = [_bits(p, extra) for p in np.split(rest, start[1:])] if extra and len(names) else [b""] * len(names)
    return pa.table({"phase": pa.array([phase] * len(names), pa.int32()), "bucket": pa.array(names),
                     "block": pa.array([block] * len(names), pa.int32()), "blob": pa.array(blobs, pa.binary()),
                     "more": pa.array(more, pa.binary())})


def _told(replies: pa.Table, phase: int, value: np.ndarray, bits: int, bucket_bits: int) -> np.ndarray:
    """One flag per value from the buckets' replies."""
    out = np.zeros(len(value), bool)
    bucket = (value >> np.uint64(bits - bucket_bits)).astype(np.int64)
    for p, b, flags in zip(*(replies.column(c).to_pylist() for c in ("phase", "bucket", "blob"))):
        if p == phase:
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            out[lo:hi] = np.unpackbits(np.frombuffer(flags, np.uint8), count=hi - lo).astype(bool)
    return out


def _answer(batches: Iterator[pa.RecordBatch], extra: int) -> Iterator[pa.RecordBatch]:
    """Sort one bucket at a time. Phase 1 flags values of several blocks,
    phase 2 values (with their further bits) that an earlier block has."""
    for (phase, bucket), rows in groups_of(batches, 2):
        rows.sort(key=lambda r: r[2])
        parts = [unpacked(r[3]) for r in rows]
        size = [len(p) for p in parts]
        value = np.concatenate(parts)
        order = np.argsort(value, kind="stable")  # equal values stay in block order
        ordered = value[order]
        start = np.r_[True, ordered[1:] != ordered[:-1]]
        if phase == 2:
            rest = np.concatenate([_from_bits(r[4], n, extra) for r, n in zip(rows, size)])
            other = np.r_[True, np.diff(rest[order].view(np.int64)) != 0]
            if (other & ~start).any():
                order = np.lexsort((rest, value))
                ordered, other = value[order], np.r_[True, np.diff(rest[order].view(np.int64)) != 0]
                start = np.r_[True, ordered[1:] != ordered[:-1]]
            start |= other
        flag = np.empty(len(value), bool)
        if phase == 1:
            flag[order] = ~start | np.r_[~start[1:], False]
        else:
            flag[order] = ~start
        edges = np.cumsum([0, *size])
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[2] for r in rows], pa.int32()), pa.array([phase] * len(rows), pa.int32()),
             pa.array([bucket] * len(rows), pa.int64()),
             pa.array([np.packbits(flag[a:b]).tobytes() for a, b in zip(edges, edges[1:])], pa.binary())],
            names=["block", "phase", "bucket", "blob"])


def dedup_substrings(docs: DataFrame, min_bytes: int = 50, rows_per_block: int = 1500,
                     bucket_bytes: int = 16_000_000, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Remove bytes covered by strings of ``min_bytes`` bytes that also start
    in a document with a smaller id. Matches never cross documents and are
    judged on the input.

    Returns one row per input row: ``doc_id, n_bytes, spans
    array<struct<start,length>>`` (maximal removed runs, in bytes) and ``kept
    binary``. Null text counts as empty. Rows that share an id are one
    document and do not take from each other; rows with a null id are
    returned whole and take from none.
    """
    if min_bytes < 2 * PERIOD:
        raise ValueError("the cover leaves too short a sample for this length")
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    bounds, _ = key_ranges(rows.select("d"), "d", rows_per_block)
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    bucket_bits = max(1, math.ceil(math.log2(max(2, total / bucket_bytes))))
    # So many bits of a sample's fingerprint that about one in 5,000 is flagged by chance.
    bits = min(64, max(24, bucket_bits + 8, math.ceil(math.log2(total + 2)) + 10))
    # So many bits between blocks that total ** 2 / 2 pairs hold a wrong tie in less than one of 2 ** 12 runs.
    extra = min(64, max(4, math.ceil(2 * math.log2(total + 2)) - 1 + 12 - 64))
    family = Multilinear(min_bytes, extra)
    blocks = rows.withColumn("block", range_of(bounds, "d")).select("block", "d", "t")
    sent = "phase int, bucket long, block int, blob binary, more binary"
    back = "block int, phase int, bucket long, blob binary"

    def sample(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return _split(0, 1, np.zeros(0, np.uint64), bits, bucket_bits)
        block = Block(table, replies, min_bytes)
        return _split(table.column("block")[0].as_py(), 1, distinct(block.marks(bits)), bits, bucket_bits)

    def candidates(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return _split(0, 2, np.zeros(0, np.uint64), 64, bucket_bits)
        block = Block(table, replies, min_bytes)
        s = block.samples(bits)
        value, rest = block.candidates(s, _told(replies, 1, s[0], bits, bucket_bits), family, True)
        return _split(table.column("block")[0].as_py(), 2, value, 64, bucket_bits, rest, extra)

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        if not len(table):
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()),
                             "spans": pa.array([], kind), "kept": pa.array([], pa.binary())})
        block = Block(table, replies, min_bytes)
        s = block.samples(bits)
        value, _ = block.candidates(s, _told(replies, 1, s[0], bits, bucket_bits), family, False)
        gone = block.covered(_told(replies, 2, value, 64, bucket_bits))
        spans, kept = [], []
        for a, b in zip(block.edge, block.edge[1:]):
            part = gone[a:b]
            turn = np.nonzero(np.diff(np.concatenate([[False], part, [False]])))[0]
            spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(turn[::2], turn[1::2])])
            kept.append(block.data[a:b][~part].tobytes())
        ids, n_bytes = list(block.ids), np.diff(block.edge).tolist()
        for d, t in zip(block.copies.column("d").to_pylist(), block.copies.column("t").to_pylist()):
            raw = t.encode()
            long = len(raw) >= min_bytes
            ids.append(d)
            n_bytes.append(len(raw))
            spans.append([{"start": 0, "length": len(raw)}] if long else [])
            kept.append(b"" if long else raw)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()),
                         "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})

    def sorted_buckets(values: DataFrame) -> DataFrame:
        return (values.repartition("phase", "bucket").sortWithinPartitions("phase", "bucket")
                .mapInArrow(lambda batches: _answer(batches, extra), back))

    # Whole copies (id and hash of the text), told to their blocks like the buckets' replies.
    keyed = rows.where("d is not null").select("d", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("key"))
    first = keyed.groupBy("key").agg(F.min("d").alias("first"), F.max("d").alias("last")).where("first < last")
    copies = (keyed.join(first, "key").where("d > first").select("d", "key").distinct()
              .select(range_of(bounds, "d").alias("block"), F.lit(0).alias("phase"), F.col("d").alias("bucket"),
                      F.col("key").alias("blob")))
    copies = cut(copies)
    # The three passes over the blocks share one exchange of the texts.
    flags = sorted_buckets(blocks.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(sample, sent))
    flags = flags.unionAll(copies)
    found = sorted_buckets(blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(candidates, sent))
    return blocks.groupBy("block").cogroup(flags.unionAll(found).groupBy("block")).applyInArrow(
        remove, "doc_id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary")
