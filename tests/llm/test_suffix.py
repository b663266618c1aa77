"""Operator 3 against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from driftwood.llm import suffix_dedup
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of


def brute(docs, m=50):
    """(doc_id, bytes, spans, kept) per row; rows with one id are one document."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in raw:
        if i is not None:
            for p in range(len(b) - m + 1):
                w = b[p:p + m]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for p in range(len(b) - m + 1):
                if first[b[p:p + m]] < i:
                    gone[p:p + m] = True
        turn = np.nonzero(np.diff(np.concatenate([[0], gone, [0]])))[0]
        out.append((i, len(b), tuple((int(a), int(z - a)) for a, z in zip(turn[::2], turn[1::2])),
                    np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["length"]) for s in r["spans"]), bytes(r["kept"]))
                   for r in frame.collect()), key=str)


def test_cover_meets_every_offset():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_packing_of_values():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        for top in (1, 3, 2 ** 20, 2 ** 64 - 1):
            v = np.sort(rng.integers(0, top, n, np.uint64, endpoint=True))
            assert (suffix_dedup.unpacked(suffix_dedup.packed(v)) == v).all()
            assert (suffix_dedup._from_bits(suffix_dedup._bits(v, 13), n, 13) == v % 2 ** 13).all()
    assert suffix_dedup.unpacked(suffix_dedup.packed(np.zeros(3, np.uint64))).tolist() == [0, 0, 0]


def test_multilinear_tells_strings_apart():
    r = random.Random(2)
    data = np.frombuffer(r.randbytes(5_000) * 2, np.uint8)
    at = np.arange(len(data) - 50)
    for width in (50, 52):
        family = suffix_dedup.Multilinear(width, 14)
        here = at[:len(data) - width + 1]
        words = suffix_dedup.words_at(data)
        assert words[7] == int.from_bytes(data[7:11].tobytes(), "little") and len(words) == len(data) - 3
        value, rest = family.values(words, here), family.further(words, here)
        assert rest.max() < 2 ** 14
        texts = [data[p:p + width].tobytes() for p in here]
        assert len(set(zip(value.tolist(), rest.tolist()))) == len(set(texts)) == len(set(zip(texts, value.tolist())))


def test_names_hold_under_a_poor_hash():
    """Even where all hashes agree, or all but a bit, equal numbers mean equal strings."""
    class Poor(suffix_dedup.Multilinear):
        def values(self, words, at):
            return super().values(words, at) >> np.uint64(self.shift)

    r = random.Random(3)
    part = "".join(r.choice("ab") for _ in range(90))
    table = pa.table({"d": [1, 2, 3], "t": [part, "x" + part * 2, part[3:80] + "yy" + part]})
    replies = pa.table({"phase": pa.array([], pa.int32()), "bucket": pa.array([], pa.int64()),
                        "blob": pa.array([], pa.binary())})
    block = suffix_dedup.Block(table, replies, 50)
    at = np.flatnonzero(block.room >= 50)
    texts = [block.data[p:p + 50].tobytes() for p in at]
    for shift in (63, 62, 0):
        family = Poor(50, 8)
        family.shift = shift
        value, first, number = block._named(at, family)
        assert (np.diff(value.astype(object)) >= 0).all() and len(first) == len(set(texts))
        assert [texts[i] for i in first[number]] == texts
        assert all(texts.index(texts[i]) == i for i in first)


def test_values_are_numbered_like_unique():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 4000):
        values = r.integers(0, 900, n, dtype=np.uint64) << np.uint64(50)
        want = np.unique(values, return_index=True, return_inverse=True)
        assert all((a == b).all() for a, b in zip(want, suffix_dedup.numbered(values)))
        assert (suffix_dedup.distinct(values) == want[0]).all()


def test_sampling_makes_no_words():
    table = pa.table({"d": [1, 2], "t": ["ab" * 60, "cd" * 70]})
    replies = pa.table({"phase": pa.array([], pa.int32()), "bucket": pa.array([], pa.int64()),
                        "blob": pa.array([], pa.binary())})
    block = suffix_dedup.Block(table, replies, 50)
    marks = block.marks(40)
    assert "words" not in vars(block)
    assert (suffix_dedup.distinct(marks) == block.samples(40)[0]).all() and len(block.words) == 257


#: Two texts without a common string of 50 bytes, but of one 64-bit polynomial fingerprint.
ALIKE = ("fbadadbbadbaaakkkkkkkkkkkkkkkkkkkkkkkkkkkkkkdccbba", "aadabaaaaaaaackkkkkkkkkkkkkkkkkkkkkkkkkkkkkkaaaaab")


def test_equal_fingerprints_of_different_strings(spark):
    a, b = (np.frombuffer(t.encode(), np.uint8) for t in ALIKE)
    zero = np.zeros(1, np.int64)
    assert suffix_dedup.fingerprints(a, zero, 50) == suffix_dedup.fingerprints(b, zero, 50)
    docs = [(1, ALIKE[0]), (2, ALIKE[1]), (3, "x" + ALIKE[1]), (4, ALIKE[0] + ALIKE[1]), (5, None)]
    for rows_per_block in (1, 2, 100):
        got = suffix_dedup.dedup_substrings(docs_of(spark, docs), rows_per_block=rows_per_block)
        assert rows_of(got) == brute(docs)


def test_several_texts_under_one_id(spark):
    words = " ".join(f"word{i}" for i in range(30))
    other = " ".join(f"term{i}" for i in range(30))
    docs = [(3, words), (7, words), (7, other), (9, other + words), (9, words)]
    for rows_per_block in (1, 100):
        got = suffix_dedup.dedup_substrings(docs_of(spark, docs), rows_per_block=rows_per_block)
        assert rows_of(got) == brute(docs)


def test_fingerprints_over_slices():
    data = np.frombuffer(random.Random(1).randbytes(300_000) * 2, np.uint8)
    at = np.arange(0, len(data) - 50, 7)
    f = suffix_dedup.fingerprints(data, at, 50)
    seen = {}
    for p, x in zip(at.tolist(), f.tolist()):
        assert seen.setdefault(x, data[p:p + 50].tobytes()) == data[p:p + 50].tobytes()


def test_against_brute_force_over_blocks(spark):
    r = random.Random(5)
    shared = ["".join(r.choice("abcdé ") for _ in range(r.randrange(40, 70))) for _ in range(12)]
    docs = [(3 * i - 50, "".join(r.choice(shared) if r.random() < 0.5 else
                                 "".join(r.choice("abcdé ") for _ in range(r.randrange(60))) for _ in range(6)))
            for i in range(120)]
    docs += [(900 + i, "ab" * 40) for i in range(30)]
    r.shuffle(docs)
    for rows_per_block in (7, 1000):
        got = suffix_dedup.dedup_substrings(docs_of(spark, docs), rows_per_block=rows_per_block, bucket_bytes=2_000)
        assert rows_of(got) == brute(docs)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in QUERIES["op3_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == {(i, n, sum(z for _, z in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute(docs)}


def test_odd_rows(spark):
    assert rows_of(suffix_dedup.dedup_substrings(docs_of(spark, ODD), rows_per_block=2)) == brute(ODD)
    assert suffix_dedup.dedup_substrings(docs_of(spark, [])).count() == 0
    nothing = [(1, None), (2, "")]
    assert rows_of(suffix_dedup.dedup_substrings(docs_of(spark, nothing))) == brute(nothing)
    with pytest.raises(ValueError):
        suffix_dedup.dedup_substrings(docs_of(spark, []), min_bytes=20)
