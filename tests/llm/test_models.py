"""Operators 4, 8 and 10 against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from driftwood.llm import lattice_lm, lz_fingerprint, voronoi_knn
from driftwood.llm.common import crc_of_id
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of


def best(rows, k=10, every=100):
    out = []
    for q, v in rows:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_query(spark):
    rows = [(r["vec_id"], [math.floor(1024 * float(x)) for x in r["embedding"]])
            for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op4_voronoi_top_k"](spark, SF_SMALL).collect()
    assert sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in got) == best(rows)


def test_top_k_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(0, 1 + 9 * (i % 3 == 0), 4).round(3).tolist()) for i in range(160)]
    good += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # ties
    good += [(300, [1e6, -1e6, 3.0, 0.25]), (301, [2.0, 1.0]), (302, [1.0, 1.0]), (400, [9.0, 9.0, 1.0])]
    bad = [(500, None), (501, []), (600, [1.0, None, 1.0, 1.0]), (700, [1.0, float("nan"), 1.0, 1.0]),
           (800, [1.0, float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in good + good[:5] + bad],
                                  "vec_id long, embedding array<double>, cell string")
    want = best([(i, [math.floor(1024 * x) for x in v]) for i, v in good])
    quantised = voronoi_knn.quantised(frame)
    for pivots, block, task in ((32, 512, 20_000), (5, 1, 20), (1, 2, 1000)):
        got = voronoi_knn.top_k(quantised, pivots=pivots, queries_per_block=block, rows_per_task=task).collect()
        assert sorted(map(tuple, got)) == want
    assert voronoi_knn.top_k(quantised.limit(0)).count() == 0
    assert voronoi_knn.top_k(quantised.where("vec_id = 200")).count() == 0  # alone
    assert voronoi_knn.top_k(quantised.where("vec_id = 201")).count() == 0  # no query


def phrases(data):
    """The dictionary of a text, phrase by phrase."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


def sketch(text, size=128):
    return lz_fingerprint.Phrases().feed(text.encode()).signature(size)


def test_phrases_are_the_dictionary():
    for _, t in ODD[:8] + [(0, "abracadabra" * 9)]:
        data = (t or "").encode()
        grown = lz_fingerprint.Phrases().feed(data[:7])
        grown = lz_fingerprint.Phrases(grown).feed(data[7:])
        assert len(grown.hashes) - 1 == len(phrases(data))
    a, b = phrases(b"the cat sat on the mat " * 3), phrases(b"the cat sat on the hat " * 3)
    near = lz_fingerprint.likeness(sketch("the cat sat on the mat " * 3), sketch("the cat sat on the hat " * 3), 128)
    assert near == len(a & b) / len(a | b)  # both fit the signature


def edited(docs, size=128):
    out = []
    docs = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for k, (i, t) in enumerate(docs):
        t, after = t or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + after[:half]
        s, u, v = sketch(t), sketch(e), sketch(after)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), lz_fingerprint.as_text(s),
                    lz_fingerprint.as_text(u), lz_fingerprint.likeness(s, u, size), lz_fingerprint.likeness(s, v, size)))
    return sorted(out, key=str)


def test_edited_fingerprints(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op8_lz_fingerprint"](spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == edited(docs)
    assert sum(r[5] > r[6] for r in got) > 0.97 * len(got)
    for rows in (1, 3, 1000):
        found = lz_fingerprint.edited_fingerprints(docs_of(spark, ODD), rows_per_range=rows).collect()
        assert sorted(map(tuple, found), key=str) == edited(ODD)
    assert lz_fingerprint.edited_fingerprints(docs_of(spark, [])).count() == 0
    one = lz_fingerprint.edited_fingerprints(docs_of(spark, [(5, "abcd")])).collect()
    assert [tuple(r) for r in one] == edited([(5, "abcd")])


def test_forward_recursion_adds_up_all_segmentations():
    v = lattice_lm.Vocabulary(P.path("piece_bpe_32k.model"))
    assert abs(v.first[v.opens].sum() - 1) < 1e-9 and abs(v.first[~v.opens].sum() - 1) < 1e-9
    lattice = lattice_lm.Lattice(v, v.first)
    for word in ("thing", "a", "été", "x9", "日"):
        s, total = lattice_lm.MARK + word, 0.0
        for n in range(len(s)):
            for cuts in combinations(range(1, len(s)), n):
                p = 1.0
                for a, b in zip((0, *cuts), (*cuts, len(s))):
                    ways = v.first[v.pieces[s[a:b]]] if s[a:b] in v.pieces else 0.0
                    if a and b == a + 1:
                        ways += math.prod(v.first[v.bytes[x]] for x in s[a:b].encode())
                    p *= ways
                total += p
        assert math.isclose(lattice.log_probability(word.encode()), math.log(total * v.first[v.end]), rel_tol=1e-9)
        counts = np.zeros(len(v.first))
        lattice.expect(word.encode(), counts)
        spelt = {i: p for p, i in v.pieces.items()}
        assert math.isclose(sum(c * len(spelt[i]) for i, c in enumerate(counts) if i in spelt)
                            + sum(counts[i] for i in set(v.bytes)) / len(word[-1].encode()), len(s), rel_tol=1e-6) \
            or any(len(c.encode()) > 1 for c in word)


def test_words_side_by_side_and_one_by_one_agree():
    v = lattice_lm.Vocabulary(P.path("piece_bpe_32k.model"))
    lattice = lattice_lm.Lattice(v, v.first)
    words = [w.encode() for w in "a thing things running été 日本語 x9 ... naïve a\x00b été 🙂🙂".split()] + [b"long" * 40]
    got = lattice.log_probabilities(words)
    assert np.allclose(got, [lattice.log_probability(w) for w in words], rtol=1e-10)
    together, single = np.zeros(len(v.first)), np.zeros(len(v.first))
    lattice.expect_all(words, together)
    for w in words:
        lattice.expect(w, single)
    assert np.allclose(together, single, rtol=1e-8, atol=1e-12)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def check_scores(rows, docs):
    def crc(i):
        return None if i is None else zlib.crc32(str(i).encode()) % 10
    c = Counter()
    for i, t in docs:
        if crc(i) not in (0, None):
            c.update([*tokens(t), None])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in docs:
        found = [*tokens(t), None]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in found)
        want[i, crc(i) == 0, len(found), sum(c[x] > 0 for x in found), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in rows) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_lattice_scores(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = QUERIES["op10_lattice_lm"](spark, SF_SMALL).collect()
    check_scores(rows, docs)


def test_lattice_odd_rows(spark):
    def scored(pairs):
        docs = docs_of(spark, pairs).withColumns({"held_out": crc_of_id("doc_id") % 10 == 0,
                                                  "training": crc_of_id("doc_id") % 10 != 0})
        return lattice_lm.score(docs, P.path("piece_bpe_32k.model"), rounds=1, chars_per_block=500).collect()
    odd = ODD + [(i, f"Word{i} the a\x1cb\x85c d " * 3) for i in range(20, 50)]
    check_scores(scored(odd), odd)
    assert scored([]) == []
    untaught = [(None, "nothing learnt")]
    assert scored(untaught)[0]["train_tokens"] == 0


def test_words_and_end_share_one_probability(spark):
    """Known words, new words and the end: their masses add up to one."""
    docs = docs_of(spark, [(i, "aa bb aa cc dd dd") for i in range(3)]).withColumns(
        {"held_out": F.lit(False), "training": F.col("doc_id") < 2})
    rows = {r["doc_id"]: r["score"] for r in lattice_lm.score(docs, P.path("piece_bpe_32k.model")).collect()}
    assert rows[0] == rows[1] == rows[2]
    assert rows[0] > 6 * math.log10(1 / 14) + math.log10(2 / 14) - 6
