"""Operators 11, 12 and 13 against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.llm import circulant_minhash, merkle_manifest, minhash, word_variants
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of
from test_near import jaccard_links, roots

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Operator 13

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def climb(levels, at, node):
    proof = []
    for level in levels[:-1]:
        run = level[at - at % 3:at - at % 3 + 3]
        left, right = run[:at % 3], run[at % 3 + 1:]
        proof += left + right
        node = digest(*left, node, *right)
        at //= 3
    return proof, node


def brute_manifest(rows, tampered):
    """rows: (doc_id, source, lang, n_chars, text); the checked text by ``tampered``."""
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append((r[0] is not None, r[0] or 0, leaf(*r), leaf(*r[:4], tampered(r))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: tree_of([x[2] for x in sorted(trees[s])]) for s in names}
    high = tree_of([low[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (known, d, own, checked) in enumerate(sorted(trees[s])):
            proof, sub = climb(low[s], at, checked)
            more, top = climb(high, k, sub)
            out.append((d if known else None, own, low[s][-1][0], high[-1][0], digest(*proof, *more), top,
                        top == high[-1][0]))
    return out


def even(d):
    return d is not None and zlib.crc32(str(d).encode()) % 2 == 0


def cut_breaks(r):
    return r[4].replace("\n", "") if even(r[0]) and r[4] is not None else r[4]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def key(row):
    return tuple(str(x) for x in row)


def test_manifest_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, SF_SMALL).select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(brute_manifest(rows, cut_breaks), key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_superblocks_of_any_size_give_one_manifest(spark, levels):
    """Sources of 1 to 100 rows, so that trees end at every kind of run."""
    r = random.Random(3)
    rows = [(i, s, None if i % 7 == 0 else "en", i, f"{i}\n{r.random()}") for k, (s, n) in enumerate(
        [(None, 5), ("", 1), ("a", 27), ("é", 28), ("b", 100), ("c", 9), ("Z", 3)]) for i in range(1000 * k, 1000 * k + n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    changed = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle_manifest.manifest(frame, changed, levels=levels)
    want = brute_manifest(rows, lambda x: x[4].replace("\n", "") if x[0] % 2 == 0 else x[4])
    got = found.collect()
    assert sorted((tuple(x[c] for c in COLUMNS) for x in got), key=key) == sorted(want, key=key)
    for x in got:  # the proofs themselves hold the original leaf
        node = x["leaf"]
        for a, b in zip(x["left"], x["right"]):
            node = digest(a, node, b)
        assert node == x["root"]


def test_manifest_odd_rows(spark):
    frame = docs_of(spark, ODD)
    rows = [tuple(r) for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in merkle_manifest.manifest(frame, proofs=False).select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(brute_manifest(rows, lambda r: r[4]), key=key)
    assert len(got) == len(ODD) and all(r[-1] for r in got)
    assert merkle_manifest.manifest(docs_of(spark, [])).count() == 0
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 2,
                                    "doc_id long, source string, lang string, n_chars long, text string")
    assert [r["leaf"] for r in merkle_manifest.manifest(nothing).collect()] == [digest("-----")] * 2


def test_a_change_breaks_the_proof(spark):
    frame = spark.createDataFrame([(i, f"s{i % 4}", "en", 1, "x") for i in range(200)],
                                  "doc_id long, source string, lang string, n_chars long, text string")
    changed = F.when(F.col("doc_id") == 77, F.lit("y")).otherwise(F.col("text"))
    bad = merkle_manifest.manifest(frame, changed, levels=2).where("not verified").collect()
    assert [r["doc_id"] for r in bad] == [77]


# Operator 12

def shingle_set(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_copies(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    links = [(a, b) for a, b in jaccard_links(sets, 0.5) if
             100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = roots(list(sets), links)
    return {(i, len(s), root[i], root[i] == i) for i, s in sets.items()}


def copies(frame, **kw):
    return [tuple(r) for r in circulant_minhash.near_copies(frame, **kw).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()]


def test_near_copies_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op12_circulant_minhash"](spark, SF_SMALL).collect()]
    assert len(got) == len(docs) and set(got) == brute_copies(docs)


def test_a_chain_and_a_large_group_of_copies(spark):
    """Copies of copies: the ends share too little, and no link is lost."""
    r = random.Random(9)
    base, docs = [f"b{i}" for i in range(90)], []
    for i in range(60):
        docs.append((i, " ".join(base)))
        base[r.randrange(len(base))] = f"e{i}"
    common = [f"c{i}" for i in range(80)]
    for i in range(100, 260):
        words = list(common)
        words[r.randrange(80)] = f"x{i}"
        docs.append((i, " ".join(words)))
    docs += [(300 + i, " ".join(f"u{i}x{k}" for k in range(30))) for i in range(20)]
    got = copies(docs_of(spark, docs))
    assert set(got) == brute_copies(docs)
    assert len({x[2] for x in got if x[0] < 60}) < 10


def test_signature_is_of_two_permutations():
    """A coordinate is the least image of the second permutation, shifted round by its number."""
    b = circulant_minhash.CirculantBands(4, 3)
    s = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 700, np.uint64))
    sig = b.signature(s)
    place = circulant_minhash._bijection(s, *b.first)
    for k in range(12):
        image = circulant_minhash._bijection(place - np.uint64(k + 1), *b.second)
        assert sig[k] >> np.uint64(32) == image.min() >> np.uint64(32)
    assert len(np.unique(place)) == len(s)  # nothing is mapped together


def test_signatures_agree_as_often_as_sets_overlap():
    b, agree = circulant_minhash.CirculantBands(20, 6), []
    for i in range(60):
        x = np.random.default_rng(i).integers(0, 2 ** 63, 230, np.uint64)
        agree.append((b.signature(x[:200]) == b.signature(x[30:])).mean())  # Jaccard 170 / 230
    assert abs(np.mean(agree) - 170 / 230) < 0.02
    bands, rows = minhash.bands_for(0.85, 0.9999, 128)
    assert 1 - (1 - 0.85 ** rows) ** bands >= 0.9999


def test_near_copies_odd_rows(spark):
    got = copies(docs_of(spark, ODD))
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for x in got:
        by[x[0]].append(x)
    assert by[None][0][2:] == (None, True) and by[1][0][1:] == (0, 1, True) and by[2][0][1:] == (0, 2, True)
    assert [x[2:] for x in by[4]] == [(4, True)] * 2 and by[5][0][2:] == (4, False)
    assert by[8][0][1:] == (len(shingle_set(ODD[-1][1])), 8, True)
    two = copies(docs_of(spark, [(1, "a b c d e"), (2, "a b c d e"), (2, "other words stand here"), (3, "one two"),
                                 (4, "ONE  two"), (5, "one two three")]))
    assert sorted(two) == [(1, 3, 1, True), (2, 2, 2, True), (2, 3, 1, False), (3, 1, 3, True), (4, 1, 3, False),
                           (5, 1, 5, True)]
    assert copies(docs_of(spark, [])) == []


# Operator 11

def brute_words(docs, spoil, min_letters=6):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{i}:{run}".encode())
            if spoil and i is not None and h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_letters:
                counts[run] += 1
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, min_count, ratio=5):
    held = {w: n for w, n in counts.items() if n >= min_count}
    near, gaps = defaultdict(set), defaultdict(set)
    for w in held:  # words that are one edit apart share a word with one letter left out
        for v in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            gaps[v].add(w)
    for found in gaps.values():
        for a in found:
            near[a] |= {b for b in found if b != a and one_edit(a, b)}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda x: (-held[x], x))
            if held[best] >= ratio * held[w]:
                form[w] = best
    out = set()
    for w, n in held.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), held[form[w]] if w in form else None))
    return out


def test_variants_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op11_spelling_variants"](spark, SF_SMALL).collect()]
    want = brute_variants(brute_words(docs, 199), 5)
    assert len(got) == len(want) and set(got) == want
    assert any(x[1] for x in want)


@pytest.mark.parametrize("cut_up", [dict(), dict(most_rows=40), dict(classes=2, most_letters=300), dict(classes=9)])
def test_blocks_of_any_size_give_all_near_words(spark, cut_up):
    r = random.Random(4)
    words = set()
    while len(words) < 700:
        w = "".join(r.choice("abcé") for _ in range(r.randrange(4, 8)))
        words |= {w, w[:2] + r.choice("abcéx") + w[2:], w[:3] + "z" + w[4:]}
    words |= {"y" * 3000, "y" * 2999 + "ÿ", "y" * 3001}
    counts = {w: r.randrange(5, 500) for w in words}
    frame = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    want = {(w, len(x), min(x, key=lambda v: (-counts[v], v)), max(counts[v] for v in x)) for w, x in near.items() if x}
    got = [tuple(x) for x in word_variants.near_words(frame, **cut_up).collect()]
    assert len(got) == len(want) and set(got) == want


def test_forms_are_followed_to_the_last(spark):
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg", "lkjihg"]
    frame = spark.createDataFrame([(w, 5 * 6 ** i) for i, w in enumerate(chain)], "word string, n long")
    got = {x["word"]: (x["form"], x["root"], x["n_near"]) for x in word_variants.variants(frame).collect()}
    assert all(got[w][0] == v for w, v in zip(chain, chain[1:])) and got[chain[-1]][0] is None
    assert {x[1] for x in got.values()} == {chain[-1]}


def test_words_odd_rows(spark):
    odd = ODD + [(9, "Straße STRASSE straßen ÀÉÎÕÜ× ÷ıŒ " * 6), (10, None)]
    got = {r["word"]: r["n"] for r in word_variants.word_counts(docs_of(spark, odd), spoil=3).collect()}
    assert got == brute_words(odd, 3)
    assert word_variants.spelling_variants(docs_of(spark, [])).count() == 0
    assert word_variants.spelling_variants(docs_of(spark, [(1, None), (2, ""), (3, "12 ab")])).count() == 0
    found = {tuple(x) for x in word_variants.spelling_variants(docs_of(spark, odd)).collect()}
    assert found == brute_variants(brute_words(odd, None), 5)
