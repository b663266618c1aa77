"""Operators 2, 7 and 9 and their helpers, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import regex
from pyspark.sql import functions as F

from driftwood.llm import line_dedup, minhash, near_documents, paragraphs
from driftwood.llm.common import components
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def jaccard_links(sets, threshold=0.8):
    """Pairs of keys whose sets reach the threshold, through an inverted index."""
    where, common = defaultdict(list), Counter()
    for k, s in sets.items():
        for x in s:
            where[x].append(k)
    for keys in where.values():
        common.update((a, b) for i, a in enumerate(keys) for b in keys[i + 1:])
    return [(a, b) for (a, b), c in common.items()
            if c * (1 + threshold) >= threshold * (len(sets[a]) + len(sets[b])) - 1e-9]


def shingles(words, k=5):
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def small(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())


def test_components(spark):
    r = random.Random(2)
    for n, m in ((60, 40), (200, 150), (30, 200)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
        edges += [(1000 + i, 1001 + i) for i in range(40)]  # a path
        want = roots({x for e in edges if e[0] != e[1] for x in e}, edges)
        got = components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {x["node"]: x["root"] for x in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_reach_the_recall():
    for threshold, recall, most in ((0.8, 0.9999, 128), (0.8, 0.99, 12), (0.5, 0.95, 200)):
        b, r = minhash.bands_for(threshold, recall, most)
        assert b * r <= most and 1 - (1 - threshold ** r) ** b >= recall
    hashes = minhash.word_hashes([f"w{i}" for i in range(400)])
    banding, hits = minhash.Banding(5, 2), 0
    for i in range(300):
        a, b = hashes[i % 100:i % 100 + 90], hashes[i % 100 + 10:i % 100 + 100]  # Jaccard 0.8
        rng = np.random.default_rng(i)
        a, b = np.unique(a ^ rng.integers(0, 2 ** 63, 1, np.uint64)), np.unique(b ^ np.random.default_rng(i).integers(0, 2 ** 63, 1, np.uint64))
        hits += bool((banding.keys(a, np.zeros(1, int)) == banding.keys(b, np.zeros(1, int))).any())
    assert hits >= 290


def test_near_documents_against_brute_force(spark):
    docs = small(spark)
    sets = {i: shingles(re.findall(r"\w+", t.lower())) for i, t in docs}
    links = jaccard_links(sets)
    count = Counter(x for e in links for x in e)
    root = roots([i for i, _ in docs], links)
    got = QUERIES["op9_ngram_jaccard_join"](spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == {(i, root[i], count[i]) for i, _ in docs}


def test_large_groups_are_compared_in_blocks(spark):
    r = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(90):  # one chain of near copies, so that not all pairs are linked
        for _ in range(2 if i % 3 == 0 else 0):
            base[r.randrange(len(base))] = f"e{i}{r.random()}"
        texts.append((i, " ".join(base)))
    sets = {i: shingles(t.lower().replace(".", " ").split()) for i, t in texts}
    frame = docs_of(spark, texts)
    links = jaccard_links({i: shingles(re.findall(r"\w+", t)) for i, t in texts})
    members = [(0, i, 1, np.unique(np.array([hash(x) & (2 ** 62 - 1) for x in s], np.uint64)).tobytes())
               for i, s in sets.items()]
    out = minhash.verify(spark.createDataFrame(members, "root long, node long, weight long, shingles binary"),
                         0.8, block_rows=7)
    want = Counter(x for e in jaccard_links(sets) for x in e)
    assert {x["node"]: x["n"] for x in out.groupBy("node").agg(F.sum("links").alias("n")).collect()} == want
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in near_documents.near_documents(frame).collect()}
    root, count = roots(range(90), links), Counter(x for e in links for x in e)
    assert got == {i: (root[i], count[i]) for i in range(90)}


def test_near_documents_odd_rows(spark):
    got = near_documents.near_documents(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["class_id"] is None and by[None]["n_links"] == 0
    assert all(by[i]["class_id"] == i and by[i]["n_links"] == 0 for i in (1, 2, 3, 6, 8))
    assert by[5]["class_id"] == by[4]["class_id"] == 4 and by[5]["n_links"] == by[4]["n_links"] == 2
    assert near_documents.near_documents(docs_of(spark, [])).count() == 0
    assert near_documents.near_documents(docs_of(spark, [(1, None), (2, "")])).count() == 2


def test_paragraphs_cover_a_text():
    for _, t in ODD + [(0, "One. Two!\n\nThree four? five\n"), (0, "x " * 500), (0, "\n\n a.")]:
        found = paragraphs.paragraphs_of(t or "")
        assert "".join((t or "")[a:b] for a, b, _ in found) == (t or "")
        for a, b, words in found:
            assert words == re.findall(r"\w+", t[a:b].lower())


def contexts(text, words, places, start, end):
    """Words before (nearest first) and behind a unit, with their places, as
    far as the second paragraph's end."""
    hashes = minhash.word_hashes(words)
    cuts = [0, *(n for n, _ in paragraphs.cuts_of(text, hashes, places)), len(words)]
    first = sum(a < start for a, _ in places)
    last = sum(a < end for a, _ in places)
    low = cuts[max(0, sum(c < first for c in cuts) - 2)]
    high = cuts[min(len(cuts) - 1, sum(c <= last for c in cuts) + 1)]
    return ([(words[i], places[i][0]) for i in range(first - 1, low - 1, -1)],
            [(words[i], places[i][1]) for i in range(last, high)])


def paragraph_removals(docs):
    """Spans that go, per document, and the documents that keep their text:
    units (paragraphs among paragraphs, lines among lines) that are linked to
    an earlier one, made longer by the words that both have beside them."""
    held, parsed = defaultdict(list), {}
    for i, t in docs:
        words, places = paragraphs.spans_of(t)
        parsed[i] = (t, words, places)
        for a, b, first, upto, apart in paragraphs.units_of(t)[1]:
            if upto - first >= 8:
                held[apart, tuple(words[first:upto])].append((i, a, b))
    groups = defaultdict(set)
    for kind in (0, 1):
        sets = {k: shingles(k[1]) for k in held if k[0] == kind}
        root = roots(sets, jaccard_links(sets))
        for k in sets:
            groups[root[k]].update(held[k])
    spans, kept_in = defaultdict(list), defaultdict(set)
    for group in groups.values():
        ends = {}
        for i, a, b in group:
            ends[i, a] = max(b, ends.get((i, a), 0))
        units = sorted(ends)
        beside = {u: contexts(*parsed[u[0]], u[1], ends[u]) for u in units}
        for n, u in enumerate(units[1:], 1):
            low, high = u[1], ends[u]
            for v in units[:n]:
                for side in (0, 1):
                    for (x, at), (y, _) in zip(beside[u][side], beside[v][side]):
                        if x != y:
                            break
                        low, high = (min(low, at), high) if side == 0 else (low, max(high, at))
            spans[u[0]].append((low, high))
            kept_in[u[0]].add(units[0][0])
    merged = {}
    for i, found in spans.items():
        out = []
        for a, b in sorted(found):
            if out and a <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        merged[i] = [tuple(x) for x in out]
    return merged, kept_in


def without_spans(text, spans):
    at = [0, *(x for s in spans for x in s), len(text)]
    return "".join(text[a:b] for a, b in zip(at[::2], at[1::2]))


def test_paragraph_dedup_against_brute_force(spark):
    docs = small(spark)
    gone, kept_in = paragraph_removals(docs)
    got = QUERIES["op7_paragraph_dedup"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in got if r["spans"]} == gone
    for r in got:
        assert set(r["kept_in"] or []) == kept_in[r["doc_id"]]
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = paragraphs.removals(paragraphs.near_paragraphs(frame))
    text = dict(docs)
    for r in paragraphs.without(frame, found).collect():
        assert r["text"] == without_spans(text[r["doc_id"]], gone.get(r["doc_id"], []))


def test_a_passage_inside_other_texts_is_found(spark):
    r = random.Random(8)

    def prose(n):
        return " ".join(f"w{r.randrange(10 ** 6)}" + ("." if r.random() < 0.1 else "") for _ in range(n))
    passage = prose(70)
    flat = " ".join(f"u{r.randrange(10 ** 6)}" for _ in range(80))  # no sentence ends
    docs = [(i, f"{prose(60)} {passage} {prose(40)}\n{prose(30)} {flat} {prose(30)}") for i in range(3)]
    docs += [(9, prose(300))]
    found = {x["doc_id"]: x for x in paragraphs.removals(paragraphs.near_paragraphs(docs_of(spark, docs))).collect()}
    assert set(found) == {1, 2} and all(x["kept_in"] == [0] for x in found.values())


def test_paragraphs_odd_rows(spark):
    odd = docs_of(spark, ODD)
    found = paragraphs.near_paragraphs(odd)
    assert {(x["doc_id"], x["keep"], x["keep_doc"]) for x in found.collect() if x["doc_id"] != 8} == {
        (4, True, 4), (5, False, 4)}
    out = paragraphs.without(odd, paragraphs.removals(found))
    assert out.columns == odd.columns
    text = {(x["doc_id"], x["text"]) for x in out.collect() if x["doc_id"] != 8}  # which repeats itself
    assert text == {(i, "" if i == 5 else t) for i, t in ODD if i != 8}
    assert paragraphs.near_paragraphs(docs_of(spark, [])).count() == 0


PLAIN = regex.compile(r"[^\p{L}\p{N}]+")




def shared_blocks(x, blocks=line_dedup.BLOCKS):
    """Blocks in which two hashes agree, given their difference."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return sum(not (x >> a) & ((1 << b - a) - 1) for a, b in zip(edges, edges[1:]))


def line_removals(spark, docs, radius=line_dedup.RADIUS, similarity=line_dedup.SIMILARITY):
    occurrences = [(i, k, PLAIN.sub(" ", x.lower()).strip(" ")) for i, t in docs for k, x in enumerate(t.split("\n"))]
    lines = sorted({x for _, _, x in occurrences if x})
    words = sorted({w for x in lines for w in x.split(" ")})
    found = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", F.xxhash64("w").alias("h"), F.xxhash64("w", F.lit(line_dedup.SECOND)).alias("g")).collect()
    number = {w: i for i, w in enumerate(words)}

    def simhashes(column):
        hashes = {r["w"]: r[column] & (2 ** 64 - 1) for r in found}
        bits = np.array([[hashes[w] >> b & 1 for b in range(64)] for w in words])
        out = []
        for x in lines:
            rows = bits[[number[w] for w in x.split(" ")]]
            out.append(sum(1 << b for b in range(64) if 2 * rows[:, b].sum() > len(rows)))
        return out
    value, second = simhashes("h"), simhashes("g")

    def distance(a, b):
        row = np.arange(len(b) + 1)
        codes = np.array(list(map(ord, b)))
        for i, c in enumerate(a):
            cost = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
            new = np.concatenate([[i + 1], cost])
            row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        return row[-1]
    v = np.array(value, np.uint64)
    links = []
    for i in range(len(lines)):
        for j in np.nonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= radius)[0] + i + 1:
            a, b = lines[i], lines[j]
            if (shared_blocks(value[i] ^ value[j]) < line_dedup.AGREE
                    or bin(second[i] ^ second[j]).count("1") > line_dedup.SECOND_RADIUS):
                continue
            if distance(a, b) <= int((1 - similarity + 1e-9) * max(len(a), len(b))):
                links.append((a, b))
    root = roots(lines, links)
    first = {}
    for i, k, x in occurrences:
        if x and (root[x] not in first or (i, k) < first[root[x]]):
            first[root[x]] = (i, k)
    return {(i, k) for i, k, x in occurrences if x and first[root[x]] != (i, k)}, len(links)


def test_line_dedup_against_brute_force(spark):
    docs = small(spark)
    gone, links = line_removals(spark, docs)
    assert links > 0
    got = QUERIES["op2_fuzzy_line_dedup"](spark, SF_SMALL).collect()
    want = set()
    for i, t in docs:
        lines = t.split("\n")
        kept = [x for k, x in enumerate(lines) if (i, k) not in gone]
        want.add((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert {(r["doc_id"], r["n_lines"], r["n_removed"], r["kept_sha256"]) for r in got} == want


def test_simhash_of_long_lines(spark):
    """Many words, and bits that nearly all of them have."""
    words = [f"w{i % 7}" for i in range(70_000)]
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:7])), (3, "w0")], "id long, line string")
    got = {r["id"]: r["simhash"] for r in line_dedup.simhashes(frame).collect()}
    assert got[1] == got[2] and got[3] == spark.range(1).select(F.xxhash64(F.lit("w0"))).first()[0]


def test_every_hash_pair_that_meets_is_found(spark):
    """All pairs within blocks - agree bits, and of those beyond the ones that share the blocks."""
    r = random.Random(6)
    values = {r.getrandbits(64) - 2 ** 63 for _ in range(150)}
    for x in list(values)[:100]:
        for _ in range(3):
            y = x
            for b in r.sample(range(64), r.randrange(1, 13)):
                y ^= 1 << b if b < 63 else -(1 << 63)
            values.add(y)
    rows = [(i, x, 50 + i % 3, i % 97) for i, x in enumerate(sorted(values))]
    got = line_dedup.near_hashes(spark.createDataFrame(rows, "id long, simhash long, n int, root long")).collect()
    want, sure = set(), 0
    for a, x, _, p in rows:
        for b, y, _, q in rows[a + 1:]:
            bits = (x ^ y) & (2 ** 64 - 1)
            if p != q and bin(bits).count("1") <= line_dedup.RADIUS and shared_blocks(bits) >= 2:
                want.add((a, b))
                sure += bin(bits).count("1") <= 5
    assert len(got) == len(want) and {(x["a"], x["b"]) for x in got} == want and sure > 50


def test_two_texts_under_one_id_are_two_documents(spark):
    docs = [(3, "shared line of some words here\nother text stands here"), (7, "shared line of some words here"),
            (7, "unique zebra content here today")]
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs_of(spark, docs)).collect()}
    assert got == {(3, docs[0][1]), (7, ""), (7, docs[2][1])}


def test_lines_odd_rows(spark):
    odd = ODD + [(10, "same line\nsame line\n\n---\nother"), (11, "Same, line!\n---")]
    got = line_dedup.dedup_lines(docs_of(spark, odd)).collect()
    assert len(got) == len(odd)
    text = {(r["doc_id"], r["text"], r["n_removed"]) for r in got}
    assert (10, "same line\n\n---\nother", 1) in text and (11, "---", 1) in text
    assert (None, ODD[0][1], 0) in text and (1, None, 0) in text and (2, "", 0) in text and (5, "", 1) in text
    assert sum(r["doc_id"] == 4 and r["n_removed"] == 0 for r in got) == 2
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_is_native(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_pieces_let_every_near_pair_pass(spark):
    """Edits spread over the pieces as evenly as can be, up to the bound."""
    r = random.Random(4)
    pairs = []
    for _ in range(60):
        a = [r.choice("abcdeé🙂 ") for _ in range(r.randrange(8, 260))]
        b = list(a)
        for at in sorted(r.sample(range(len(a)), round(len(a) * r.choice((0.08, 0.1, 0.12)))), reverse=True):
            b[at:at + 1] = r.choice(([], ["x"], [b[at], "x"]))
        pairs.append(("".join(a), "".join(b)))
    lines = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "id long, line string")
    ids = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(len(pairs))], "a long, b long")
    near = {2 * i for i, (a, b) in enumerate(pairs) if _edits(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-6)}
    assert 10 < len(near) < 60 and {x["a"] for x in line_dedup.alike(ids, lines, 0.9).collect()} == near


def test_links_of_a_group_connect_what_all_pairs_connect(spark, monkeypatch):
    """A group that chance holds together was sent to every block of it."""
    r = random.Random(6)
    sets = [np.unique(np.array([r.randrange(2 ** 63) for _ in range(r.randrange(4, 60))], np.uint64)) for _ in range(150)]
    for s in sets[:60]:  # chains of near copies
        for _ in range(3):
            s = np.unique(np.concatenate([s[r.random() < 0.5:], np.array([r.randrange(2 ** 63)], np.uint64)]))
            sets.append(s)
    members = spark.createDataFrame([(i % 3, i, s.tobytes()) for i, s in enumerate(sets)],
                                    "root long, node long, shingles binary")
    held, real = [], minhash._reached

    def noted(pairs, *rest):
        held.append(pairs.count())
        return real(pairs, *rest)
    monkeypatch.setattr(minhash, "_reached", noted)
    found = {(x["node"], x["root"]) for x in components(minhash.linked(members, 0.8)).collect()}
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if i % 3 == j % 3 and both * 1.8 >= 0.8 * (len(a) + len(sets[j])) - 1e-9:
                x, y = sorted((root[i], root[j]))
                root = [x if k == y else k for k in root]
    size = Counter(root)
    assert found == {(i, k) for i, k in enumerate(root) if size[k] > 1} and len(found) > 60
    assert sum(held) < 4 * len(sets)


def held_pairs(monkeypatch):
    held, real = [], minhash._reached

    def noted(pairs, *rest):
        held.append(pairs.count())
        return real(pairs, *rest)
    monkeypatch.setattr(minhash, "_reached", noted)
    return held


def test_shingles_of_many_sets_make_no_pairs(spark, monkeypatch):
    """What all sets of a group have comes first in the order of the sets: every pair was held."""
    r = random.Random(9)
    common = list(range(1, 30))
    sets = [np.array(sorted([*common, *(r.randrange(2 ** 40, 2 ** 63) for _ in range(70))]), np.uint64) for _ in range(120)]
    sets += [np.unique(np.append(s[:-2], np.uint64(2 ** 63 + i))) for i, s in enumerate(sets[:10])]
    members = spark.createDataFrame([(1, i, s.tobytes()) for i, s in enumerate(sets)],
                                    "root long, node long, shingles binary")
    held = held_pairs(monkeypatch)
    found = {(x["node"], x["root"]) for x in components(minhash.linked(members, 0.8)).collect()}
    assert found == {(i + k, i) for i in range(10) for k in (0, 120)}
    assert sum(held) < 3 * len(sets)


def test_sets_of_as_many_pairs_as_nodes_at_a_time(spark, monkeypatch):
    """Copies of one set with a fifth of it changed: many pairs share first
    shingles, and the sets of all of them moved at once."""
    r = random.Random(2)
    base = [r.randrange(2 ** 63) for _ in range(100)]
    sets = [np.unique(np.array([*r.sample(base, 90), *(r.randrange(2 ** 63) for _ in range(10))], np.uint64)) for _ in range(60)]
    members = spark.createDataFrame([(1, i, s.tobytes()) for i, s in enumerate(sets)],
                                    "root long, node long, shingles binary")
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(np.intersect1d(a, sets[j])) * 1.8 >= 0.8 * (len(a) + len(sets[j])) - 1e-9:
                x, y = sorted((root[i], root[j]))
                root = [x if k == y else k for k in root]
    held = held_pairs(monkeypatch)
    found = {(x["node"], x["root"]) for x in components(minhash.linked(members, 0.8)).collect()}
    size = Counter(root)
    assert found == {(i, k) for i, k in enumerate(root) if size[k] > 1}
    assert max(held[1:], default=0) <= 2 * len(sets)


def test_words_beside_a_unit_reach_as_far_in_any_text():
    """Also where lower case is longer than the text; hashes of one row do not depend on the other rows."""
    r = random.Random(5)
    for letter in ("i", "\u0130"):
        text = " ".join(f"{letter}w{r.randrange(50)}" for _ in range(200)) + "."
        words, spans = paragraphs.spans_of(text)
        hashes, units = paragraphs.units_of(text)
        cuts = np.array([0, *(u[3] for u in units if u[4] == 0)])
        held = []
        for a, b, first, last, apart in units:
            low, high = map(int, paragraphs.beside(cuts, first, last))
            if not apart:
                held.append({"class_id": len(held) - 3, "start": a, "end": b, "first": first, "last": last, "low": low,
                             "high": high, "skip_0": 1, "skip_1": 0})
        rows = list(paragraphs.words_beside(text, held))
        other = [u | {"first": -1} for u in held]  # found anew
        assert [x[:4] for x in rows] == [x[:4] for x in paragraphs.words_beside(text, other)] and len(rows) > 10
        for side in (0, 1):
            own = [x for x in rows if x[1] == side]
            column = [np.array([held[x[0]][c] for x in own], np.int64) for c in ("class_id", f"skip_{side}")]
            place = np.array([x[2] for x in own])
            got = list(zip(*map(np.ndarray.tolist, paragraphs._prefixes(side, *column, place, [x[3] for x in own], [x[4] for x in own]))))
            want = []
            for i, (number, *_) in enumerate(own):
                u = held[number]
                near, at = ((hashes[u["low"]:u["first"]][::-1], spans[u["low"]:u["first"], 0][::-1]) if side == 0
                            else (hashes[u["last"]:u["high"]], spans[u["last"]:u["high"], 1]))
                steps = np.arange(len(near), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                seed = minhash.mixed(np.array([(u["class_id"] * 2 + side) % 2 ** 64], np.uint64))
                keys = minhash.mixed(np.cumsum(minhash.mixed(near + steps)) + seed)
                want += [(i, int(k), int(x)) for k, x in list(zip(keys, at))[u[f"skip_{side}"]:]]
            assert got == want and len(got) > 50


def test_tables_beside_units_are_removed(spark):
    from test_disk import copies, folders
    before = [folders(spark, n) for n in ("beside", "shingles")]
    assert paragraphs.removals(paragraphs.near_paragraphs(copies(spark))).count() == 5
    assert [folders(spark, n) for n in ("beside", "shingles")] == before
