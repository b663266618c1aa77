"""Operators 5 and 6: against the tokenizer libraries, and packing invariants."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from driftwood.llm import bpe_ids, byte_bpe, packing
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def json_library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def odd_texts():
    r = random.Random(3)
    made = ["".join(r.choice(" \n\ta1'é.　\x1c\x85b") for _ in range(r.randrange(60))) for _ in range(400)]
    return made + ["", " ", "a" * 700, "ab" * 3000, "<|endoftext|>", "a  b", "\n x", "x \n"] + [t or "" for _, t in ODD]


def test_encode_and_decode_like_the_library(library):
    c = byte_bpe.Codec(RANKS, P.PATTERN)
    texts = odd_texts()
    got = c.encode(texts)
    for t, (ids, back) in zip(texts, got):
        want = library.encode_ordinary(t)
        assert np.frombuffer(ids, "<u4").tolist() == want and back == t.encode()
        assert c.decimals(ids).decode() == " ".join(map(str, want))
    assert c.decode([i for i, _ in got]) == [t.encode() for t in texts]
    shuffled = np.random.default_rng(1).permutation(5000).astype("<u4")  # ids in no text's order
    assert c.decode([shuffled.tobytes()])[0] == b"".join(library.decode_single_token_bytes(int(i)) for i in shuffled)
    with pytest.raises(ValueError):
        c.decode([np.array([50_256], "<u4").tobytes()])


def test_digests_of_odd_rows(spark, library):
    got = byte_bpe.digests(docs_of(spark, ODD), RANKS, P.PATTERN).collect()
    assert len(got) == len(ODD)
    want = defaultdict(list)
    for i, t in ODD:
        ids = library.encode_ordinary(t or "")
        want[i].append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                        hashlib.sha256((t or "").encode()).hexdigest()))
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in want[r["doc_id"]]
    pairs = byte_bpe.decode(byte_bpe.encode(docs_of(spark, ODD), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert {(r["doc_id"], bytes(r["bytes"])) for r in pairs} == {(i, (t or "").encode()) for i, t in ODD}
    assert byte_bpe.digests(docs_of(spark, []), RANKS, P.PATTERN).count() == 0


def test_memoised_ids_are_the_librarys(json_library):
    texts = odd_texts()
    for t, got in zip(texts, bpe_ids.encode(texts, JSON)):
        assert np.frombuffer(got, np.uint32).tolist() == json_library.encode(t, add_special_tokens=False).ids


def test_words_with_marks_are_not_encoded_anew(json_library, monkeypatch):
    asked, real = [], bpe_ids._encode
    monkeypatch.setattr(bpe_ids, "_encode", lambda path, pieces: asked.extend(pieces) or real(path, pieces))
    texts = ["a wordy text wordy### wordy.*** it's wordy's", "wordy wordy.###"]
    for t, got in zip(texts, bpe_ids.encode(texts, JSON)):
        assert np.frombuffer(got, np.uint32).tolist() == json_library.encode(t, add_special_tokens=False).ids
    assert sorted(x for x in asked if "wordy" in x and "'" not in x) == [" wordy", "wordy"]


def test_memo_keeps_what_is_asked_for():
    memo = bpe_ids.Memo(entries=10)
    for i in range(40):
        memo.trim()
        for k in memo.lacks(["often", i]):
            memo[k] = i
        assert memo["often"] == 0 and memo[i] == i
        assert len(memo) + len(memo.old) <= 14
    assert memo.lacks([0, 39]) == [0]


def test_steps_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(bpe_ids, "STEP_BYTES", 10)
    texts = pa.array(["x" * n for n in (3, 25, 0, 9, 1, 1)] + [None])
    parts = [p.to_pylist() for p in bpe_ids.steps(texts)]
    assert sum(parts, []) == texts.to_pylist() and max(map(len, parts)) > 1
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in parts)


def test_byte_bpe_contracts_words_with_marks_once(library, monkeypatch):
    c = byte_bpe.Codec(RANKS, P.PATTERN)
    asked, real = [], c.contract
    monkeypatch.setattr(c, "contract", lambda words: asked.extend(words) or real(words))
    texts = ["a wordy text wordy### wordy.*** it's", "wordy wordy.###"]
    for t, (ids, raw, spaced) in zip(texts, c.encode(texts, (0, 1, 2))):
        want = library.encode_ordinary(t)
        assert np.frombuffer(ids, "<u4").tolist() == want and raw == t.encode()
        assert spaced == b"".join(b"%d " % i for i in want)
    c.encode(["a wordy%%%"])
    assert sum(w == " wordy" for w in asked) == 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), min_size=1))
def test_plan_uses_every_piece_once(histogram):
    used = defaultdict(int)
    for lengths, times in packing.plan(histogram, 32):
        assert sum(lengths) <= 32 and times > 0
        for x in lengths:
            used[x] += times
    assert used == histogram


def test_exact_complements_are_found():
    assert sum(t for _, t in packing.plan({20: 5, 12: 5}, 32)) == 5
    assert sum(t for _, t in packing.plan({16: 3, 10: 3, 6: 3}, 32)) == 3
    assert sum(t for _, t in packing.plan({14: 2, 9: 2, 5: 2, 4: 2}, 32)) == 2


def check_packing(docs, rows, json_library, capacity=1024):
    text = dict(docs)
    pieces = defaultdict(list)
    place = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        place[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(text)
    for d, got in pieces.items():
        ids = json_library.encode(text[d] or "", add_special_tokens=False).ids + [2]
        got.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in got] == list(range(len(got)))
        assert [r["start"] for r in got] == list(np.cumsum([0] + [r["length"] for r in got[:-1]]))
        assert sum(r["length"] for r in got) == len(ids)
        assert all(r["length"] == capacity for r in got[1:]) and got[0]["length"] <= capacity
        assert len(got) == -(-len(ids) // capacity)
        for r in got:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    for spans in place.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(place)


def test_pack_whole_documents(spark, json_library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = QUERIES["op6_best_fit_packing"](spark, SF_SMALL).collect()
    used = check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], rows, json_library)
    # First fit decreasing on the same pieces.
    gaps = []
    for x in sorted((r["length"] for r in rows), reverse=True):
        i = next((i for i, g in enumerate(gaps) if g >= x), None)
        gaps.append(1024 - x) if i is None else gaps.__setitem__(i, gaps[i] - x)
    assert used <= len(gaps)


def test_pack_odd_rows(spark, json_library):
    odd = [(i, t) for k, (i, t) in enumerate(ODD) if i is not None and k != 5]
    rows = packing.pack(packing.token_pieces(docs_of(spark, odd), JSON), rows_per_salt=2).collect()
    check_packing(odd, rows, json_library)
    assert packing.pack(packing.token_pieces(docs_of(spark, []), JSON)).count() == 0
    twice = packing.pack(packing.token_pieces(docs_of(spark, ODD), JSON)).collect()
    assert sum(r["doc_id"] == 4 for r in twice) == 2 and sum(r["doc_id"] is None for r in twice) == 1
