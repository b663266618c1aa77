"""Token ids of whole texts by a ``tokenizers`` file, memoised by chunk.

A space between two characters that are no white space always ends a match
of the byte-level pre-tokenisation pattern: the match before it cannot hold
white space and the match after it starts with the space. A line break
between two such characters is a match of its own. So a text may be cut
before both, and the ids of a text are the ids of its chunks in order. Chunks
repeat far more than texts: Arrow cuts some megabytes of texts at a time and
numbers their distinct chunks, each is encoded once, and Arrow lays the ids
out again by these numbers.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as ``\s`` of Python's ``re`` has it, for Arrow's expressions.
_SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}]")
_EDGE = rf"{_SPACE}[ \n]|[ \n]{_SPACE}"
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
#: Bytes of text that are cut at a time, entries of a task's memo and the
#: longest chunk it keeps (memory bounds only).
STEP_BYTES = 4_000_000
MEMO_ENTRIES = 250_000
MEMO_CHARS = 64
#: A run of these behind letters is a match of its own. None is white space, a letter or an apostrophe.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Memo(dict):
    """At most ``entries`` entries: when half as many are new, those of which
    nothing was asked since the last time go."""

    def __init__(self, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.entries, self.old = entries, {}

    def __missing__(self, key):
        found = self[key] = self.old[key]
        return found

    def lacks(self, keys) -> list:
        return [k for k in keys if k not in self and k not in self.old]

    def trim(self) -> None:
        if len(self) > self.entries // 2:
            self.old = dict(self)
            self.clear()


def steps(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in parts of about ``STEP_BYTES`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + STEP_BYTES, "right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def _listed(words: pa.Array) -> list[str]:
    """Distinct chunks as Python strings; of those without a space in one go."""
    if not len(words):
        return []
    if pc.any(pc.match_substring(words, " ")).as_py():
        return words.to_pylist()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().split(" ")


class Cut:
    """Texts (nulls: empty) cut into chunks. ``heads`` are the distinct first
    chunks; of the others, letters and a run of marks behind them are two
    matches: ``stems`` are the distinct rests, which stand for ``spelt`` of
    themselves, and ``marks`` the distinct runs, the empty one first."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.string()).fill_null("")
        edged = pc.match_substring_regex(texts, _EDGE)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        if pc.any(edged).as_py():
            plain = iter(lists.filter(pc.invert(edged)).to_pylist())
            lists = pa.array([_CUT.split(t) if e else next(plain)
                              for t, e in zip(texts.to_pylist(), edged.to_pylist())], pa.list_(pa.string()))
        flat = lists.flatten()
        self.edges = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        first = np.zeros(len(flat), bool)
        first[self.edges[:-1]] = True
        heads = flat.filter(pa.array(first)).dictionary_encode()
        rest = flat.filter(pa.array(~first)).dictionary_encode()
        self.codes = np.empty(len(flat), np.int32)
        self.codes[first] = heads.indices.to_numpy()
        self.codes[~first] = rest.indices.to_numpy() + len(heads.dictionary)
        words = rest.dictionary
        bare = pc.utf8_rtrim(words, MARKS)
        bare = pc.if_else(pc.utf8_is_alpha(bare), bare, words)
        marked = pc.not_equal(pc.binary_length(bare), pc.binary_length(words))
        runs = pc.replace_substring_regex(words.filter(marked), f"^[^{re.escape(MARKS)}]+", "").dictionary_encode()
        self.mark_codes = np.zeros(len(words), np.int32)
        self.mark_codes[marked.to_numpy(zero_copy_only=False)] = runs.indices.to_numpy() + 1
        bare = bare.dictionary_encode()
        self.stem_codes = bare.indices
        self.heads, self.marks = heads.dictionary.to_pylist(), ["", *runs.dictionary.to_pylist()]
        self.stems = _listed(bare.dictionary)

    def laid(self, heads: list[bytes], stems: list[bytes], marks: list[bytes]) -> list[bytes]:
        """Of each text what its parts are replaced by, one after the other."""
        heads, stems, marks = (pa.array(x, pa.large_binary()) for x in (heads, stems, marks))
        words = pc.binary_join_element_wise(stems.take(self.stem_codes), marks.take(pa.array(self.mark_codes)),
                                            pa.scalar(b"", pa.large_binary()))
        found = pa.concat_arrays([heads, words]).take(pa.array(self.codes))
        edges = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)[self.edges].tolist()
        data = memoryview(found.buffers()[2] or b"")
        return [data[a:b].tobytes() for a, b in zip(edges, edges[1:])]


def spelt(chunk: str) -> str:
    """The text of a chunk behind the first: with the space that it was cut at."""
    return chunk if chunk[:1] == "\n" else " " + chunk


@functools.lru_cache(maxsize=2)
def _library(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    newline = tok.encode("\n", add_special_tokens=False).ids
    return tok, newline[0] if len(newline) == 1 else None


def _encode(path: str, pieces: list[str]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit numbers."""
    tok, newline = _library(path)
    out: dict[int, bytes] = {}
    # Pieces of a space, or a line break, and a word may share one call, parted
    # by line breaks: "\n" before " x" or "x" is a match of its own.
    plain = [i for i, p in enumerate(pieces)
             if newline is not None and 1 < len(p) <= MEMO_CHARS and p[0] in " \n" and "\n" not in p[1:]
             and not p[1].isspace()]
    packs = [plain[i:i + 256] for i in range(0, len(plain), 256)]
    joined = tok.encode_batch_fast(["\n".join(pieces[i].removeprefix("\n") for i in pack) for pack in packs],
                                   add_special_tokens=False)
    for pack, e in zip(packs, joined):
        ids = np.asarray(e.ids, np.uint32)
        ends = np.append(np.nonzero(ids == newline)[0], len(ids)).tolist()
        if len(ends) == len(pack):
            start = 0
            packed, broken = ids.tobytes(), np.uint32(newline).tobytes()
            for i, end in zip(pack, ends):
                found = packed[4 * start:4 * end]
                out[i] = broken + found if pieces[i][0] == "\n" else found
                start = end + 1
    rest = [i for i in range(len(pieces)) if i not in out]
    for i, e in zip(rest, tok.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
        out[i] = np.asarray(e.ids, np.uint32).tobytes()
    return [out[i] for i in range(len(pieces))]


def encode(texts: list[str] | pa.Array, path: str, memo: Memo | None = None) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers. A task
    passes its own memo, so idle workers hold none."""
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.large_string())
    memo = Memo() if memo is None else memo
    out = []
    for part in steps(texts):
        memo.trim()
        cut = Cut(part)
        new = memo.lacks(cut.stems)
        memo.update(zip(new, _encode(path, [spelt(c) for c in new])))
        out += cut.laid(_encode(path, cut.heads), [memo[c] for c in cut.stems], _encode(path, cut.marks))
        for c in new:  # long chunks are not kept
            if len(c) > MEMO_CHARS:
                del memo[c]
    return out
