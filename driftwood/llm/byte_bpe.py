"""Byte-level BPE encoding and decoding with DuckDB inside Spark tasks.

Each task gathers the distinct pre-tokens of an Arrow batch and contracts
them in one DuckDB recursive query: token-position rows join the merge table,
every word takes its leftmost pair of minimum rank, and the query recurs
until no word has a pair left. Ids are decoded by an ordered aggregation over the
vocabulary: ``decode`` goes from ids alone, cutting them into runs that start
at a token with a leading space. Distinct words and runs repeat far more than
texts do, so both are memoised per worker, within fixed numbers of entries.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.bpe_ids import Cut, Memo, spelt, steps

#: Words per recursive query, and bytes up to which a word goes through it.
#: A longer word would need as many recursions as bytes over all its rows, so
#: it is contracted by a heap instead, to the same ids.
WORDS_PER_QUERY = 40_000
LONG_WORD = 256
#: Entries of the per-worker memos and the longest chunk they keep.
MEMO_ENTRIES = 600_000
MEMO_CHARS = 64

_CONTRACT = """
WITH RECURSIVE state(it, w, t) AS (
  SELECT 0, w, list(tok ORDER BY pos) FROM word_bytes GROUP BY w
  UNION ALL
  SELECT s.it + 1, s.w,
         s.t[1:(best.k & 65535) - 1] || [(best.k >> 16)::INT] || s.t[(best.k & 65535) + 2:]
  FROM state s JOIN (
    SELECT pair.w, min((m.rank::BIGINT << 16) | pair.pos) AS k
    FROM (SELECT w, unnest(t[:-2]) AS l, unnest(t[2:]) AS r, unnest(range(1, len(t))) AS pos
          FROM state) pair
    JOIN merges m ON m.pair = pair.l::BIGINT * 65536 + pair.r
    GROUP BY pair.w) best ON best.w = s.w
)
SELECT w, arg_max(t, it) AS ids FROM state GROUP BY w ORDER BY w
"""

_EXPAND = """
SELECT w, string_agg(v.bytes, '' ORDER BY pos) AS text
FROM (SELECT w, unnest(ids) AS id, unnest(range(len(ids))) AS pos FROM runs)
JOIN vocabulary v USING (id) GROUP BY w ORDER BY w
"""


class Codec:
    """Vocabulary, merge table and memos of one Python worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(self.ranks.values()) >= 65536:
            raise ValueError("ids of 65536 and more do not fit the packed merge key")
        self.match = regex.compile(pattern).findall
        # Every way to halve a token into two tokens is a merge of its rank.
        merges = [(self.ranks[b[:i]] * 65536 + self.ranks[b[i:]], rank)
                  for b, rank in self.ranks.items() for i in range(1, len(b))
                  if b[:i] in self.ranks and b[i:] in self.ranks]
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.starts = np.zeros(max(self.ranks.values()) + 1, bool)
        self.starts[[r for b, r in self.ranks.items() if b[:1] == b" "]] = True
        # "id " of every id, for texts of decimal ids.
        names = [b"%d " % i for i in range(len(self.starts))]
        width = max(map(len, names))
        self.digits = np.frombuffer(b"".join(x.ljust(width) for x in names), np.uint8).reshape(-1, width)
        self.digit_mask = np.arange(width) < np.array([len(x) for x in names])[:, None]
        self.known = np.zeros(len(self.starts), bool)
        self.known[list(self.ranks.values())] = True
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pair, rank = zip(*merges)
        self._table("merges", pair=pa.array(pair, pa.int64()), rank=pa.array(rank, pa.int32()))
        # Bytes as the code points of the same numbers: VARCHAR carries them unchanged.
        self._table("vocabulary", id=pa.array(self.ranks.values(), pa.int32()),
                    bytes=pa.array([b.decode("latin-1") for b in self.ranks]))
        self.stems = Memo(MEMO_ENTRIES)  # packed ids, bytes and decimal ids of each
        self.runs: dict[bytes, bytes] = {}

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def contract(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each pre-token."""
        out: list[bytes] = [b""] * len(words)
        raw = [w.encode() for w in words]
        short = [i for i, b in enumerate(raw) if 0 < len(b) <= LONG_WORD]
        for lo in range(0, len(short), WORDS_PER_QUERY):
            part = short[lo:lo + WORDS_PER_QUERY]
            sizes = np.array([len(raw[i]) for i in part])
            data = np.frombuffer(b"".join(raw[i] for i in part), np.uint8)
            self._table("word_bytes",
                        w=pa.array(np.repeat(np.arange(len(part)), sizes)),
                        pos=pa.array(np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)),
                        tok=pa.array(self.byte_ids[data]))
            ids = self.con.sql(_CONTRACT).to_arrow_table().column("ids").combine_chunks()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = ids.offsets.to_numpy()
            for k, i in enumerate(part):
                out[i] = flat[ends[k]:ends[k + 1]].tobytes()
        for i, b in enumerate(raw):
            if len(b) > LONG_WORD:
                out[i] = self._contract_long(b)
        return out

    def _contract_long(self, word: bytes) -> bytes:
        """The same contraction for one long word: a heap of pairs by (rank, position)."""
        n = len(word)
        end = list(range(1, n + 1))  # of the token that starts here
        before = list(range(-1, n - 1))
        alive = [True] * n

        def pair(i: int):
            j = end[i]
            rank = self.ranks.get(word[i:end[j]]) if j < n else None
            return None if rank is None else (rank, i, j, end[j])
        heap = [p for p in map(pair, range(n)) if p]
        heapq.heapify(heap)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and end[i] == j and end[j] == stop):
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([self.ranks[word[i:end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()

    def _learn(self, words: list[str]) -> dict[str, tuple[bytes, bytes, bytes]]:
        """Ids of new words, the bytes that these ids decode to, and the
        decimal ids with a space behind each."""
        ids = self.contract(words)
        return dict(zip(words, zip(ids, self.expand(ids), self._spaced(ids))))

    def encode(self, texts: list[str] | pa.Array, forms: tuple[int, ...] = (0, 1)) -> list[tuple[bytes, ...]]:
        """Of each text the ``forms`` asked for: its packed ids (0), the bytes
        they decode to (1), its decimal ids with a space behind each (2)."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        out = []
        for part in steps(texts):
            cut = Cut(part)
            known = self.stems
            known.trim()
            new = known.lacks(cut.stems)
            # A stem of letters is a match, as is a run of marks.
            pieces = [[" " + c] if c.isalpha() else self.match(spelt(c)) for c in new]
            heads = [self.match(h) for h in cut.heads]
            marks = [[m] if m else [] for m in cut.marks]
            learnt = self._learn(list({w for ws in (*pieces, *heads, *marks) for w in ws}))

            def joined(words: list[str]) -> tuple[bytes, ...]:
                if len(words) == 1:
                    return learnt[words[0]]
                return tuple(b"".join([learnt[w][k] for w in words]) for k in range(3))
            known.update(zip(new, map(joined, pieces)))
            found = [list(map(joined, heads)), [known[c] for c in cut.stems], list(map(joined, marks))]
            out += zip(*(cut.laid(*([f[k] for f in x] for x in found)) for k in forms))
            for c in new:  # long stems are not kept
                if len(c) > MEMO_CHARS:
                    del known[c]
        return out

    def expand(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence, by ordered aggregation."""
        out: list[bytes] = []
        for lo in range(0, len(packed), WORDS_PER_QUERY):
            part = packed[lo:lo + WORDS_PER_QUERY]
            flat = np.frombuffer(b"".join(part), "<u4").astype(np.int32)
            ends = np.cumsum([0, *(len(r) // 4 for r in part)]).astype(np.int32)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(self.starts) or not self.known[flat].all()):
                raise ValueError("an id is not in the vocabulary")
            self._table("runs", w=pa.array(np.arange(len(part))),
                        ids=pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            found = self.con.sql(_EXPAND).to_arrow_table()
            texts = [b""] * len(part)  # an empty sequence has no row
            for w, t in zip(found.column("w").to_pylist(), found.column("text").to_pylist()):
                texts[w] = t.encode("latin-1")
            out += texts
        return out

    def _spaced(self, packed: list[bytes]) -> list[bytes]:
        """Decimal ids of each id sequence, with a space behind each."""
        at = np.frombuffer(b"".join(packed), "<u4")
        held = self.digit_mask[at]
        data = self.digits[at][held].tobytes()
        ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
        edges = ends[np.cumsum([0, *(len(p) // 4 for p in packed)])].tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def decimals(self, ids: bytes) -> bytes:
        """Decimal ids joined by one space."""
        return self._spaced([ids])[0][:-1]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence (any ids of the vocabulary, in any order)."""
        if len(self.runs) > MEMO_ENTRIES:
            self.runs.clear()
        parts = []
        for ids in packed:
            number = np.minimum(np.frombuffer(ids, "<u4"), len(self.starts) - 1)  # unknown ids fail below
            at = (np.nonzero(self.starts[number])[0] * 4).tolist()
            edges = [0, *at, len(ids)]
            parts.append([ids[a:b] for a, b in zip(edges, edges[1:]) if a < b])
        fresh = list({r for p in parts for r in p if r not in self.runs})
        known = dict(zip(fresh, self.expand(fresh)))
        out = [b"".join([known[r] if r in known else self.runs[r] for r in p]) for p in parts]
        self.runs.update((r, t) for r, t in known.items() if len(r) <= 4 * MEMO_CHARS)
        return out


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _per_batch(work, texts_per_step: int = 4096):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, texts_per_step):
                yield from work(batch.slice(lo, texts_per_step))
    return over


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text. Null text has no ids."""
    def work(batch):
        c = codec(path, pattern)
        ids = [np.frombuffer(i, "<u4").astype(np.int32) for i, _ in
               c.encode(batch.column("t"))]
        yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(ids, pa.list_(pa.int32()))],
                                         names=["doc_id", "ids"])
    return (docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
            .mapInArrow(_per_batch(work), "doc_id long, ids array<int>"))


def decode(ids: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id, bytes binary`` of id sequences. Null ids decode to no bytes;
    an id outside the vocabulary raises an error."""
    def work(batch):
        c = codec(path, pattern)
        packed = [np.array(i or [], "<u4").tobytes() for i in batch.column("i").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("d"), pa.array(c.decode(packed), pa.binary())], names=["doc_id", "bytes"])
    return (ids.select(F.col(id_col).cast("long").alias("d"), F.col(ids_col).alias("i"))
            .mapInArrow(_per_batch(work), "doc_id long, bytes binary"))


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass, returning digests only:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``, one row per input row.

    Null and empty texts have no tokens; both digests are then those of the
    empty string. Repeated rows give repeated results.
    """
    def work(batch):
        c = codec(path, pattern)
        enc = c.encode(batch.column("t"), forms=(2, 1))
        yield pa.RecordBatch.from_arrays([
            batch.column("d"),
            pa.array([i.count(b" ") for i, _ in enc], pa.int64()),
            pa.array([hashlib.sha256(i[:-1]).hexdigest() for i, _ in enc], pa.string()),
            pa.array([hashlib.sha256(b).hexdigest() for _, b in enc], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return (docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
            .mapInArrow(_per_batch(work),
                        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
