"""Language-model scores from a subword lattice.

A word is the marker and its characters; every way to cut it into pieces of
an existing vocabulary is a path of its lattice, and a forward recursion in
log space adds the paths up to the word's marginal probability. The
vocabulary's own scores give the first weights of the pieces; expectation
maximisation over the distinct training words re-estimates them.

Words seen in training have a path of their own: one arc over the whole word,
weighted by its count less a discount. What the discounts set free goes to
the paths through pieces, so that all words together, and the end, have
probability one. A text is its words and one end.

A word's probability depends on the word alone, so it is computed once per
distinct word. Word counts are gathered from the whole corpus by a shuffle,
and each block of documents gets back the entries of its own words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.session import scratch_path

MARK = "▁"
LOG10 = math.log(10)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case: what lies between the characters
    U+0020 and U+0009 to U+000D, the white space of ``bytes.split``."""
    return (text or "").encode().lower().split()


class Vocabulary:
    """Usable pieces of a sentencepiece model file, with first weights.

    The file orders its pieces by score. Scores of a merge vocabulary are
    ranks, not log-probabilities, so a piece of score -r starts at a weight
    that falls as 1 / r. Byte pieces and the end of a word start at the least
    weight. Pieces with the marker open a word; all others, the bytes and
    the word's end follow. Either kind sums to one.
    """

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.bytes = [0] * 256
        weights, opens = [], []
        for i in range(model.get_piece_size()):
            if model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = len(weights)
                weights.append(0.0)
            elif MARK not in piece[1:] and not any("A" <= c <= "Z" for c in piece):
                self.pieces[piece] = len(weights)
                weights.append(1 / (2 - model.get_score(i)))
            else:
                continue
            opens.append(piece[0] == MARK)
        if MARK not in self.pieces:
            self.pieces[MARK] = len(weights)
            weights.append(0.0)
            opens.append(True)
        self.end = len(weights)  # of a word
        weights.append(0.0)
        opens.append(False)
        self.opens = np.array(opens)
        w = np.array(weights)
        w[w == 0] = w[w > 0].min() if w.any() else 1.0
        self.first = self.normalised(w)
        self.longest = max(map(len, self.pieces))

    def normalised(self, weights: np.ndarray) -> np.ndarray:
        return np.where(self.opens, weights / weights[self.opens].sum(), weights / weights[~self.opens].sum())


def _step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of a string from that of the string without its last character."""
    return (h ^ (code + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15) + (h >> np.uint64(29))


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    """Log of the sum of exponentials, term by term; at least one is finite."""
    table = np.stack(terms)
    top = table.max(axis=0)
    return top + np.log(np.exp(table - top).sum(axis=0))


class Lattice:
    """Lattices of words under given piece probabilities, all words of one
    length at a time: a column per substring, a row per word. Longer words
    than ``WIDE`` characters go one by one."""

    WIDE, ROWS = 48, 8192

    def __init__(self, vocabulary: Vocabulary, probability: np.ndarray):
        self.log = np.log(probability)
        log = self.log.tolist()
        self.vocabulary = vocabulary
        self.pieces = {p: (i, log[i]) for p, i in vocabulary.pieces.items()}
        self.byte = [log[i] for i in vocabulary.bytes]
        self.end = log[vocabulary.end]
        # Pieces by the hash of their characters, and which hashes may be one.
        spelt = sorted(vocabulary.pieces, key=len)
        h = np.zeros(len(spelt), np.uint64)
        for k in range(vocabulary.longest):
            at = [i for i, p in enumerate(spelt) if len(p) > k]
            h[at] = _step(h[at], np.array([ord(spelt[i][k]) for i in at], np.uint64))
        order = np.argsort(h)
        self.known, self.number = h[order], np.array([vocabulary.pieces[p] for p in spelt])[order]
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces of the vocabulary share a hash")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(h >> np.uint64(44)).astype(np.int64)] = True

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 if it is none."""
        out = np.full(len(h), -1)
        at = np.nonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])[0]
        to = np.minimum(np.searchsorted(self.known, h[at]), len(self.known) - 1)
        hit = self.known[to] == h[at]
        out[at[hit]] = self.number[to[hit]]
        return out

    def _batches(self, words: list[bytes]):
        """(numbers of the words, their characters as a matrix), and the
        numbers of the words that are too long for it."""
        texts = [MARK + w.decode("utf-8", "surrogateescape") for w in words]
        size = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(size, kind="stable")
        sizes, start = np.unique(size[order], return_index=True)
        for n, part in zip(sizes.tolist(), np.split(order, start[1:])):
            if n > self.WIDE:
                yield part, None
                continue
            for lo in range(0, len(part), self.ROWS):
                here = part[lo:lo + self.ROWS]
                raw = "".join([texts[i] for i in here]).encode("utf-32-le", "surrogatepass")
                yield here, np.frombuffer(raw, np.uint32).reshape(-1, n)

    def _weights(self, codes: np.ndarray):
        """Per end and start: piece numbers and log weights (-inf for no
        piece); per character the log weight of its bytes."""
        n = codes.shape[1]
        wide = codes.astype(np.uint64)
        arcs: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(n + 1)]
        log = np.append(self.log, -np.inf)  # of piece -1
        for i in range(n):
            h = np.zeros(len(codes), np.uint64)
            for j in range(i + 1, min(n, i + self.vocabulary.longest) + 1):
                h = _step(h, wide[:, j - 1])
                piece = self._find(h)
                if (piece >= 0).any():
                    arcs[j].append((i, piece, log[piece]))
        chars, number = np.unique(codes, return_inverse=True)
        spelt = np.array([sum(self.byte[b] for b in chr(c).encode("utf-8", "surrogateescape"))
                          for c in chars.tolist()])[number.reshape(codes.shape)]
        return arcs, spelt

    def _forward(self, arcs, spelt: np.ndarray) -> np.ndarray:
        """Log-space forward recursion: the weight of all paths to each position."""
        alpha = np.zeros((spelt.shape[1] + 1, len(spelt)))
        for j in range(1, len(alpha)):
            terms = [alpha[i] + w for i, _, w in arcs[j]]
            if j > 1:  # any character but the marker can be spelt in bytes
                terms.append(alpha[j - 1] + spelt[:, j - 1])
            alpha[j] = _log_sum(terms)
        return alpha

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural logs of the words' marginal probabilities over all
        segmentations, their ends included."""
        out = np.zeros(len(words))
        for here, codes in self._batches(words):
            if codes is None:
                out[here] = [self.log_probability(words[i]) for i in here]
            else:
                out[here] = self._forward(*self._weights(codes))[-1] + self.end
        return out

    def expect_all(self, words: list[bytes], counts: np.ndarray) -> None:
        """Add the expected uses of every piece in the words."""
        for here, codes in self._batches(words):
            if codes is None:
                for i in here:
                    self.expect(words[i], counts)
                continue
            arcs, spelt = self._weights(codes)
            alpha, n = self._forward(arcs, spelt), codes.shape[1]
            into: list[list[np.ndarray]] = [[] for _ in range(n + 1)]
            back = np.zeros(len(codes))
            for j in range(n, 0, -1):
                if j < n:
                    back = _log_sum(into[j])
                rest = back - alpha[-1]
                for i, piece, w in arcs[j]:
                    into[i].append(back + w)
                    at = np.nonzero(piece >= 0)[0]
                    counts += np.bincount(piece[at], np.exp((alpha[i] + w + rest)[at]), len(counts))
                if j > 1:
                    into[j - 1].append(back + spelt[:, j - 1])
                    share = np.exp(alpha[j - 1] + spelt[:, j - 1] + rest)
                    chars, number = np.unique(codes[:, j - 1], return_inverse=True)
                    for c, x in zip(chars.tolist(), np.bincount(number, share).tolist()):
                        for b in chr(c).encode("utf-8", "surrogateescape"):
                            counts[self.vocabulary.bytes[b]] += x

    def arcs(self, word: bytes) -> list[list[tuple[int, float, object]]]:
        """Per end position: (start, log weight, piece or the bytes of a character)."""
        s = MARK + word.decode("utf-8", "surrogateescape")
        get, longest, out = self.pieces.get, self.vocabulary.longest, [[]]
        for j in range(1, len(s) + 1):
            here = []
            for i in range(max(0, j - longest), j):
                found = get(s[i:j])
                if found is not None:
                    here.append((i, found[1], found[0]))
            if j > 1:  # any character can be spelt in bytes
                raw = s[j - 1].encode("utf-8", "surrogateescape")
                here.append((j - 1, sum([self.byte[b] for b in raw]), raw))
            out.append(here)
        return out

    @staticmethod
    def _sum(terms: list[float]) -> float:
        if len(terms) == 1:
            return terms[0]
        top = max(terms)
        return top + math.log(sum([math.exp(t - top) for t in terms]))

    def forward(self, arcs) -> list[float]:
        alpha = [0.0]
        for here in arcs[1:]:
            alpha.append(self._sum([alpha[i] + w for i, w, _ in here]))
        return alpha

    def log_probability(self, word: bytes) -> float:
        """Natural log of the word's marginal probability over all
        segmentations, its end included."""
        return self.forward(self.arcs(word))[-1] + self.end

    def expect(self, word: bytes, counts: np.ndarray) -> None:
        """Add the expected uses of every piece in the word."""
        arcs = self.arcs(word)
        alpha = self.forward(arcs)
        beta: list[list[float]] = [[] for _ in arcs]
        back = [0.0] * len(arcs)
        for j in range(len(arcs) - 1, 0, -1):
            if j < len(arcs) - 1:
                back[j] = self._sum(beta[j])
            for i, w, _ in arcs[j]:
                beta[i].append(back[j] + w)
        for j in range(1, len(arcs)):
            for i, w, piece in arcs[j]:
                share = math.exp(alpha[i] + w + back[j] - alpha[-1])
                if isinstance(piece, int):
                    counts[piece] += share
                else:
                    for b in piece:
                        counts[self.vocabulary.bytes[b]] += share


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Batches put together, so that words of one length are many."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def learn(words: DataFrame, vocabulary: Vocabulary, rounds: int = 3, prior: float = 1000.0) -> np.ndarray:
    """Piece probabilities by expectation maximisation over the column
    ``word`` (distinct training words, each counted once: the pieces are to
    spell new words, not frequent ones). ``prior`` counts are shared out by
    the first weights, so that every piece stays possible. What reaches the
    driver is one number per piece."""
    p = vocabulary.first
    for _ in range(rounds):
        lattice = words.sparkSession.sparkContext.broadcast(Lattice(vocabulary, p))

        def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(vocabulary.first))
            for batch in _gathered(batches):
                lattice.value.expect_all(batch.column("word").to_pylist(), total)
                total[vocabulary.end] += batch.num_rows
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

        counts = prior * vocabulary.first
        for r in (words.select("word").mapInArrow(expected, "piece long, n double")
                  .groupBy("piece").agg(F.sum("n").alias("n")).collect()):
            counts[r["piece"]] += r["n"]
        p = vocabulary.normalised(counts)
    return p


def score(docs: DataFrame, model_path: str, held_out: str = "held_out", training: str = "training",
          rounds: int = 3, chars_per_block: int = 12_000_000, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Score every whole text; learn from the rows where ``training`` is true.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``: ``base_score`` is the log10 score of a word unigram with 0.1
    added to each count, ``score`` the log10 marginal probability of the text
    under the lattice. Null text counts as empty: one end token. Repeated
    rows are scored, and learnt from, once each. Without training rows the
    first weights stay.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(model_path)
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.coalesce(F.col(held_out), F.lit(False)).alias("h"),
                       F.coalesce(F.col(training), F.lit(False)).alias("training"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for t in batch.column("t").to_pylist():
                found.update(tokens(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"])

    words = _written(rows.where("training").select("t").mapInArrow(count, "word binary, c long")
                     .groupBy("word").agg(F.sum("c").alias("c")), "word-counts")
    total, distinct, once, twice = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1)),
        F.count(F.when(F.col("c") == 2, 1))).first()
    ends, chars, n = rows.agg(F.count(F.when(F.col("training"), 1)), F.coalesce(F.sum(F.length("t")), F.lit(0)),
                              F.count(F.lit(1))).first()
    train_tokens, kinds = total + ends, distinct + (ends > 0)
    p = learn(words, vocabulary, rounds) if distinct else vocabulary.first
    lattice = spark.sparkContext.broadcast(Lattice(vocabulary, p))
    below = math.log10(train_tokens + 0.1 * (kinds + 1))
    # Absolute discount (Ney et al. 1994); half a count each keeps the end
    # and new words possible whatever was seen.
    discount = once / (once + 2 * twice) if twice else 0.5
    new_log = math.log((discount * distinct + 0.5) / (train_tokens + 1))
    end_log = math.log((ends + 0.5) / (train_tokens + 1))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            spelt = lattice.value.log_probabilities(batch.column("word").to_pylist()) + new_log
            whole = np.log((batch.column("c").to_numpy() - discount) / (train_tokens + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.logaddexp(spelt, whole))],
                                             names=["word", "c", "log_p"])

    weighed = words.mapInArrow(weigh, "word binary, c long, log_p double")
    blocks = max(1, math.ceil(max(chars / chars_per_block, n / 100_000)))
    dealt = rows.select(F.pmod(F.xxhash64("d"), F.lit(blocks)).cast("int").alias("block"), "d", "t", "h")

    def vocabulary_of(table: pa.Table) -> pa.Table:
        found = set()
        for t in table.column("t").to_pylist():
            found.update(tokens(t))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * len(found), pa.int32()),
                         "word": pa.array(list(found), pa.binary())})

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        c = right.column("c").to_numpy()
        log_p = right.column("log_p").to_numpy().copy()
        spelt = right.column("word").to_pylist()
        new = np.nonzero(np.isnan(log_p))[0]  # not in a training document
        log_p[new] = lattice.value.log_probabilities([spelt[i] for i in new]) + new_log
        number = {w: i for i, w in enumerate(spelt)}
        known, base = c > 0, np.log10(c + 0.1)
        out = []
        for d, t, h in zip(*(left.column(x).to_pylist() for x in ("d", "t", "h"))):
            at = np.fromiter(map(number.__getitem__, found := tokens(t)), np.int64, len(found))
            out.append((d, h, len(at) + 1, int(known[at].sum()) + (ends > 0), train_tokens,
                        float(base[at].sum()) + math.log10(ends + 0.1) - (len(at) + 1) * below,
                        (float(log_p[at].sum()) + end_log) / LOG10))
        cols = list(zip(*out)) or [()] * 7
        kind = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({name: pa.array(x, k) for name, x, k in zip(
            ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), cols, kind)})

    asked = dealt.groupBy("block").applyInArrow(vocabulary_of, "block int, word binary")
    told = asked.join(weighed, "word", "left").select(
        "block", "word", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("log_p", F.lit(float("nan"))).alias("log_p"))
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        answer, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
