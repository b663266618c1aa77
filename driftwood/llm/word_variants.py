"""Spelling variants of words through blocked Gram matrices.

A word's letter counts are a vector, and two words one edit apart have
vectors at a squared distance of two at most: a replaced letter takes one
from a count and adds one to another, an inserted one adds one. So the
products of a block's count matrix with those of its neighbours, NumPy
matrix products, give all squared distances at once; the few pairs at two or
less are verified letter by letter.

Blocks hold words of one length, split further by how many letters of each
of a few classes they have. The same argument names a block's neighbours:
one letter more in one class (adjacent length), or one moved between two
classes (same length). A block too large for a task is cut by word hash, and
each part meets each part of the neighbours in a task of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import cut
from driftwood.llm.minhash import groups_of

#: Letters are a-z and U+00C0 to U+00FF; in UTF-8 the latter are 0xC3 and one byte.
_PLAIN = "[a-z]{%d,}"
_ALL = "(?:[a-z]|\xc3[\x80-\xbf]){%d,}"
_LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]


def word_counts(docs: DataFrame, min_letters: int = 6, spoil: int | None = 199, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``word, n`` of the letter runs of all texts (A-Z lower-cased) that have
    ``min_letters`` code points at least. ``spoil``: where it divides the
    crc32 of ``<doc_id>:<run>``, one letter of the run, at crc32 modulo its
    length, is left out (None: never). Runs of a null id stay as they are."""
    plain = re.compile((_PLAIN % min_letters).encode("latin-1"))
    every = re.compile((_ALL % min_letters).encode("latin-1"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for d, t in zip(batch.column("d").to_pylist(), batch.column("t").to_pylist()):
                text = (t or "").encode("utf-8", "surrogatepass").lower()
                runs = (plain if text.isascii() else every).findall(text)
                if spoil and d is not None and runs:
                    start = zlib.crc32(b"%d:" % d)
                    hashes = np.fromiter((zlib.crc32(r, start) for r in runs), np.uint32, len(runs))
                    for i in np.nonzero(hashes % np.uint32(spoil) == 0)[0].tolist():
                        run = runs[i].decode()
                        at = int(hashes[i]) % len(run)
                        runs[i] = (run[:at] + run[at + 1:]).encode() if len(run) > min_letters else b""
                found.update(runs)
                if len(found) > 200_000:
                    found.pop(b"", None)
                    yield flush()
        found.pop(b"", None)
        yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _class_counts(classes: int) -> list[Column]:
    """Letters of ``word`` of each class: ``c0, c1, ...``"""
    out = []
    for k in range(classes):
        letters = "".join(_LETTERS[k::classes])
        out.append((F.length("word") - F.length(F.translate("word", letters, ""))).alias(f"c{k}"))
    return out


def _block(classes: int, steps: dict[int, int] | None = None) -> Column:
    """Name of the block of a word, or of the one some letters (class: number) away."""
    return F.concat_ws(",", *((F.col(f"c{k}") + F.lit((steps or {}).get(k, 0))).cast("string")
                              for k in range(classes)))


def _meetings(classes: int) -> list[Column]:
    """Blocks whose words a word is held against, its own first. Of two
    neighbours one does the work: the shorter one, or the one that has more
    letters of the earlier class."""
    steps = [{k: -1} for k in range(classes)] + [{a: 1, b: -1} for a, b in combinations(range(classes), 2)]
    return [_block(classes), *(_block(classes, s) for s in steps)]


def near_words(words: DataFrame, classes: int = 6, most_rows: int = 3000, most_letters: int = 4_000_000) -> DataFrame:
    """For each word (``word, n``; distinct) that differs from another by
    exactly one inserted, deleted or replaced letter: ``word, n_near`` (such
    words), ``form, form_n`` (the one with the largest n, ties to the smallest
    in code-point order). ``most_rows``, ``most_letters``: rough size of a
    task's two sides; a larger block is cut."""
    at = F.explode(F.array(*_meetings(classes))).alias("block")
    counted = cut(words.select("word", "n", *_class_counts(classes)))
    own = F.col("home") == F.col("block")
    # How much each block brings together, from the sizes of the blocks alone.
    sizes = (counted.groupBy(*(f"c{k}" for k in range(classes)))
             .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("word")).alias("letters"))
             .select("rows", "letters", _block(classes).alias("home"), at)
             .groupBy("block").agg(F.sum("rows").alias("rows"), F.sum("letters").alias("letters"),
                                   F.max(own).alias("lives")).where("lives")
             .select("block", F.ceil(F.greatest(F.col("rows") / most_rows, F.col("letters") / most_letters))
                     .cast("int").alias("cuts")))
    placed = counted.select("word", "n", _block(classes).alias("home"), at).withColumn("own", own).drop("home")
    part = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    # Roles: 0 the block's own part; held against it: 1 the block's words again, 2 those of neighbours.
    roles = F.when(F.col("own"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(2)))
    dealt = (placed.join(sizes, "block").withColumn("part", part).withColumn("role", F.explode(roles))
             .withColumn("other", F.explode(every))
             .select("block", F.when(F.col("role") == 0, F.col("part")).otherwise(F.col("other")).alias("p"),
                     F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("part")).alias("q"),
                     "role", "word", "n"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["word", "n_near", "form", "form_n"])

        for _, rows in groups_of(batches, 3):
            own, others = ([r[3:] for r in rows if (r[3] == 0) == first] for first in (True, False))
            if own and others:
                out += _partners(own, others)
            if len(out) > 50_000:
                yield flush()
        yield flush()

    parted = dealt.repartition("block", "p", "q").sortWithinPartitions("block", "p", "q")
    found = parted.mapInArrow(compare, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as a matrix padded with zeros, and the lengths."""
    raw = [w.encode("latin-1") for w in words]
    size = np.array([len(r) for r in raw])
    wide = int(size.max())
    return np.frombuffer(b"".join(r.ljust(wide, b"\0") for r in raw), np.uint8).reshape(len(raw), wide), size


def _counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts; the column of the padding is left out."""
    rows = np.repeat(np.arange(len(codes)) * 256, codes.shape[1])
    return np.bincount(rows + codes.ravel(), minlength=256 * len(codes)).reshape(-1, 256)[:, 1:]


def near_pairs(a: list[str], b: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (in ``a``, in ``b``) of the pairs one edit apart. All words of
    ``a`` have one length, those of ``b`` that length or one letter more."""
    ca, la = _codes(a)
    cb, lb = _codes(b)
    na, nb = _counts(ca), _counts(cb)
    used = na.any(axis=0) | nb.any(axis=0)
    length = int(la[0])
    kind = np.float32 if length < 2000 else np.float64  # sums of squares stay exact
    na, nb = na[:, used].astype(kind), nb[:, used].astype(kind)
    own, other = (na * na).sum(axis=1), (nb * nb).sum(axis=1)
    step = max(1, 4_000_000 // len(b))
    for lo in range(0, len(a), step):
        gram = na[lo:lo + step] @ nb.T
        squared = own[lo:lo + step, None] + other[None, :] - 2 * gram
        i, j = np.nonzero(squared <= 2)
        i += lo
        for k in range(0, len(i), 100_000):
            x, y = i[k:k + 100_000], j[k:k + 100_000]
            same = ca[x, :length] == cb[y, :length]
            replaced = (lb[y] == length) & (same.sum(axis=1) == length - 1)
            ahead = np.where(same.all(axis=1), length, same.argmin(axis=1))
            if cb.shape[1] > length:
                back = (ca[x, :length] == cb[y, 1:length + 1])[:, ::-1]
                behind = np.where(back.all(axis=1), length, back.argmin(axis=1))
                inserted = (lb[y] == length + 1) & (ahead + behind >= length)
            else:
                inserted = np.zeros(len(x), bool)
            keep = replaced | inserted
            yield x[keep], y[keep]


def _partners(own: list[tuple[int, str, int]], others: list[tuple[int, str, int]]) -> list[tuple]:
    """What the words (role, word, n) of a task say of each other: word, near
    words, the best of them and its n. Words of the same block speak for
    themselves in the task where they are its own."""
    found: dict[str, list] = {}

    def note(word: str, other: str, n: int) -> None:
        held = found.setdefault(word, [0, other, n])
        held[0] += 1
        if (-n, other) < (-held[2], held[1]):
            held[1:] = other, n

    for x, y in near_pairs([r[1] for r in own], [r[1] for r in others]):
        for i, j in zip(x.tolist(), y.tolist()):
            (_, a, n), (role, b, m) = own[i], others[j]
            note(a, b, m)
            if role == 2:
                note(b, a, n)
    return [(w, *held) for w, held in found.items()]


def variants(words: DataFrame, ratio: int = 5, classes: int = 6) -> DataFrame:
    """Group the spellings of words (``word, n``; distinct words of letters
    a-z and U+00C0 to U+00FF). Returns one row per word: ``word, n, n_near``
    (words exactly one edit away), ``form, form_n`` (the most frequent of
    them, if it is ``ratio`` times as frequent as the word, else null) and
    ``root`` (where following the forms ends; the word itself without one).
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    rows = cut(words.select("word", "n"))
    near = cut(near_words(rows, classes))
    named = (rows.join(near, "word", "left")
             .withColumn("keep", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(F.col("keep"), F.col("form")).alias("form"),
                     F.when(F.col("keep"), F.col("form_n")).alias("form_n")))
    roots = cut(named.where("form is not null").select("word", F.col("form").alias("root")))
    # Every step doubles the way followed; counts grow by the ratio, so ways are short.
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = cut(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")))
        roots = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                    "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_letters: int = 6, min_count: int = 5, ratio: int = 5,
                      spoil: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spelling variants of the words of all texts: maximal runs of a-z, A-Z
    (lower-cased) and U+00C0 to U+00FF with ``min_letters`` letters that occur
    ``min_count`` times or more; see ``word_counts`` for ``spoil`` and
    ``variants`` for the columns. Null and empty texts hold no words, rows
    that repeat count again, an empty table gives no rows; other columns play
    no part, and no text, word or block is cut short or left out."""
    counts = word_counts(docs, min_letters, spoil, id_col, text_col)
    return variants(counts.where(F.col("n") >= min_count), ratio)
