"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with FTRL-proximal and elastic-net penalties, then
temperature-calibrated.

Document frequencies cover every training document; only the fit itself uses
a bounded sample of labelled rows (``sample_per_lang``). Weights, document
frequencies and the sample are bounded by the feature space, the number of
languages and that parameter, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Feature space (hashed n-grams of one to three code points).
FEATURES = 1 << 16
SIZES = (1, 2, 3)
_STEP = 1 << 20  # code points counted at a time, so that long texts need no more memory


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram features of a whole text and how often each occurs."""
    total = np.zeros(FEATURES, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for lo in range(0, len(points), _STEP):
        part = points[lo:lo + _STEP + max(SIZES) - 1].astype(np.uint64)
        gram = np.zeros(len(part), np.uint64)
        for size in SIZES:
            if len(part) < size:
                break
            gram = gram[:len(part) - size + 1] * np.uint64(0x100000001B3) + part[size - 1:] + np.uint64(size)
            own = gram[:_STEP]  # n-grams that start in this step
            h = own * np.uint64(0x9E3779B97F4A7C15)
            total += np.bincount((h >> np.uint64(48)).astype(np.int64), minlength=FEATURES)
    at = np.nonzero(total)[0]
    return at, total[at]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # by feature
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return _weighted(*counts(text), self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its calibrated probability; ``und`` and 0 without a
        letter, or where nothing could be learnt."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        at, x = self.vector(text)
        p = _softmax((self.bias + x @ self.weights[at]) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _weighted(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (1 + np.log(n)) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, rounds: int,
          alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate FTRL-proximal (McMahan et al. 2013); the bias carries no penalty."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(at):
        penalised = (at < FEATURES)[:, None]
        w = -(z[at] - np.sign(z[at]) * l1 * penalised) / ((beta + np.sqrt(n[at])) / alpha + l2 * penalised)
        return np.where(penalised & (np.abs(z[at]) <= l1), 0.0, w)

    rng = np.random.default_rng(5)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    every = weights(np.arange(FEATURES + 1))
    return every[:-1], every[-1]


def train(docs: DataFrame, sample_per_lang: int = 600, rounds: int = 4, alpha: float = 0.5,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, lang_col: str = "lang",
          text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Fit on the rows of ``docs`` that have a language and a text with a letter.

    Document frequencies are counted over all of them. The regression is
    fitted in one task on about ``sample_per_lang`` rows of each language
    (all, if fewer), picked by a hash of their ids; a fifth of the sample is
    kept back to set the temperature. No such rows give a model that answers
    ``und``.
    """
    rows = (docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"),
                        F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}")))

    def document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for t in batch.column("t").to_pylist():
                total[counts(t)[0]] += 1
                n += 1
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["feature", "n"])

    # A map-side sum of fixed size per task, added up by Spark.
    frequency = np.zeros(FEATURES + 1)
    for r in (rows.select("t").mapInArrow(document_frequency, "feature long, n long")
              .groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator()):
        frequency[r["feature"]] = r["n"]
    idf = np.where(frequency[:-1] > 0, np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1, 0.0)

    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    none = Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    if not langs:
        return none
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_per_lang / sizes[lang]))).otherwise(share)
    # Uniform in [0, 1) by id, so the sample is the same in every run.
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.coalesce("i", "t")), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(draw < share).withColumn("draw", F.xxhash64(F.lit("order"), F.coalesce("i", "t")))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_weighted(*counts(t), idf) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("draw"),
                 pa.array([a.astype(np.uint16).tobytes() for a, _ in found], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary())],
                names=["lang", "draw", "at", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("draw", "lang", "at", "x")))]
        data.sort(key=lambda r: r[:2])
        rows = [(np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(x, np.float32).astype(np.float64),
                 langs.index(lang)) for _, lang, a, x in data]
        held = rows[::5] if len(rows) >= 10 else rows
        w, b = _ftrl([r for i, r in enumerate(rows) if i % 5] if len(rows) >= 10 else rows,
                     len(langs), rounds, alpha, beta, l1, l2)
        scores = np.array([b + x @ w[at] for at, x, _ in held])
        y = np.array([k for _, _, k in held])

        # Targets just short of certainty (Platt): with no error among n rows
        # the temperature stays finite.
        target = np.full((len(y), len(langs)), 1 / (len(y) + 2) / max(1, len(langs) - 1))
        target[np.arange(len(y)), y] = 1 - 1 / (len(y) + 2)

        def loss(t):
            return -(target * np.log(np.maximum(_softmax(scores / t), 1e-300))).sum(axis=1).mean()
        temperature = min(np.geomspace(0.05, 5, 200), key=loss)
        at = np.nonzero(w.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype(np.int32).tobytes()]), pa.array([w[at].astype(np.float32).tobytes()]),
             pa.array([b.tobytes()]), pa.array([float(temperature)])], names=["at", "w", "b", "temperature"])

    got = (sample.select("t", "lang", "draw").mapInArrow(featured, "lang string, draw long, at binary, x binary")
           .repartition(1).mapInArrow(fit, "at binary, w binary, b binary, temperature double").first())
    weights = np.zeros((FEATURES, len(langs)), np.float32)
    weights[np.frombuffer(got["at"], np.int32)] = np.frombuffer(got["w"], np.float32).reshape(-1, len(langs))
    return Model(langs, idf.astype(np.float32), weights, np.frombuffer(got["b"], np.float64), got["temperature"])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text, and the columns
    ``keep``, which no prediction sees. Null text and text without a letter
    give ``und`` with score 0. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: features x languages

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = zip(*map(shared.value.predict, batch.column("t").to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 *(batch.column(c) for c in keep)], names=["doc_id", "lang_pred", "score", *keep])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"),
                         *(F.col(c) for c in keep))
    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return source.mapInArrow(work, "doc_id long, lang_pred string, score double" + kept)


def accepted(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a
    calibrated probability of ``min_score`` or more. ``und`` goes. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(shared.value.predict, batch.column(text_col).to_pylist())
            yield batch.filter(pa.array([lang != "und" and p >= min_score for lang, p in found], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
