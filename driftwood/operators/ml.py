"""Per-device learned anomaly detection (ML-1..4, JOI-2).

* ML-1: feature vector (temperature, humidity, pressure, vibration), a
  missing reading counts as 0.
* ML-2: per-device standard scaling: mean and population deviation from a
  plain aggregate over all rows (zero deviation -> 1).
* ML-3: per-device isolation forest (Liu, Ting, Zhou 2008): 100 trees, each
  grown on min(256, n) points with height limit ceil(log2(size)); the
  anomaly score is 2^(-E[h(x)] / c(size)). A device needs at least 10 rows.
  The anomaly threshold is the score quantile at 1 - contamination over the
  device's rows (about 10 % of them are flagged).
* ML-4: scoring evaluates each device's trees with numpy on Arrow batches; a
  row of a device without a model, or without a device, is not anomalous.

Scale: each tree's 256 points are drawn from all rows of its device by a
seeded hash per (tree, row); what passes is little more than 256 rows a tree
however many the device has, and only that reaches ``applyInPandas``. The
threshold is a quantile over the scores of all rows. Scoring splits each
device's rows into hash chunks of bounded size (their number follows the
device's row count, so a device with a third of all rows spreads over many
tasks), joins the model once per chunk (never onto each row) and scores
chunks with ``mapInArrow``; models are decoded once per device per task.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.session import ensure_checkpoint_dir

FEATURES = ("temperature", "humidity", "pressure", "vibration")
N_TREES = 100
SAMPLE = 256
CONTAMINATION = 0.1
MIN_ROWS = 10
SEED = 42
EULER = 0.5772156649

MODEL_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("sample_size", T.LongType()),
    T.StructField("trees", T.BinaryType()),
])


def feature_vector(df: DataFrame, features=FEATURES) -> DataFrame:
    """ML-1: missing readings count as 0."""
    return df.select("*", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f_{f}")
                            for f in features])


def device_scaler(df: DataFrame, key: str = "device_id", features=FEATURES) -> DataFrame:
    """ML-2: per-device mean and population deviation (0 -> 1)."""
    v = feature_vector(df, features)
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        aggs += [F.avg(f"_f_{f}").alias(f"mean_{f}"), F.stddev_pop(f"_f_{f}").alias(f"_sd_{f}")]
    s = v.groupBy(key).agg(*aggs)
    for f in features:
        s = s.withColumn(f"std_{f}", F.when(F.col(f"_sd_{f}") == 0, F.lit(1.0))
                         .otherwise(F.col(f"_sd_{f}"))).drop(f"_sd_{f}")
    return s


def scaled(df: DataFrame, scaler: DataFrame, key: str = "device_id",
           features=FEATURES) -> DataFrame:
    """Rows with standardised features ``_z_<feature>`` (JOI-2, a left join:
    they are null for a device without a scaler, which has no model either)."""
    v = feature_vector(df, features).join(scaler, key, "left")
    return v.select("*", *[((F.col(f"_f_{f}") - F.col(f"mean_{f}")) / F.col(f"std_{f}"))
                           .alias(f"_z_{f}") for f in features])


def c_factor(n):
    """Average path length of an unsuccessful search in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int):
    """One isolation tree as flat arrays (feature, split, left, right, size)."""
    feat, split, left, right, size = [], [], [], [], []
    stack = [(np.arange(len(x)), 0, -1, 0)]
    while stack:
        idx, depth, parent, side = stack.pop()
        node = len(feat)
        if parent >= 0:
            (left if side == 0 else right)[parent] = node
        feat.append(-1)
        split.append(0.0)
        left.append(-1)
        right.append(-1)
        size.append(len(idx))
        if depth >= limit or len(idx) <= 1:
            continue
        pts = x[idx]
        lo, hi = pts.min(axis=0), pts.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        q = int(rng.choice(usable))
        p = float(rng.uniform(lo[q], hi[q]))
        go_left = pts[:, q] < p
        feat[node], split[node] = q, p
        stack.append((idx[~go_left], depth + 1, node, 1))
        stack.append((idx[go_left], depth + 1, node, 0))
    return (np.array(feat, np.int8), np.array(split, np.float64), np.array(left, np.int16),
            np.array(right, np.int16), np.array(size, np.int16))


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    feat, split, left, right, size = tree
    node = np.zeros(len(x), dtype=np.int64)
    depth = np.zeros(len(x))
    active = feat[node] >= 0
    while active.any():
        i = np.flatnonzero(active)
        n = node[i]
        go_left = x[i, feat[n]] < split[n]
        node[i] = np.where(go_left, left[n], right[n])
        depth[i] += 1
        active = feat[node] >= 0
    return depth + c_factor(size[node])


def forest_scores(x: np.ndarray, trees, sample_size: int) -> np.ndarray:
    mean_h = np.mean([_path_lengths(x, t) for t in trees], axis=0)
    return np.power(2.0, -mean_h / c_factor(np.array([float(sample_size)]))[0])


def _pack(trees) -> bytes:
    """All trees as five concatenated arrays plus per-tree node offsets."""
    buf = io.BytesIO()
    parts = list(zip(*trees))
    sizes = np.array([len(t[0]) for t in trees], dtype=np.int64)
    np.savez(buf, offsets=np.concatenate([[0], np.cumsum(sizes)]),
             **{name: np.concatenate(arrs) for name, arrs in zip("fslrn", parts)})
    return buf.getvalue()


def _unpack(blob: bytes):
    z = np.load(io.BytesIO(blob))
    off = z["offsets"]
    cols = [z[name] for name in "fslrn"]
    return [tuple(c[off[t]:off[t + 1]] for c in cols) for t in range(len(off) - 1)]


def _device_seed(device: str, seed: int) -> int:
    h = 0
    for ch in str(device):
        h = (h * 131 + ord(ch)) % 2_147_483_647
    return (h + seed) % 2_147_483_647


def fit_forests(df: DataFrame, key: str = "device_id", features=FEATURES,
                contamination: float = CONTAMINATION, seed: int = SEED,
                min_rows: int = MIN_ROWS, n_trees: int = N_TREES,
                sample: int = SAMPLE, order_key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """ML-2/3: returns (scaler, models). ``order_key`` identifies rows for
    the seeded hash sample (deterministic for a given seed)."""
    scaler = device_scaler(df, key, features).where(F.col("n") >= min_rows)
    ensure_checkpoint_dir(df.sparkSession)
    scaler = scaler.checkpoint(eager=True)
    zcols = [f"_z_{f}" for f in features]
    # A row joins tree t if its hash for t is below a share of the device's
    # rows that gives the tree its points and a margin of over six standard
    # deviations; the smallest hashes among these are the tree's sample.
    share = F.least(F.lit(1.0), F.lit(sample + 7 * sample ** 0.5 + 20) / F.col("n"))
    bound = (share * F.lit(float(1 << 32))).cast("long")
    draw = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.xxhash64(F.lit(seed), t, F.col(order_key)).bitwiseAND(F.lit((1 << 32) - 1)).alias("h")))
    drawn = (scaled(df, scaler, key, features).where(F.col("n").isNotNull())
             .select(key, "n", order_key, *zcols, F.inline(F.filter(draw, lambda d: d["h"] < bound))))
    rank = Window.partitionBy(key, "tree").orderBy("h", order_key)
    train = (drawn.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= sample)
             .select(key, F.col("n").alias("_n_all"), "tree", "_r", *zcols))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        device = pdf[key].iloc[0]
        rng = np.random.default_rng(_device_seed(device, seed))
        psi = int(min(sample, pdf["_n_all"].iloc[0]))
        limit = int(np.ceil(np.log2(max(psi, 2))))
        trees = [_grow(part[zcols].to_numpy(dtype=float), rng, limit)
                 for _, part in pdf.sort_values(["tree", "_r"]).groupby("tree")]
        return pd.DataFrame({key: [device], "n_train": [int(pdf["_n_all"].iloc[0])],
                             "sample_size": [psi], "trees": [_pack(trees)]})

    # Fitting is an action, as an estimator's fit is: the scaler and the
    # forests are written once (reliable checkpoints in the shared folder),
    # so scoring reads them instead of retraining, and a lost executor does
    # not retrain either.
    forests = train.groupBy(key).applyInPandas(
        fit, f"{key} string, n_train long, sample_size long, trees binary").checkpoint(eager=True)
    scores = score_forests(df, scaler, forests.withColumn("threshold", F.lit(None).cast("double")),
                           key, features, (order_key,))
    thresholds = exact_quantile(scores, key, "anomaly_score", 1.0 - contamination).withColumnRenamed(
        "anomaly_score", "threshold")
    models = forests.join(thresholds, key).select(*MODEL_SCHEMA.fieldNames()).checkpoint(eager=True)
    return scaler, models


def exact_quantile(rows: DataFrame, key: str, value: str, share: float, buckets: int = 1000,
                   few: int = 10_000) -> DataFrame:
    """The exact quantile of ``value`` per ``key``, interpolated between the
    two values next to rank ``(n - 1) * share``; nulls do not count.

    Ranks are selected by refinement: every round counts the values between
    two bounds per bucket, combined before the shuffle, and goes on within
    the bucket that holds the rank, so no key's values are gathered or sorted.
    What is left is ordered once a bucket has at most ``few`` values; equal
    values need no order.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    v = rows.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_v")).checkpoint(eager=True)
    left = v.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = left.select(key, "_n", "_lo", "_hi", F.floor((F.col("_n") - 1) * F.lit(share)).alias("_rank"),
                        F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_in")).checkpoint(eager=True)
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    while not state.where((F.col("_in") > few) & (F.col("_lo") < F.col("_hi"))).isEmpty():
        place = F.when(F.col("_lo") == F.col("_hi"), F.lit(0)).otherwise(F.least(F.lit(buckets - 1), F.floor(
            (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets))).cast("int")
        parts = (v.join(state, key).where(inside).groupBy(key, "_n", "_rank", "_before", place.alias("_place"))
                 .agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
        upto = F.col("_before") + F.sum("_in").over(Window.partitionBy(key).orderBy("_place"))
        state = (parts.withColumn("_upto", upto)
                 .where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_in") <= F.col("_rank")))
                 .withColumn("_before", F.col("_upto") - F.col("_in")).drop("_place", "_upto").checkpoint(eager=True))
    order = Window.partitionBy(key).orderBy("_v")
    found = (v.join(state.where("_lo < _hi"), key).where(inside)
             .withColumn("_at", F.col("_before") + F.row_number().over(order) - 1)
             .where(F.col("_at") == F.col("_rank")).select(key, "_n", "_rank", F.col("_v").alias("_s"))
             .unionByName(state.where("_lo = _hi").select(key, "_n", "_rank", F.col("_lo").alias("_s"))))
    beside = (v.join(found, key).groupBy(key, "_n", "_rank", "_s")
              .agg(F.count_if(F.col("_v") <= F.col("_s")).alias("_c"),
                   F.min(F.when(F.col("_v") > F.col("_s"), F.col("_v"))).alias("_next")))
    part = (F.col("_n") - 1) * F.lit(share) - F.col("_rank")
    after = F.when(F.col("_c") > F.col("_rank") + 1, F.col("_s")).otherwise(F.coalesce("_next", "_s"))
    return beside.select(key, (F.col("_s") + part * (after - F.col("_s"))).alias(value))


def score_forests(df: DataFrame, scaler: DataFrame, models: DataFrame,
                  key: str = "device_id", features=FEATURES,
                  keep: tuple[str, ...] = ("event_id",),
                  chunk_rows: int = 10_000) -> DataFrame:
    """ML-4 / JOI-2: ``anomaly_score`` and ``is_anomaly`` per row, one output
    row for each input row; a row of a device without a model (too few rows,
    unseen, or a null id) has a null score and is not anomalous.

    Rows of a device are hash-split into chunks of at most about
    ``chunk_rows`` points (the chunk count follows the device's row count,
    so a hot device spreads over many tasks); the model is joined once per
    chunk, never copied onto each row, and ``mapInArrow`` scores a chunk's
    points as numpy arrays.
    """
    import pyarrow as pa

    every = scaled(df, scaler, key, features)
    # Rows without a model go past the packing: there is nothing to score.
    z = every.where(F.col("n").isNotNull())
    zcols = [f"_z_{f}" for f in features]
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(chunk_rows))).cast("long")
    z = z.withColumn("_chunk", F.pmod(F.xxhash64(*keep), n_chunks))
    chunks = (z.groupBy(key, "_chunk")
               .agg(F.collect_list(F.struct(*keep, *zcols)).alias("_pts")))
    joined = chunks.join(models.select(key, "threshold", "sample_size", "trees"), key, "left")
    key_field = df.schema[key]
    keep_fields = [df.schema[k] for k in keep]
    out_schema = T.StructType([key_field, *keep_fields,
                               T.StructField("anomaly_score", T.DoubleType()),
                               T.StructField("is_anomaly", T.BooleanType())])

    def score(batches):
        cache: dict = {}
        for rb in batches:
            pts = rb.column("_pts")
            flat = pts.flatten()
            offsets = pts.offsets.to_numpy()
            devices = rb.column(key).to_pylist()
            trees_col, thr_col = rb.column("trees"), rb.column("threshold").to_pylist()
            size_col = rb.column("sample_size").to_pylist()
            x_all = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False)
                                     for c in zcols]).astype(float)
            scores = np.full(len(flat), np.nan)
            flags = np.zeros(len(flat), dtype=bool)
            dev_out = []
            for i, device in enumerate(devices):
                a, b = int(offsets[i]), int(offsets[i + 1])
                dev_out.extend([device] * (b - a))
                blob = trees_col[i].as_py()
                if blob is None or b == a:
                    continue
                if device not in cache:
                    cache[device] = _unpack(blob)
                s = forest_scores(x_all[a:b], cache[device], int(size_col[i]))
                scores[a:b] = s
                if thr_col[i] is not None:
                    flags[a:b] = s > thr_col[i]
            cols = [pa.array(dev_out, type=pa.string())]
            cols += [flat.field(k) for k in keep]
            cols += [pa.array(scores, mask=np.isnan(scores)), pa.array(flags)]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *keep, "anomaly_score",
                                                          "is_anomaly"])

    plain = every.where(F.col("n").isNull()).select(
        key, *keep, F.lit(None).cast("double").alias("anomaly_score"), F.lit(False).alias("is_anomaly"))
    return joined.mapInArrow(score, schema=out_schema).unionByName(plain)
