"""Isolation forest properties (no reference numbers exist without the
original library): seeded, ~10 % flagged on training data, injected
outliers found, too-small devices get no model."""

import numpy as np

from driftwood.operators import ml


def _data(spark, n=400, outliers=5, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        t, h, p, v = rng.normal([22, 50, 1000, 5], [1, 3, 5, 1])
        rows.append(("dev", i, float(t), float(h), float(p), float(v)))
    for j in range(outliers):
        rows.append(("dev", n + j, 90.0, 99.0, 1300.0, 150.0))
    for k in range(5):                       # a device below the minimum
        rows.append(("tiny", 10_000 + k, 20.0, 50.0, 1000.0, 1.0))
    return spark.createDataFrame(rows, "device_id string, event_id long, temperature double, "
                                       "humidity double, pressure double, vibration double")


def test_forest_properties(spark):
    df = _data(spark)
    scaler, models = ml.fit_forests(df)
    m = models.collect()
    assert [r.device_id for r in m] == ["dev"]
    scored = {r.event_id: r for r in ml.score_forests(df, scaler, models).collect()}
    assert all(scored[400 + j].is_anomaly for j in range(5))
    rate = np.mean([scored[i].is_anomaly for i in range(405)])
    assert 0.05 <= rate <= 0.15
    assert len(scored) == 410            # every row comes back
    assert all(scored[10_000 + k].anomaly_score is None and not scored[10_000 + k].is_anomaly
               for k in range(5))        # no scaler or model: not anomalous
    again = {r.event_id: r.anomaly_score for r in
             ml.score_forests(df, *ml.fit_forests(df)).collect()}
    assert all(abs(again[k] - scored[k].anomaly_score) < 1e-12 for k in scored if k < 10_000)


def test_c_factor():
    assert ml.c_factor(np.array([1.0, 2.0]))[1] == 1.0
    assert abs(ml.c_factor(np.array([256.0]))[0] - 10.2448) < 1e-3


def test_exact_quantile_against_numpy(spark):
    """Ties, negative and infinite ranges of sizes, single rows, nulls."""
    rng = np.random.default_rng(3)
    groups = {"normal": rng.normal(size=3000), "ties": rng.integers(0, 5, 800).astype(float), "one": np.array([4.5]),
              "two": np.array([1.0, 2.0]), "same": np.full(500, 7.25), "skew": np.exp(rng.normal(size=1000) * 5)}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("normal", None), ("nothing", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    for share in (0.9, 0.5, 0.0, 1.0, 0.37):
        got = {r.k: r.v for r in ml.exact_quantile(frame, "k", "v", share, buckets=7, few=20).collect()}
        assert got.keys() == groups.keys()
        for k, v in groups.items():
            assert abs(got[k] - np.quantile(v, share)) <= 1e-9 * max(1.0, abs(got[k]))
