"""Randomised checks against brute force (few examples: each one runs Spark jobs)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txrisk.functions.ranking import exact_quantiles
from txrisk.operators.rolling import rolling_features

from test_rolling import _brute

ROW = st.tuples(st.integers(0, 3 * 86400 // 1800).map(lambda x: x * 1800),   # half-hour grid: ties
                st.floats(0.5, 1000, allow_nan=False).map(lambda x: round(x, 2)),
                st.sampled_from([1, 1, 1, 2, 3, None]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=60), st.sampled_from(["frames", "blocks", "light"]))
def test_rolling_matches_brute_force(spark, rows, mode):
    data = [(i, t, a, k) for i, (t, a, k) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, dt long, amt double, k long")
    out = {r["id"]: r for r in rolling_features(df, id_col="id", time_col="dt", value_col="amt",
                                                keys=["k"], windows_days=[1, 2], chunk_seconds=3600,
                                                between_mode="auto" if mode == "light" else mode,
                                                plain_rows=1000 if mode == "light" else 0).collect()}
    for d in (1, 2):
        for i, (n, m, sd, mn, mx) in _brute(data, d * 86400).items():
            r = out[i]
            assert r[f"k_id_count_{d}d"] == n
            assert r[f"k_amt_mean_{d}d"] == pytest.approx(m, abs=1e-9)
            assert r[f"k_amt_std_{d}d"] == pytest.approx(sd, abs=1e-6)
            assert (r[f"k_amt_min_{d}d"], r[f"k_amt_max_{d}d"]) == pytest.approx((mn, mx))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 20), min_size=1, max_size=200))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r["p"]: r["value"] for r in exact_quantiles(df, [], "v", [0.0, 0.25, 0.5, 0.9, 1.0], 8).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(np.array(values, dtype=float), p))


SCORED = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20).map(lambda x: x / 20.0)),
                  min_size=2, max_size=80)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(SCORED)
def test_metrics_match_definitions(spark, rows):
    from txrisk.functions.thresholds import THRESHOLDS
    from txrisk.operators.metrics import average_precision, roc_auc, threshold_sweep
    df = spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], "id long, y int, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = roc_auc(df).first()["auc"]
    if pos and neg:
        exp = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        assert auc == pytest.approx(exp)
    else:
        assert auc is None
    ap = average_precision(df).first()["average_precision"]
    if pos:
        exp_ap = 0.0
        for t in sorted({s for _, s in rows}, reverse=True):
            sel = [y for y, s in rows if s >= t]
            tp_t = sum(y for y, s in rows if s == t)
            exp_ap += tp_t / len(pos) * sum(sel) / len(sel)
        assert ap == pytest.approx(exp_ap)
    got = {r["threshold"]: r for r in threshold_sweep(df).collect()}
    for t in THRESHOLDS:
        pred = [int(s >= t) for _, s in rows]
        if sum(pred) in (0, len(pred)):
            assert t not in got
            continue
        tp = sum(p and y for p, (y, _) in zip(pred, rows))
        fp = sum(p and not y for p, (y, _) in zip(pred, rows))
        fn = sum((not p) and y for p, (y, _) in zip(pred, rows))
        assert got[t]["precision"] == pytest.approx(tp / (tp + fp))
        assert got[t]["recall"] == pytest.approx(tp / (tp + fn) if tp + fn else 0.0)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=6, max_size=60))
def test_knn_with_duplicate_points(spark, pts):
    from txrisk.operators.knn import knn
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)],
                               "id long, vec array<double>")
    got = {}
    for r in knn(df, 3, n_pivots=3, block_size=7).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"], r["distance"]))
    arr = np.array(pts, dtype=float)
    for i in range(len(pts)):
        d = np.sqrt(((arr - arr[i]) ** 2).sum(1))
        order = sorted((j for j in range(len(pts)) if j != i), key=lambda j: (d[j], j))[:3]
        assert [nid for _, nid, _ in sorted(got[i])] == order


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([0, 0, 0, 1, 2]), min_size=5, max_size=120))
def test_undersample_multiclass(spark, labels):
    from txrisk.operators.sampling import undersample
    if len(set(labels)) < 2:
        return
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id long, y int")
    out = undersample(df, "y", "id")
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    n_min = min(labels.count(c) for c in set(labels))
    assert counts == {c: n_min for c in set(labels)}
    assert out.select("id").distinct().count() == out.count()
