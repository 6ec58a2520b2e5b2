import numpy as np
import pytest

from txrisk.functions.ranking import exact_quantiles, global_prefix_sum


def test_exact_quantiles_with_heavy_ties(spark):
    rng = np.random.default_rng(5)
    a = np.r_[np.zeros(500), rng.uniform(0, 10, 700).round(1)]
    b = rng.normal(3, 2, 333)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["value"] for r in exact_quantiles(df, ["g"], "v", [0.1, 0.25, 0.5, 0.9], 16).collect()}
    for g, arr in (("a", a), ("b", b)):
        for p in (0.1, 0.25, 0.5, 0.9):
            assert got[(g, p)] == pytest.approx(np.quantile(arr, p))


def test_global_prefix_sum(spark):
    rows = [(float(i), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "s double, c long")
    got = {r["s"]: r["cum_c"] for r in global_prefix_sum(df, "s", ["c"], n_ranges=8).collect()}
    cum = np.cumsum([c for _, c in rows])
    assert all(got[float(i)] == cum[i] for i in range(400))


def test_values_at_ranks_refines_large_buckets(spark):
    from txrisk.functions.ranking import values_at_ranks
    rng = np.random.default_rng(11)
    vals = rng.normal(0, 1, 3000)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    targets = spark.createDataFrame([(r,) for r in (0, 1, 1499, 2998, 2999)], "rank long")
    # tiny max_rows forces several refinement levels
    got = {r["rank"]: r["value"] for r in values_at_ranks(df, [], "v", targets, max_rows=10).collect()}
    s = np.sort(vals)
    assert got == {r: pytest.approx(s[r]) for r in (0, 1, 1499, 2998, 2999)}
