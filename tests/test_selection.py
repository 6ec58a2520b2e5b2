"""Order statistics by counting, range-dealt running sums, two-pass under-sampling."""

import math
import random

import pytest
from pyspark.sql import functions as F

from txrisk.functions import ranking
from txrisk.functions.draws import draw
from txrisk.functions.ranking import exact_quantiles, global_prefix_sum, values_at_ranks
from txrisk.operators.sampling import oversample, undersample


def test_nan_infinities_and_one_frequent_value(spark, monkeypatch):
    rng = random.Random(3)
    vals = [float("nan")] * 200 + [1.0] * 900 + [float("inf"), float("-inf"), -0.0, 0.0, 5e-324, -5e-324, 1.7e308]
    vals += [rng.uniform(-3, 3) * 10 ** rng.randint(-300, 300) for _ in range(400)]
    passes = []
    hits = ranking._hits
    monkeypatch.setattr(ranking, "_hits", lambda *a: passes.append(1) or hits(*a))
    df = spark.createDataFrame([(v,) for v in [*vals, None]], "v double")
    order = sorted(vals, key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
    want = spark.range(0, len(vals), 37).select(F.col("id").alias("rank"))
    for max_rows in (0, 5, 10_000):
        passes.clear()
        got = {r["rank"]: r["value"] for r in values_at_ranks(df, [], "v", want, max_rows=max_rows).collect()}
        assert len(got) == len(range(0, len(vals), 37)) and len(passes) <= 4
        for r, v in got.items():
            assert v == order[r] or (math.isnan(v) and math.isnan(order[r]))


def test_longs_beyond_doubles_and_ranks_beyond_the_group(spark):
    base = 1 << 60
    df = spark.range(base, base + 3000).select(F.col("id").alias("v"))
    want = spark.createDataFrame([(0,), (1,), (1499,), (2999,), (3000,)], "rank long")
    got = {r["rank"]: r["value"] for r in values_at_ranks(df, [], "v", want, max_rows=10).collect()}
    assert got == {0: base, 1: base + 1, 1499: base + 1499, 2999: base + 2999}


def test_quantiles_of_empty_and_single(spark):
    empty = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(empty, ["g"], "v", [0.5]).count() == 0
    one = spark.createDataFrame([(1, 4.0), (2, None)], "g int, v double")
    assert [tuple(r) for r in exact_quantiles(one, ["g"], "v", [0.0, 0.5, 1.0]).orderBy("p").collect()] == [
        (1, 0.0, 4.0), (1, 0.5, 4.0), (1, 1.0, 4.0)]


def test_running_sums_over_strings_and_one_task_never_holds_all(spark):
    rows = [(f"k{i:04d}", i % 5) for i in range(1000)]
    out = global_prefix_sum(spark.createDataFrame(rows, "k string, c long").repartition(6), "k", ["c"], n_ranges=7)
    got = {r["k"]: r["cum_c"] for r in out.collect()}
    total = 0
    for k, c in rows:
        total += c
        assert got[k] == total
    text = out._jdf.queryExecution().toString()
    assert "percentile_approx" not in text and "SinglePartition" not in text.split("== Optimized")[0]


def test_undersample_is_a_filter_after_two_passes(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 10 < 3, 1).when(F.col("id") % 10 < 5, 2).otherwise(0).alias("y"))
    df = df.union(spark.createDataFrame([(30000, None)], "id long, y int"))
    out = undersample(df, "y", "id")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["id"], r["y"]) for r in out.collect()}
    rows = [(r["id"], r["y"], r["d"]) for r in df.withColumn("d", draw(F.col("id"))).collect()]
    want = {(30000, None)}
    for c in (0, 1, 2):
        mine = sorted((d, i) for i, y, d in rows if y == c)
        want |= {(i, c) for _, i in mine[:4000]}
    assert got == want
    with pytest.raises(ValueError):
        undersample(df.where("y = 1"), "y", "id")


def test_oversample_of_string_ids(spark):
    df = spark.createDataFrame([(f"id{i}", int(i < 5)) for i in range(30)], "id string, y int")
    out = oversample(df, "y", "id")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 25, 1: 25}
