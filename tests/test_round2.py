"""Cases where rows or values were lost: each compares with a value by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.functions.ranking import global_prefix_sum, values_at_ranks
from txrisk.plans.experiments import require_ok, run_grid
from txrisk.sources.feature_store import FeatureStore
from txrisk.sources.ingest import prepare, read_typed_csv
from txrisk.streaming.daily import stage_by_day, stream_daily_counts


def test_daily_counts_take_every_row_of_many_files(spark, tmp_path):
    df = spark.range(2000).select((F.pmod(F.xxhash64("id"), F.lit(40 * 86400))).alias("TransactionDT"),
                                  (F.col("id") % 2).cast("int").alias("isFraud"))
    stage_by_day(df.repartition(8), f"{tmp_path}/d")
    out = stream_daily_counts(spark, f"{tmp_path}/d", f"{tmp_path}/o", f"{tmp_path}/c", files_per_trigger=30)
    assert out.agg(F.sum("n")).head()[0] == 2000


def test_ranks_beside_a_heavy_value(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, *[5] * 3000, 7, 8]], "v double")
    want = spark.createDataFrame([(r,) for r in (0, 1, 2, 3, 3002, 3003, 3004)], "rank long")
    got = {r["rank"]: r["value"] for r in values_at_ranks(df, [], "v", want, max_rows=1).collect()}
    assert got == {0: 1.0, 1: 2.0, 2: 3.0, 3: 5.0, 3002: 5.0, 3003: 7.0, 3004: 8.0}


def test_row_numbers_above_2_53(spark):
    base = 2 ** 53
    df = spark.range(base + 1, base + 301).select(F.col("id"), F.lit(1).alias("one")).repartition(5)
    got = global_prefix_sum(df, "id", ["one"]).orderBy("id").collect()
    assert [r["cum_one"] for r in got] == list(range(1, 301))


def test_declared_null_is_coded_last_after_imputation(spark):
    df = spark.createDataFrame([(1, 0, 0, 1.0, "b"), (2, 0, 9, 1.0, None), (3, 1, 9, 2.0, "a"), (4, 0, 9, 2.0, "z")],
                               "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string")
    got = [r["ProductCD"] for r in prepare(df).orderBy("TransactionID").collect()]
    assert got == [1, 3, 0, 2]


def test_store_recomputes_for_other_keys(spark, tmp_path):
    store = FeatureStore(spark, root=str(tmp_path))
    rows = [(i, 1000 * i, 1.0, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, TransactionAmt double, card1 int")
    one, names = store.create_features(df, [1], keys=["card1"])
    count = next(n for n in names if "count" in n.lower())
    assert [r[count] for r in one.orderBy("TransactionID").collect()] == [0, 1, 2, 3]
    two, _ = store.create_features(df.withColumn("card1", F.col("TransactionID").cast("int")), [1], keys=["card1"])
    assert [r[count] for r in two.orderBy("TransactionID").collect()] == [0, 0, 0, 0]


def test_csv_quotes_and_malformed_cells(spark, tmp_path):
    from pyspark.sql import types as T
    (tmp_path / "a.csv").write_text('k,s\n1,"a ""b"" c"\nx9,d\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    got = read_typed_csv(spark, f"{tmp_path}/a.csv", schema, on_malformed="null").collect()
    assert [(r["k"], r["s"]) for r in got] == [(1, 'a "b" c'), (None, "d")]
    with pytest.raises(Exception, match="x9"):
        read_typed_csv(spark, f"{tmp_path}/a.csv", schema).collect()


def test_failed_runs_are_raised(spark):
    df = spark.createDataFrame([(1, 0, 0, 1.0)], "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double")
    res = run_grid(spark, df, ["baseline"], model_type="nothing")
    assert res.head()["status"] == "error"
    with pytest.raises(RuntimeError):
        require_ok(res)


def _spread(spark, rows, c, mode):
    from txrisk.operators.rolling import rolling_features
    df = spark.createDataFrame(rows, "id long, dt long, k string, v double")
    return {r["id"]: r["k_v_std_7d"] for r in rolling_features(
        df, id_col="id", time_col="dt", value_col="v", keys=["k"], windows_days=[7], chunk_seconds=c,
        between_mode=mode, plain_rows=0).collect()}


@pytest.mark.parametrize("mode", ["frames", "blocks"])
def test_std_of_a_tiny_spread_on_a_large_offset(spark, mode):
    """Also where the level of the values jumps within a key's history."""
    rows = [(i, i * 14400, "a", 1e9 + (0.005 if i % 2 else -0.005)) for i in range(40)]
    rows += [(100 + i, i * 14400 + (30 * 86400 if i >= 20 else 0), "b",
              (0.0 if i < 20 else 1e9) + (0.005 if i % 2 else -0.005)) for i in range(40)]
    got = _spread(spark, rows, 21600, mode)
    by_id = {r[0]: r for r in rows}
    for i, t, k, v in rows:
        seen = np.array([x[3] for x in by_id.values() if x[2] == k and t - 7 * 86400 <= x[1] and
                         (x[1], x[0]) < (t, i)])
        want = float(np.std(seen - seen[0])) if len(seen) else 0.0
        assert abs(got[i] - want) < 1e-6, (mode, i, got[i], want)


def test_chunk_width_follows_the_fullest_chunk(spark):
    """A key whose rows all fall into one minute of a long history."""
    from txrisk.operators.rolling import auto_chunk_seconds
    rows = [("a", 86400 * 300 + i % 40) for i in range(400)] + [("a", 86400 * i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, dt long")
    assert auto_chunk_seconds(df, ["k"], "dt", [1], target_rows=1000) == 86400
    assert auto_chunk_seconds(df, ["k"], "dt", [1], target_rows=100) == 10
    assert auto_chunk_seconds(df, ["k"], "dt", [1], target_rows=1) == 1


def test_first_detection_from_window_sums_equals_the_scan(spark):
    from txrisk.operators.drift import detection_margins, drift_scan, first_detection
    rng = np.random.default_rng(3)
    rows = [("shift", i, float(rng.random() < (0.1 if i < 60 else 0.9))) for i in range(150)]
    rows += [("flat", i, float(rng.random() < 0.3)) for i in range(150)] + [("short", i, 0.5) for i in range(4)]
    df = spark.createDataFrame(rows, "s string, p long, v double")
    out = [{r["series"]: (r["n"], r["first_pos"], None if r["max_margin"] is None else round(r["max_margin"], 9))
            for r in first_detection(x).collect()}
           for x in (detection_margins(df, "s", "p", "v"), drift_scan(df, "s", "p", "v"))]
    assert out[0] == out[1]
    assert 60 <= out[0]["shift"][1] < 150 and out[0]["flat"][1] is None and out[0]["short"] == (4, None, None)
