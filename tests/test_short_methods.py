"""Heavy keys carry one running aggregate a row; wide projections run in compiled methods."""

from pyspark.sql import functions as F

from txrisk.operators import rolling
from txrisk.plans import experiments as ex
from txrisk.session import short_methods
from txrisk.sources.feature_store import FeatureStore

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _rows():
    day = 86400
    return [(i, None if i % 13 == 0 else (i * 5003) % (5 * day - 9000) // 600 * 600, None if i % 7 == 0 else float(i % 97), i % 2)
            for i in range(400)]


def _expected(rows, days):
    out = {}
    for i, t, _, k in rows:
        feats = []
        for d in days:
            mine = [] if t is None else [r for r in rows if r[3] == k and r[1] is not None
                                         and r[1] >= t - d * 86400 and (r[1], r[0]) < (t, i)]
            v = [r[2] for r in mine if r[2] is not None]
            mean = sum(v) / len(v) if v else 0.0
            std = (sum((x - mean) ** 2 for x in v) / len(v)) ** 0.5 if v else 0.0
            feats += [mean, std, min(v, default=0.0), max(v, default=0.0), len(mine)]
        out[i] = [round(x, 6) for x in feats]
    return out


def test_chunked_windows_with_ties_nulls_and_the_last_chunk(spark):
    rows, days = _rows(), [1, 2, 4]
    df = spark.createDataFrame(rows, "id long, dt long, amt double, k long")
    out = rolling.rolling_features(df, id_col="id", time_col="dt", value_col="amt", keys=["k"], windows_days=days,
                                   chunk_seconds=21600, plain_rows=0)
    assert {r[0]: [round(x, 6) for x in r[1:]] for r in out.collect()} == _expected(rows, days)


def test_running_aggregates_do_not_multiply_with_the_windows(spark):
    df = spark.createDataFrame(_rows(), "id long, dt long, amt double, k long")

    def spreads(days):
        out = rolling.rolling_features(df, id_col="id", time_col="dt", value_col="amt", keys=["k"], windows_days=days,
                                       chunk_seconds=86400, between_mode="blocks", plain_rows=0)
        return out._jdf.queryExecution().optimizedPlan().toString().count("var_pop")

    assert spreads([1, 2, 3, 4]) == spreads([1, 2])


def test_setting_holds_inside_and_is_restored(spark):
    before = spark.conf.get(LIMIT, None)
    with short_methods(spark):
        assert spark.conf.get(LIMIT) == "8000"
    assert spark.conf.get(LIMIT, None) == before
    spark.conf.set(LIMIT, "9000")
    try:
        with short_methods(spark):
            assert spark.conf.get(LIMIT) == "8000"
        assert spark.conf.get(LIMIT) == "9000"
    finally:
        spark.conf.unset(LIMIT)


def test_features_are_saved_and_experiments_run_with_it(spark, tmp_path, monkeypatch):
    seen = []
    df = spark.range(50).select(F.col("id").alias("TransactionID"), F.lit(1.0).alias("f"))
    store = FeatureStore(spark, root=str(tmp_path / "s"))
    probe = F.udf(lambda x: x, "double")     # any column; the setting is read while the write runs
    monkeypatch.setattr(type(df), "write", property(lambda self, w=type(df).write: seen.append(
        self.sparkSession.conf.get(LIMIT, None)) or w.fget(self)))
    store.save(df.withColumn("f", probe("f")), "t", [1])
    assert seen[0] == "8000"
    monkeypatch.undo()
    seen.clear()
    monkeypatch.setattr(ex, "train_model", lambda *a, **k: seen.append(spark.conf.get(LIMIT, None)) or 1 / 0)
    data = df.select("TransactionID", F.lit(0).alias("isFraud"), F.lit(3).alias("TransactionDay"))
    try:
        ex.run_static(data, "baseline", "rf", "none")
    except ZeroDivisionError:
        pass
    assert seen == ["8000"] and spark.conf.get(LIMIT, None) is None
