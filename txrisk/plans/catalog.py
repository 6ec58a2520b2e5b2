"""Query catalogue: one Spark job per operator family.

Every query reads the driver tables (or data Spark derives from them) in full.
Double columns are rounded to 6 digits, like the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.ranking import values_at_ranks
from txrisk.functions.util import round_doubles
from txrisk.session import ship_package
from txrisk.operators.rolling import rolling_features
from txrisk.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # workers import txrisk whatever the caller's cwd
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---------------------------------------------------------------- rolling windows
@query("rolling_user_1d_7d")
def q_rolling_user(spark, sf):
    tx = tb.tx_view(spark, sf)
    return round_doubles(rolling_features(tx, id_col="id", time_col="dt", value_col="amt",
                                          keys=["card1"], windows_days=[1, 7]))


@query("rolling_ties_orders")
def q_rolling_ties(spark, sf):
    o = tb.tied_orders_view(spark, sf)
    return round_doubles(rolling_features(o, id_col="id", time_col="dt", value_col="amt",
                                          keys=["cust"], windows_days=[30], chunk_seconds=86400))


@query("rolling_multi_key")
def q_rolling_multi(spark, sf):
    tx = tb.tx_view(spark, sf)
    return round_doubles(rolling_features(tx, id_col="id", time_col="dt", value_col="amt",
                                          keys=["card1", "card2", "addr1"], windows_days=[1, 3, 7]))


@query("rolling_large_offset")
def q_rolling_offset(spark, sf):
    """Amounts on a large offset, daily chunks: part B as frames over chunks."""
    tx = tb.tx_view(spark, sf).withColumn("amt", F.col("amt") + F.lit(1e6))
    out = rolling_features(tx, id_col="id", time_col="dt", value_col="amt", keys=["card2"],
                           windows_days=[7], chunk_seconds=86400, plain_rows=0)
    return out.select("id", F.round("card2_amt_std_7d", 3).alias("card2_amt_std_7d"), "card2_id_count_7d")


@query("rolling_large_offset_blocks")
def q_rolling_offset_blocks(spark, sf):
    """The same with hourly chunks: part B as running sums in blocks."""
    tx = tb.tx_view(spark, sf).withColumn("amt", F.col("amt") + F.lit(1e6))
    out = rolling_features(tx, id_col="id", time_col="dt", value_col="amt", keys=["card2"],
                           windows_days=[7], chunk_seconds=3600, plain_rows=0)
    return out.select("id", F.round("card2_amt_std_7d", 3).alias("card2_amt_std_7d"), "card2_id_count_7d")


@query("rolling_tiny_spread")
def q_rolling_tiny_spread(spark, sf):
    """A spread of about one on an offset of 1e9: a formula that cancels loses every digit."""
    tx = tb.tx_view(spark, sf).withColumn("amt", F.lit(1e9) + F.col("amt") / F.lit(100.0))
    out = rolling_features(tx, id_col="id", time_col="dt", value_col="amt", keys=["card2"],
                           windows_days=[7], chunk_seconds=3600, plain_rows=0)
    return out.select("id", F.round("card2_amt_std_7d", 3).alias("card2_amt_std_7d"), "card2_id_count_7d")


# ---------------------------------------------------------------- preparation
from txrisk.operators import prep, profile  # noqa: E402

TX_DAY_KW = dict(day_col="day", id_col="id", label_col="y", amount_col="amt")


@query("time_features")
def q_time_features(spark, sf):
    return round_doubles(tb.tx_days(spark, sf).select("id", "seconds_of_day", "cents", "day"))


@query("identity_left_join")
def q_left_join(spark, sf):
    return tb.joined_documents(spark, sf)


@query("null_profile")
def q_null_profile(spark, sf):
    return prep.null_counts(tb.joined_documents(spark, sf))


@query("impute")
def q_impute(spark, sf):
    return prep.impute(tb.joined_documents(spark, sf), exclude=("doc_id",))


def _encode_input(spark, sf):
    tx = tb.tx_view(spark, sf)
    return tx.select("id", "product", F.col("addr1").cast("string").alias("addr1"),
                     F.col("card2").cast("string").alias("card2"))


@query("encode_categories")
def q_encode(spark, sf):
    return prep.encode_categories(_encode_input(spark, sf), declared=["addr1"],
                                  plain=["product", "card2"])


@query("split_profile")
def q_split_profile(spark, sf):
    return round_doubles(prep.split_profile(tb.tx_days(spark, sf), offline_weeks=2,
                                            day_col="day", label_col="y"))


# ---------------------------------------------------------------- profiling
@query("batch_manifest_7d")
def q_batch_manifest(spark, sf):
    _, stream = prep.split_train_test(tb.tx_days(spark, sf), offline_weeks=2, day_col="day")
    return round_doubles(profile.batch_manifest(stream, 7, day_col="day", label_col="y"))


@query("daily_batches")
def q_daily_batches(spark, sf):
    return round_doubles(profile.batch_manifest(tb.tx_days(spark, sf), 1, day_col="day",
                                                label_col="y"))


@query("daily_stats")
def q_daily_stats(spark, sf):
    return round_doubles(profile.daily_stats(tb.tx_days(spark, sf), **TX_DAY_KW))


@query("daily_stats_mean")
def q_daily_stats_mean(spark, sf):
    return round_doubles(profile.daily_stats_mean(tb.tx_days(spark, sf), **TX_DAY_KW))


@query("describe_by_class")
def q_describe(spark, sf):
    return round_doubles(profile.describe_by_class(tb.tx_view(spark, sf), label_col="y",
                                                   value_col="amt"))


@query("ranks_with_nan")
def q_ranks_with_nan(spark, sf):
    """Order statistics of a column of which most rows hold one value and some are NaN."""
    v = (F.when(F.col("card2") == 7, F.lit(float("nan"))).when(F.col("card2") < 90, F.lit(25.0))
         .otherwise(F.col("amt")))
    d = tb.tx_view(spark, sf).select("product", v.alias("v"))
    n = d.groupBy("product").agg(F.count(F.lit(1)).alias("n"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(20)))
    targets = n.select("product", "n", steps.alias("i")).select(
        "product", F.floor((F.col("n") - 1) * F.col("i") / 20).cast("long").alias("rank")).distinct()
    got = values_at_ranks(d, ["product"], "v", targets, max_rows=64)
    return got.select("product", "rank", F.isnan("value").alias("is_nan"),
                      F.round(F.nanvl("value", F.lit(None).cast("double")), 6).alias("value"))


@query("top_values")
def q_top_values(spark, sf):
    return profile.top_values(tb.tx_view(spark, sf), ["product", "card2", "addr1"], 5)


@query("pivot_counts")
def q_pivot(spark, sf):
    return profile.pivot_counts(tb.tx_view(spark, sf), group_col="product", label_col="y")


@query("box_stats")
def q_box(spark, sf):
    return round_doubles(profile.box_stats(tb.tx_view(spark, sf), label_col="y", value_col="amt"))


@query("dataset_summary")
def q_summary(spark, sf):
    return round_doubles(profile.dataset_summary(tb.tx_days(spark, sf), label_col="y",
                                                 day_col="day"))


@query("duplicate_keys")
def q_dups(spark, sf):
    o = tb.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return profile.duplicate_keys(o, ["o_custkey", "o_orderdate"])


# ---------------------------------------------------------------- metrics
from txrisk.operators import metrics as mt  # noqa: E402


def _tx_scored(spark, sf):
    return mt.with_prediction(tb.tx_view(spark, sf).select("id", "y", "score"))


def _labelled(spark, sf, label="quality"):
    return mt.with_prediction(tb.labelled_scores_view(spark, sf, label))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return round_doubles(mt.roc_auc(_tx_scored(spark, sf)))


@query("roc_auc_labels")
def q_roc_auc_labels(spark, sf):
    q = mt.roc_auc(_labelled(spark, sf, "quality")).select(F.col("auc").alias("auc_quality"))
    t = mt.roc_auc(_labelled(spark, sf, "toxic")).select("auc").scalar()
    return round_doubles(q.select("auc_quality", t.alias("auc_toxic")))


@query("auc_pr_hard")
def q_auc_pr_hard(spark, sf):
    return round_doubles(mt.auc_pr_hard(_tx_scored(spark, sf)))


@query("average_precision")
def q_average_precision(spark, sf):
    return round_doubles(mt.average_precision(_labelled(spark, sf, "toxic")))


@query("confusion_metrics")
def q_confusion(spark, sf):
    return round_doubles(mt.confusion_metrics(_tx_scored(spark, sf)))


@query("evaluate_labels")
def q_evaluate(spark, sf):
    return round_doubles(mt.evaluate(_labelled(spark, sf, "quality"), pred_col="pred"))


@query("threshold_sweep")
def q_sweep(spark, sf):
    return round_doubles(mt.threshold_sweep(_tx_scored(spark, sf)))


@query("best_threshold")
def q_best(spark, sf):
    sw = mt.threshold_sweep(_labelled(spark, sf, "toxic"))
    return round_doubles(mt.best_threshold(sw, "f1"))


@query("best_threshold_precision")
def q_best_precision(spark, sf):
    return round_doubles(mt.best_threshold(mt.threshold_sweep(_tx_scored(spark, sf)), "precision"))


@query("best_threshold_recall")
def q_best_recall(spark, sf):
    return round_doubles(mt.best_threshold(mt.threshold_sweep(_tx_scored(spark, sf)), "recall"))


@query("threshold_top10")
def q_top10(spark, sf):
    return round_doubles(mt.threshold_top(mt.threshold_sweep(_tx_scored(spark, sf)), 10))


@query("metrics_at_threshold")
def q_at_threshold(spark, sf):
    return round_doubles(mt.metrics_at_threshold(tb.tx_view(spark, sf), 0.3))


@query("batch_error_rate")
def q_batch_error(spark, sf):
    d = profile.with_batch_id(tb.tx_days(spark, sf), 7, day_col="day")
    return round_doubles(mt.batch_error_rate(mt.with_prediction(d)))


# ---------------------------------------------------------------- sampling and kNN
from txrisk.operators import knn_index  # noqa: E402
from txrisk.operators import sampling as smp  # noqa: E402
from txrisk.operators.knn import knn  # noqa: E402


def _vectors_y(spark, sf):
    v = tb.vectors_view(spark, sf)
    return v.select("id", (F.col("label") == 0).cast("int").alias("y"), "vec")


@query("undersample")
def q_undersample(spark, sf):
    tx = tb.tx_view(spark, sf).select("id", "y")
    return smp.undersample(tx, label_col="y", id_col="id")


@query("oversample")
def q_oversample(spark, sf):
    tx = tb.tx_view(spark, sf).select("id", "y")
    return smp.oversample(tx, label_col="y", id_col="id")


@query("knn5")
def q_knn5(spark, sf):
    v = tb.vectors_view(spark, sf)
    return round_doubles(knn(v, 5, id_col="id", vec_col="vec"))


@query("knn3_by_label")
def q_knn3_by_label(spark, sf):
    v = tb.vectors_view(spark, sf)
    return round_doubles(knn(v, 3, id_col="id", vec_col="vec", group_col="label", n_pivots=8))


@query("knn5_lsh")
def q_knn5_lsh(spark, sf):
    """Hash index mode: near rows of every row."""
    return round_doubles(knn_index.lsh_knn(tb.vectors_view(spark, sf), 5, id_col="id", vec_col="vec"))


@query("knn5_lsh_recall")
def q_knn5_lsh_recall(spark, sf):
    """Its recall on the rows whose id is divisible by 100, against all rows."""
    v = tb.vectors_view(spark, sf)
    got = knn_index.recall(knn_index.lsh_knn(v, 5, id_col="id", vec_col="vec"), knn_index.nearest_of_queries(v, 5))
    return got.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_reached"))


@query("smote")
def q_smote(spark, sf):
    s = smp.smote(_vectors_y(spark, sf), label_col="y", id_col="id", vec_col="vec", k=5)
    syn = s.filter(F.col("base_id").isNotNull())
    return round_doubles(syn.select(
        "id", "base_id", "nn_id", "u", F.col("vec")[0].alias("x0"),
        F.aggregate("vec", F.lit(0.0), lambda a, x: a + x).alias("xsum")))


@query("smoteenn")
def q_smoteenn(spark, sf):
    s = smp.smoteenn(_vectors_y(spark, sf), label_col="y", id_col="id", vec_col="vec")
    return s.select("id", "y")


# ---------------------------------------------------------------- drift and models
from txrisk.operators import drift as dr  # noqa: E402
from txrisk.operators import models as md  # noqa: E402


def _error_series(spark, sf):
    tx = tb.tx_view(spark, sf)
    err = (mt.hard_prediction(F.col("score")) != F.col("y")).cast("double")
    return tx.groupBy(F.col("product").alias("series"),
                      F.floor(F.col("dt") / 21600).cast("long").alias("pos")).agg(
        F.avg(err).alias("value"))


@query("drift_first_detection")
def q_drift_first(spark, sf):
    return round_doubles(dr.first_detection(
        dr.detection_margins(_error_series(spark, sf), "series", "pos", "value")))


@query("drift_shifted_series")
def q_drift_shifted(spark, sf):
    """The error series with right and wrong swapped from the 60th period on."""
    s = _error_series(spark, sf)
    start = s.select(F.min("pos") + 60).scalar()
    s = s.withColumn("value", F.when(F.col("pos") >= start, 1 - F.col("value")).otherwise(F.col("value")))
    return round_doubles(dr.first_detection(dr.detection_margins(s, "series", "pos", "value")))


@query("drift_scan")
def q_drift_scan(spark, sf):
    return round_doubles(dr.drift_scan(_error_series(spark, sf), "series", "pos", "value"))


def _model_scores(spark, sf, model_type):
    prepared = tb.tx_model_input(spark, sf)
    train, test = prep.split_train_test(prepared, offline_weeks=2)
    model, _ = md.train_model(train, model_type, use_sampling=False)
    return round_doubles(md.predict_model(model, test))


@query("gbt_scores")
def q_gbt(spark, sf):
    return _model_scores(spark, sf, "gbt")


@query("rf_scores")
def q_rf(spark, sf):
    return _model_scores(spark, sf, "rf")


def _one_feature(spark, sf):
    """Transactions with one binary feature, which tells much about the label."""
    tx = add_time_features(tb.tx_transactions(spark, sf))
    y = (F.col("TransactionAmt") + F.col("card2") >= 100).cast("int")
    return prep.split_train_test(tx.select(
        "TransactionID", y.alias("isFraud"), "TransactionDT", "TransactionDay",
        (F.col("card2") >= 50).cast("int").alias("high")), offline_weeks=2)


ONE_FEATURE_EXCLUDE = ("TransactionID", "isFraud", "TransactionDT", "TransactionDay")


@query("rf_leaf_scores")
def q_rf_leaf(spark, sf):
    """The preset's 100 trees, one split deep and without draws: a score is its leaf's share."""
    train, test = _one_feature(spark, sf)
    model, _ = md.train_model(train, "rf", use_sampling=False, exclude=ONE_FEATURE_EXCLUDE, maxDepth=1,
                              bootstrap=False, featureSubsetStrategy="all")
    return round_doubles(md.predict_model(model, test), 5)


@query("gbt_leaf_scores")
def q_gbt_leaf(spark, sf):
    """The boosted preset's 100 rounds at learning rate 0.3, one split deep."""
    train, test = _one_feature(spark, sf)
    model, _ = md.train_model(train, "xgb", use_sampling=False, exclude=ONE_FEATURE_EXCLUDE, maxDepth=1)
    return round_doubles(md.predict_model(model, test), 5)


@query("rf_undersampled_scores")
def q_rf_undersampled(spark, sf):
    """The same trees after the under-sampler of the training call (L2, M2)."""
    train, test = _one_feature(spark, sf)
    model, _ = md.train_model(train, "rf", True, "undersample", exclude=ONE_FEATURE_EXCLUDE, maxDepth=1,
                              bootstrap=False, featureSubsetStrategy="all")
    return round_doubles(md.predict_model(model, test), 5)


# ---------------------------------------------------------------- storage
from txrisk.session import shared_path  # noqa: E402
from txrisk.sources import ingest  # noqa: E402
from txrisk.sources.feature_store import FeatureStore  # noqa: E402


@query("feature_store_roundtrip")
def q_feature_store(spark, sf):
    data = tb.tx_transactions(spark, sf)
    store = FeatureStore(spark, root=shared_path(spark, "features_query", unique=True))
    store.create_features(data, [1], tag="static_e1", keys=["card1"])        # compute + save
    merged, names = store.create_features(data, [1], tag="static_e1", keys=["card1"])  # reuse
    return round_doubles(merged.select("TransactionID", *names))


@query("typed_csv_scan")
def q_typed_csv(spark, sf):
    path = shared_path(spark, "csv_query", unique=True)
    tb.tx_transactions(spark, sf).write.option("header", True).csv(path)
    df = ingest.read_typed_csv(spark, path, ingest.transaction_schema())
    return df.select("TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD",
                     "card1", "card2", "addr1")


@query("typed_csv_columns")
def q_typed_csv_columns(spark, sf):
    """All declared columns of a scan with rejects: per column its cells, their sum (for
    categories the number of 'T') and its malformed cells."""
    path, schema = shared_path(spark, "csv_columns", unique=True), ingest.transaction_schema()
    tb.wide_csv_cells(spark, sf, schema).write.option("header", True).option("escape", '"').option(
        "compression", "gzip").csv(path)
    rows, rejects = ingest.read_with_rejects(spark, path, schema)
    per = []
    for f in schema.fields:
        c = F.col(f.name)
        value = (c == "T").cast("double") if f.dataType.simpleString() == "string" else c.cast("double")
        per.append(F.struct(F.lit(f.name).alias("column"), F.count(c).alias("cells"),
                            F.coalesce(F.sum(value), F.lit(0.0)).alias("total")))
    found = rows.agg(F.array(*per).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    bad = rejects.where(F.col("file").contains("csv_columns")).groupBy("column").agg(
        F.count(F.lit(1)).alias("rejects"), F.min("text").alias("first_reject"), F.countDistinct("row").alias("reject_rows"))
    return round_doubles(found.join(bad, "column", "left").select(
        "column", "cells", "total", F.coalesce("rejects", F.lit(0)).alias("rejects"),
        F.coalesce("reject_rows", F.lit(0)).alias("reject_rows"), "first_reject"), 2)


@query("prepare_chain")
def q_prepare_chain(spark, sf):
    """Two CSV files -> join -> prepare -> store -> split, three times: without the last day, the
    same again, and with it. ``written`` lists the partitions each refresh wrote."""
    root = shared_path(spark, "prepare_chain", unique=True)
    tx, day = tb.tx_transactions(spark, sf), F.floor((F.col("TransactionDT") - F.lit(0)) / 86400)
    last = tx.select(F.max(day)).scalar()
    files = f"{root}/train_transaction.csv"
    csv = lambda df, path: df.write.mode("append").option("header", True).csv(path)
    csv(tx.where(day < last), files)
    csv(tb.identity_csv_cells(spark, sf), f"{root}/train_identity.csv")
    store = ingest.PreparedStore(spark, f"{root}/store")
    written = []
    for step in range(3):
        if step == 2:
            csv(tx.where(day == last), files)
        written.append(len(store.refresh(ingest.load(spark, root, absent="skip"))))
    train, test = prep.split_train_test(store.read(), offline_weeks=2)
    out = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return round_doubles(out.select(
        "TransactionID", "isFraud", "TransactionDay", "TimeDay", "Cents", "ProductCD", "addr1", "id_01", "id_12", "DeviceType",
        "side", F.lit(",".join(map(str, written))).alias("written")))


# ---------------------------------------------------------------- streaming
from txrisk.functions.time import add_time_features  # noqa: E402
from txrisk.streaming import daily as sdaily  # noqa: E402
from txrisk.streaming.prequential import PrequentialJob, RuleLearner  # noqa: E402


@query("stream_daily_counts")
def q_stream_daily(spark, sf):
    root = shared_path(spark, "daily_stream", unique=True)
    sdaily.stage_by_day(tb.tx_transactions(spark, sf).repartition(16), f"{root}/data")
    out = sdaily.stream_daily_counts(spark, f"{root}/data", f"{root}/out", f"{root}/_checkpoint")
    return out.select("day", "n", "positives")


def _prequential_rule(spark, sf, use_drift=True):
    prepared = tb.tx_prepared(spark, sf)
    train, stream = prep.split_train_test(prepared, offline_weeks=2)
    learner = RuleLearner(F.col("TransactionAmt") / F.lit(500.0))
    job = PrequentialJob(spark, shared_path(spark, "prequential_query", unique=True), learner,
                         batch_days=7, window_size=2, use_drift_detection=use_drift)
    job.initialize(train, stream)
    job.run()
    return job


@query("stream_prequential_rule")
def q_stream_rule(spark, sf):
    job = _prequential_rule(spark, sf)
    s = job.scored()
    return round_doubles(s.select("id", "batch_id", "y", "score", "pred"))


@query("stream_batch_log")
def q_stream_log(spark, sf):
    job = _prequential_rule(spark, sf)
    return round_doubles(job.log().select("batch_id", "start_day", "end_day", "size", "error_rate",
                                          "drift", "retrained"))


@query("stream_no_detection_log")
def q_stream_no_detection(spark, sf):
    """The turned-over labels of ``stream_retrain_log`` with detection off."""
    job = _shifted_replay(spark, sf, use_drift=False)
    return round_doubles(job.log().select("batch_id", "size", "error_rate", "drift", "retrained", "model"))


@query("stream_evaluate")
def q_stream_evaluate(spark, sf):
    """Pooled metrics of a replay, merged from the histograms of its batches."""
    return round_doubles(_prequential_rule(spark, sf).evaluate())


@query("stream_statistics")
def q_stream_statistics(spark, sf):
    return _prequential_rule(spark, sf).statistics()


class _StopsBeforeLog(PrequentialJob):
    """A replay that stops once ``stop_at`` is scored, before its log row is written."""

    stop_at = 1

    def _write_log(self, row):
        if row[0] == self.stop_at:
            raise RuntimeError("stopped between scores and log")
        super()._write_log(row)


@query("stream_recovered_log")
def q_stream_recovered(spark, sf):
    """The replay stops between the scores and the log of a batch; a new job over the same
    folder ends with the log, scores and metrics of an undisturbed run."""
    args = dict(batch_days=7, window_size=2)
    root = shared_path(spark, "prequential_stopped", unique=True)
    learner = RuleLearner(F.col("TransactionAmt") / F.lit(500.0))
    train, stream = prep.split_train_test(tb.tx_prepared(spark, sf), offline_weeks=2)
    stopped = _StopsBeforeLog(spark, root, learner, **args)
    stopped.initialize(train, stream)
    try:
        stopped.run()
    except StreamingQueryException:
        pass
    before = stopped.log().count()
    job = PrequentialJob(spark, root, learner, **args)
    job.run()
    scored = job.scored().groupBy("batch_id").agg(F.count(F.lit(1)).alias("scored"),
                                                  F.countDistinct("id").alias("scored_ids"))
    return round_doubles(job.log().join(scored, "batch_id").select(
        "batch_id", "seq", "size", "error_rate", "scored", "scored_ids", F.lit(before).cast("long").alias("logged_before"),
        job.evaluate().select("auc").scalar().alias("auc")))


SHIFT_DAY = 18  # the retraining query's labels turn over from this day on


def _shifted_replay(spark, sf, use_drift=True):
    tx = tb.tx_transactions(spark, sf)
    tx = add_time_features(tx)
    hit = (F.col("TransactionAmt") >= F.lit(250.0)).cast("int")
    tx = tx.withColumn("isFraud", F.when(F.col("TransactionDay") < SHIFT_DAY, hit).otherwise(1 - hit))
    train, stream = prep.split_train_test(tx, offline_weeks=1)
    job = PrequentialJob(spark, shared_path(spark, "retrain_query", unique=True),
                         RuleLearner(F.col("TransactionAmt") / F.lit(500.0)),
                         batch_days=1, window_size=2, delta=0.3, use_drift_detection=use_drift)
    job.initialize(train, stream)
    job.run()
    return job


@query("stream_retrain_log")
def q_stream_retrain(spark, sf):
    """Daily batches whose labels follow the rule up to day 17 and oppose it after, so
    that the detector fires and the learner is trained again. The detector runs at a
    loose delta: a month of daily batches is too short for the usual one."""
    job = _shifted_replay(spark, sf)
    st = job.statistics()
    totals = [st.select(c).scalar().alias(c) for c in ("total_predictions", "total_batches",
                                                       "retrain_count", "drift_count")]
    return round_doubles(job.log().select("batch_id", "start_day", "size", "error_rate", "drift",
                                          "retrained", "window_batches", *totals))


# ---------------------------------------------------------------- experiments
from txrisk.plans import experiments as ex  # noqa: E402


@query("static_experiment")
def q_static_experiment(spark, sf):
    data = tb.tx_model_input(spark, sf)
    store = FeatureStore(spark, root=shared_path(spark, "features_static", unique=True))
    res = ex.run_grid(spark, data, ["baseline", "e1", "e6"], mode="static", model_type="rf",
                      sampling_type="undersample", offline_weeks=2, store=store)
    return ex.results_table(ex.require_ok(res), "static")


@query("incremental_experiment")
def q_incremental_experiment(spark, sf):
    data = tb.tx_model_input(spark, sf)
    root = shared_path(spark, "incremental_query", unique=True)
    res = ex.run_grid(spark, data, ["e1"], mode="incremental", root=root, model_type="rf",
                      sampling_type="undersample", offline_weeks=2, batch_days=7, window_size=2,
                      store=FeatureStore(spark, root=f"{root}/features"))
    return ex.results_table(ex.require_ok(res), "incremental")


@query("static_grid")
def q_static_grid(spark, sf):
    """All twelve static configurations with their result and summary files, trained with
    the preset's 100 boosting rounds; the figures depend on the trees, so the rows
    returned are those of the files without them."""
    data = tb.tx_model_input(spark, sf)
    root = shared_path(spark, "static_grid", unique=True)
    res = ex.require_ok(ex.run_grid(
        spark, data, list(ex.EXPERIMENTS), mode="static", model_type="xgb", sampling_type="undersample",
        offline_weeks=2, store=FeatureStore(spark, root=f"{root}/features")))
    ingest.write_results_csv(ex.results_table(res, "static"), f"{root}/results", ex.STATIC_COLUMNS)
    ingest.write_results_csv(ingest.summary([res]), f"{root}/summary", ingest.SUMMARY_COLUMNS)
    files = [spark.read.option("header", True).option("inferSchema", True).csv(f"{root}/{f}")
             for f in ("results", "summary")]
    scored = F.col("auc").between(0, 1) & F.col("precision").between(0, 1) & F.col("recall").between(0, 1)
    summed = files[1].select("exp_id", scored.alias("in_summary"))
    return files[0].join(summed, "exp_id").select(
        "exp_id", "exp_name", "windows", "model_type", "sampling_type", "mode", "status",
        scored.alias("scored"), "in_summary")


@query("training_window_union")
def q_training_window(spark, sf):
    from txrisk.streaming.prequential import training_window
    _, stream = prep.split_train_test(tb.tx_days(spark, sf), offline_weeks=2, day_col="day")
    staged = profile.with_batch_id(stream, 7, day_col="day")
    return training_window(staged, 2, 2).select("id", "batch_id", "day", "y")
