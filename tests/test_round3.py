"""Metrics from merged histograms, replay stopped between scores and log."""
import math

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk.operators import metrics as mt
from txrisk.operators.prep import split_train_test
from txrisk.plans.catalog import _StopsBeforeLog
from txrisk.session import shared_path
from txrisk.sources import tables as tb
from txrisk.streaming.prequential import PrequentialJob, RuleLearner

from conftest import SF001


def _same(a, b):
    return all((x is None) == (y is None) and (x is None or math.isclose(x, y, abs_tol=1e-12)) for x, y in zip(a, b))


@pytest.mark.parametrize("rows", [
    [(i % 7 % 2, (i * 37 % 11) / 10) for i in range(200)],                    # ties in every score
    [(1, 0.9), (1, 0.2)],                                                    # one class: no AUC
    [(0, 0.9), (0, 0.2)],
    [(0, 0.1), (1, 0.1), (0, 0.1)],                                          # nothing predicted positive
])
def test_merged_histograms_equal_the_rows(spark, rows):
    df = mt.with_prediction(spark.createDataFrame([(y, s, i % 3) for i, (y, s) in enumerate(rows)],
                                                  "y int, score double, part int"))
    want = mt.evaluate(df, pred_col="pred").first()
    parts = [mt.score_histogram(df.where(F.col("part") == p)) for p in range(3)]
    hist = mt.merge_histograms(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = mt.evaluate_histogram(hist).select(*want.asDict()).first()
    assert _same(got, want)


def test_histogram_of_no_rows(spark):
    none = spark.createDataFrame([], "y int, score double, pred int")
    got = mt.evaluate_histogram(mt.merge_histograms(mt.score_histogram(none))).first()
    assert got["auc"] is None and got["average_precision"] is None
    assert got["f1"] == got["precision"] == got["recall"] == got["auc_pr_hard"] == 0.0


@pytest.mark.parametrize("stop_at", [0, 2])
def test_replay_stopped_between_scores_and_log(spark, stop_at):
    learner = RuleLearner(F.col("TransactionAmt") / F.lit(500.0))
    train, stream = split_train_test(tb.tx_prepared(spark, SF001), offline_weeks=2)
    args = dict(batch_days=5, window_size=2)
    plain = PrequentialJob(spark, shared_path(spark, "t_undisturbed", unique=True), learner, **args)
    plain.initialize(train, stream)
    want = plain.run()
    root = shared_path(spark, "t_stopped", unique=True)
    stopped = _StopsBeforeLog(spark, root, learner, **args)
    stopped.stop_at = stop_at
    stopped.initialize(train, stream)
    with pytest.raises(StreamingQueryException):
        stopped.run()
    # The batch is scored but not logged, and pooled metrics leave it out.
    assert stopped.scored().where(F.col("batch_id") == stop_at).count() > 0
    assert stopped.log().count() == stop_at
    resumed = PrequentialJob(spark, root, learner, **args)
    columns = [c for c in want.columns if c != "processed_at"]
    got = sorted(map(tuple, resumed.run().select(columns).collect()))
    assert got == sorted(map(tuple, want.select(columns).collect()))
    assert resumed.scored().exceptAll(plain.scored()).count() == 0
    assert resumed.scored().count() == plain.scored().count()
    assert _same(resumed.evaluate().first(), plain.evaluate().first())
