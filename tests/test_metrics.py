import pytest

from txrisk.functions.thresholds import THRESHOLDS
from txrisk.operators.metrics import (auc_pr_hard, average_precision, best_threshold,
                                      best_threshold_value, confusion_metrics, evaluate, roc_auc,
                                      threshold_sweep, with_prediction)


def _df(spark, ys, ps):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(zip(ys, ps))],
                                 "id long, y int, score double")


def test_perfect_example(spark):
    df = _df(spark, [0, 1, 0, 1, 1, 0], [.1, .9, .2, .8, .7, .3])
    m = evaluate(df).first()
    assert m["auc"] == 1 and m["f1"] == 1 and m["precision"] == 1 and m["recall"] == 1
    assert m["auc_pr_hard"] == 1 and m["average_precision"] == 1


def test_one_class_auc_null_and_no_positive_prediction(spark):
    assert roc_auc(_df(spark, [1, 1], [.2, .3])).first()["auc"] is None
    df = with_prediction(_df(spark, [0, 1, 0, 1], [.1, .2, .3, .4]))
    assert confusion_metrics(df).first()["precision"] == 0
    assert auc_pr_hard(df).first()["auc_pr_hard"] == pytest.approx(0.5)


def test_auc_with_ties_matches_pairwise(spark):
    ys = [0, 1, 1, 0, 1, 0, 0, 1]
    ps = [.5, .5, .7, .2, .2, .9, .5, .6]
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    exp = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert roc_auc(_df(spark, ys, ps)).first()["auc"] == pytest.approx(exp)
    ap = average_precision(_df(spark, ys, ps)).first()["average_precision"]
    assert 0 < ap <= 1


def test_sweep_degenerate_and_ties(spark):
    df = _df(spark, [0, 1, 1], [.95, .95, .95])
    sw = threshold_sweep(df)
    assert sw.count() == 0
    with pytest.raises(ValueError):
        best_threshold_value(sw)
    with pytest.raises(ValueError):
        best_threshold(sw, "accuracy")
    df2 = _df(spark, [0, 1, 0, 1], [.05, .95, .05, .95])
    sw2 = threshold_sweep(df2)
    assert sw2.count() == len(THRESHOLDS)
    t, s = best_threshold_value(sw2, "f1")
    assert t == THRESHOLDS[0] and s == 1.0
