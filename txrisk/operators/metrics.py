"""Scoring metrics over a scored table ``(id, y, score[, pred])``.

All metrics are distributed aggregates. Curve metrics group by distinct score
first (ties handled exactly) and take running sums with ``global_prefix_sum``
(no single-partition window over the data). The threshold sweep bins scores
once against the 80-value grid and takes suffix sums over at most 81 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.ranking import global_prefix_sum
from txrisk.functions.thresholds import DEFAULT_THRESHOLD, THRESHOLDS

METRIC_NAMES = ("f1", "precision", "recall")


def hard_prediction(score: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """``score >= threshold`` as 0/1."""
    return (score >= F.lit(float(threshold))).cast("int")


def with_prediction(df: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                    score_col="score", pred_col="pred") -> DataFrame:
    return df.withColumn(pred_col, hard_prediction(F.col(score_col), threshold))


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (sklearn's zero_division result)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, y_col="y", pred_col="pred") -> DataFrame:
    """One-row confusion counts."""
    y, p = F.col(y_col), F.col(pred_col)
    return df.agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))


def _prf(tp: Column, fp: Column, fn: Column):
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    f1 = _div0(2 * tp, 2 * tp + fp + fn)
    return f1, precision, recall


def confusion_metrics(df: DataFrame, y_col="y", pred_col="pred") -> DataFrame:
    """f1, precision, recall (0 when undefined) plus the counts."""
    c = confusion(df, y_col, pred_col)
    f1, pr, rc = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select("tp", "fp", "fn", "tn", f1.alias("f1"), pr.alias("precision"),
                    rc.alias("recall"))


def auc_pr_hard(df: DataFrame, y_col="y", pred_col="pred") -> DataFrame:
    """E2 (F13): average precision of the *hard* predictions, closed form
    ``precision·recall + (1 − recall)·prevalence`` (precision 0 when nothing is
    predicted positive)."""
    c = confusion(df, y_col, pred_col)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    prev = _div0(tp + fn, tp + fp + fn + tn)
    return c.select((prec * rec + (F.lit(1.0) - rec) * prev).alias("auc_pr_hard"))


def _score_groups(df: DataFrame, y_col: str, score_col: str) -> DataFrame:
    y = F.col(y_col).cast("long")
    return df.groupBy(F.col(score_col).alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def _auc(groups: DataFrame) -> DataFrame:
    cum = global_prefix_sum(groups, "s", ["neg"])
    return cum.agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
    ).select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                    F.col("num") / (F.col("P").cast("double") * F.col("N"))).alias("auc"))


def roc_auc(df: DataFrame, y_col="y", score_col="score") -> DataFrame:
    """Tie-aware ROC-AUC = Σ pos·(neg below + neg/2) / (P·N); null when
    only one class is present."""
    return _auc(_score_groups(df, y_col, score_col))


def _average_precision(groups: DataFrame) -> DataFrame:
    g = groups.withColumn("n", F.col("pos") + F.col("neg"))
    cum = global_prefix_sum(g, "s", ["pos", "n"], descending=True)
    return cum.agg(
        F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")).alias("num"),
        F.sum("pos").alias("P"),
    ).select(F.when(F.col("P") > 0, F.col("num") / F.col("P")).alias("average_precision"))


def average_precision(df: DataFrame, y_col="y", score_col="score") -> DataFrame:
    """Score-based average precision, Σ over distinct scores (descending)
    of (pos / P) · (cumulative pos / cumulative rows); null without positives."""
    return _average_precision(_score_groups(df, y_col, score_col))


def score_histogram(df: DataFrame, y_col="y", score_col="score", pred_col="pred") -> DataFrame:
    """(s, pred, pos, neg): how many rows of each class have each score. Histograms of parts
    of a table add up to that of the whole (``merge_histograms``), so metrics over any set of
    parts need the histograms only. They are exact: a score is a cell of its own."""
    y = F.col(y_col).cast("long")
    return df.groupBy(F.col(score_col).alias("s"), F.col(pred_col).alias("pred")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def merge_histograms(hist: DataFrame) -> DataFrame:
    return hist.groupBy("s", "pred").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def evaluate_histogram(hist: DataFrame) -> DataFrame:
    """E1-E4 from a merged score histogram, as ``evaluate`` gives them from the rows."""
    hit = F.col("pred") == 1
    total = lambda col, when: F.coalesce(F.sum(F.when(when, F.col(col))), F.lit(0)).alias
    c = hist.agg(total("pos", hit)("tp"), total("neg", hit)("fp"), total("pos", ~hit)("fn"), total("neg", ~hit)("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    f1, precision, recall = _prf(tp, fp, fn)
    prevalence = _div0(tp + fn, tp + fp + fn + tn)
    return c.select(_auc(hist).scalar().alias("auc"),
                    (precision * recall + (F.lit(1.0) - recall) * prevalence).alias("auc_pr_hard"),
                    _average_precision(hist).scalar().alias("average_precision"),
                    f1.alias("f1"), precision.alias("precision"), recall.alias("recall"))


def evaluate(df: DataFrame, y_col="y", score_col="score", pred_col: str | None = None) -> DataFrame:
    """E1-E4 in one row: auc, auc_pr_hard, average_precision, f1, precision, recall."""
    if pred_col is None:
        df = with_prediction(df, score_col=score_col, pred_col="pred")
        pred_col = "pred"
    a = roc_auc(df, y_col, score_col).select("auc").scalar()
    ap = average_precision(df, y_col, score_col).select("average_precision").scalar()
    hard = auc_pr_hard(df, y_col, pred_col).select("auc_pr_hard").scalar()
    cm = confusion_metrics(df, y_col, pred_col)
    return cm.select(a.alias("auc"), hard.alias("auc_pr_hard"), ap.alias("average_precision"),
                     "f1", "precision", "recall")


def metrics_at_threshold(df: DataFrame, threshold: float, y_col="y", score_col="score") -> DataFrame:
    """E5: threshold, auc, f1, precision, recall."""
    d = with_prediction(df, threshold, score_col, "pred")
    a = roc_auc(d, y_col, score_col).select("auc").scalar()
    return confusion_metrics(d, y_col, "pred").select(
        F.lit(float(threshold)).alias("threshold"), a.alias("auc"), "f1", "precision", "recall")


def threshold_sweep(df: DataFrame, y_col="y", score_col="score", thresholds=THRESHOLDS) -> DataFrame:
    """(threshold, f1, precision, recall) for each grid value whose hard
    predictions are neither all 0 nor all 1.

    Scores are binned once: bin = number of grid values <= score, so
    ``score >= t_k`` exactly when bin > k. Positive/negative counts per bin
    (≤ 81 rows) and suffix sums give every confusion matrix.
    """
    grid = sorted(float(t) for t in thresholds)
    arr = F.array(*[F.lit(t) for t in grid])
    s = F.col(score_col)
    y = F.col(y_col).cast("long")
    bins = df.select(F.size(F.filter(arr, lambda t: t <= s)).alias("bin"), y.alias("y")) \
        .groupBy("bin").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg"))
    spark = df.sparkSession
    grid_df = spark.createDataFrame([(k, t) for k, t in enumerate(grid)], "k int, threshold double")
    # Threshold k predicts positive for bins k+1..len(grid). Equi-join each grid
    # row to bin k+1 and take suffix sums over the grid (80 rows, bounded).
    j = grid_df.join(bins, F.col("bin") == F.col("k") + 1, "left")
    suffix = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = j.select("k", "threshold",
                   F.sum(F.coalesce("pos", F.lit(0))).over(suffix).alias("tp"),
                   F.sum(F.coalesce("neg", F.lit(0))).over(suffix).alias("fp"))
    P = bins.select(F.sum("pos")).scalar()
    N = bins.select(F.sum("neg")).scalar()
    fn = P - F.col("tp")
    f1, pr, rc = _prf(F.col("tp"), F.col("fp"), fn)
    npred = F.col("tp") + F.col("fp")
    return per.filter((npred > 0) & (npred < P + N)).select(
        "threshold", f1.alias("f1"), pr.alias("precision"), rc.alias("recall"))


def best_threshold(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """The grid row maximising ``metric``; the lowest threshold wins ties."""
    if metric not in METRIC_NAMES:
        raise ValueError(f"Unknown metric: {metric}")
    return sweep.orderBy(F.col(metric).desc(), F.col("threshold").asc()).limit(1) \
        .select("threshold", F.col(metric).alias("score"), "f1", "precision", "recall")


def best_threshold_value(sweep: DataFrame, metric: str = "f1") -> tuple[float, float]:
    """E7 as values; raises when every grid point was degenerate."""
    rows = best_threshold(sweep, metric).take(1)
    if not rows:
        raise ValueError("no threshold with non-degenerate predictions")
    return float(rows[0]["threshold"]), float(rows[0]["score"])


def threshold_top(sweep: DataFrame, n: int = 10) -> DataFrame:
    """K3: top-n grid rows by f1 (descending, stable: lower threshold first)."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(n)


def batch_error_rate(scored: DataFrame, batch_col="batch_id", y_col="y", pred_col="pred") -> DataFrame:
    """A10: per batch the share of wrong hard predictions."""
    wrong = (F.col(pred_col) != F.col(y_col)).cast("double")
    return scored.groupBy(batch_col).agg(F.avg(wrong).alias("error_rate"),
                                         F.count(F.lit(1)).alias("size"))

