"""Profiling aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.ranking import exact_quantiles


def daily_stats(df: DataFrame, day_col="TransactionDay", id_col="TransactionID",
                label_col="isFraud", amount_col="TransactionAmt") -> DataFrame:
    """A1: per day: transactions, positives, positive rate, mean amount."""
    return df.groupBy(day_col).agg(
        F.count(id_col).alias("TransactionCount"),
        F.sum(F.col(label_col).cast("long")).alias("FraudCount"),
        F.avg(F.col(label_col).cast("double")).alias("FraudRate"),
        F.avg(amount_col).alias("AvgTransactionAmt"))


def daily_stats_mean(df: DataFrame, **kw) -> DataFrame:
    """A2: means of the daily series plus the overall positive rate (two
    aggregates over one scan; the overall rate is a scalar subquery)."""
    label_col = kw.get("label_col", "isFraud")
    overall = df.select(F.avg(F.col(label_col).cast("double"))).scalar()
    return daily_stats(df, **kw).agg(
        F.avg("TransactionCount").alias("avg_daily_count"),
        F.avg("FraudCount").alias("avg_daily_positives"),
        F.avg("FraudRate").alias("avg_daily_rate"),
    ).select("*", overall.alias("overall_rate"))


def describe_by_class(df: DataFrame, label_col="isFraud", value_col="TransactionAmt") -> DataFrame:
    """A3: pandas ``describe`` per class: count, mean, std (n-1), min,
    25/50/75 % (linear interpolation, exact), max."""
    base = df.groupBy(label_col).agg(
        F.count(value_col).alias("count"), F.avg(value_col).alias("mean"),
        F.stddev_samp(value_col).alias("std"), F.min(value_col).alias("min"),
        F.max(value_col).alias("max"))
    q = exact_quantiles(df, [label_col], value_col, [0.25, 0.5, 0.75])
    piv = q.groupBy(label_col).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("p75"))
    return base.join(piv, on=label_col, how="left").select(
        label_col, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def top_values(df: DataFrame, cols, n: int = 5) -> DataFrame:
    """A4 + K2: per column the n most frequent non-null values (ties by value).
    The rank filter becomes a WindowGroupLimit, so top-n is also applied before
    the shuffle."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.column", "s.value").filter(F.col("value").isNotNull())
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("column").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return counts.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)


def pivot_counts(df: DataFrame, group_col="ProductCD", label_col="isFraud") -> DataFrame:
    """A5: rows per (group, label) pivoted to label columns, missing -> 0."""
    p = df.groupBy(group_col).pivot(label_col, [0, 1]).count()
    return p.select(group_col, F.coalesce(F.col("0"), F.lit(0)).alias("n_0"),
                    F.coalesce(F.col("1"), F.lit(0)).alias("n_1"))


def box_stats(df: DataFrame, label_col="isFraud", value_col="TransactionAmt",
              below: float = 500.0, whis: float = 1.5) -> DataFrame:
    """Numbers behind the per-class box plot of amounts < ``below``:
    quartiles (linear), whiskers at the most extreme values within
    ``whis``·IQR of the box, and the count of points beyond the whiskers."""
    d = df.filter(F.col(value_col) < F.lit(below)).select(label_col, value_col)
    q = exact_quantiles(d, [label_col], value_col, [0.25, 0.5, 0.75])
    quart = q.groupBy(label_col).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    quart = quart.withColumn("lo_fence", F.col("q1") - whis * (F.col("q3") - F.col("q1"))) \
        .withColumn("hi_fence", F.col("q3") + whis * (F.col("q3") - F.col("q1")))
    j = d.join(quart, on=label_col, how="inner")
    v = F.col(value_col)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    agg = j.groupBy(label_col, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("outliers"),
        F.count(F.lit(1)).alias("n"))
    return agg


def dataset_summary(df: DataFrame, label_col="isFraud", day_col="TransactionDay",
                    n_columns: int | None = None) -> DataFrame:
    """A7 + A8: rows, feature columns (all but one), positives, negatives, rate,
    last day, span in days and in months (span / 30)."""
    ncols = len(df.columns) if n_columns is None else n_columns
    y = F.col(label_col).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).alias("positives"),
        (F.count(F.lit(1)) - F.sum(y)).alias("negatives"),
        F.avg(y.cast("double")).alias("positive_rate"),
        F.max(day_col).alias("last_day"),
        (F.max(day_col) - F.min(day_col) + 1).alias("span_days"),
    ).select(F.lit(ncols).alias("columns"), F.lit(ncols - 1).alias("features"), "*",
             (F.col("span_days") / F.lit(30.0)).alias("span_months"))


def batch_manifest(df: DataFrame, batch_days: int = 7, day_col="TransactionDay",
                   label_col="isFraud") -> DataFrame:
    """A9 / T2 (F12): fixed-width batches from the subset's first day, half-open,
    empty batches absent; (batch_id, start_day, end_day, size, positive_rate)."""
    w = int(batch_days)
    if w <= 0:
        raise ValueError("batch_days must be positive")
    first = df.select(F.min(day_col)).scalar()
    bid = F.floor((F.col(day_col) - first) / F.lit(w)).cast("int")
    return df.groupBy(bid.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(F.col(label_col).cast("double")).alias("positive_rate"),
    ).select("batch_id", (first + F.col("batch_id") * w).cast("int").alias("start_day"),
             (first + F.col("batch_id") * w + (w - 1)).cast("int").alias("end_day"),
             "size", "positive_rate")


def with_batch_id(df: DataFrame, batch_days: int = 7, day_col="TransactionDay",
                  out_col: str = "batch_id") -> DataFrame:
    """T2 row tag: batch number from the subset's first day."""
    first = df.select(F.min(day_col)).scalar()
    return df.withColumn(out_col, F.floor((F.col(day_col) - first) / F.lit(int(batch_days))).cast("int"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys, what: str = "table") -> None:
    """A12 as a guard: raise when a key repeats (one distributed aggregate)."""
    dup = duplicate_keys(df, keys).limit(1).count()
    if dup:
        raise ValueError(f"{what} contains duplicate {keys}!")
