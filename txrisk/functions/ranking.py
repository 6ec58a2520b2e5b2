"""Exact order statistics and running sums without putting a whole group into one task.

``exact_quantiles`` and ``values_at_ranks`` select by counting, in at most four passes
whatever the number of targets:

  1. rows are counted per (group, key), where the key is a coarse monotone function of the
     value (32 steps per doubling), so one aggregate with map-side combining serves every
     distribution and no bounds are looked up
  2. a running sum over this small table maps each target rank to its key; a key whose
     least value equals its greatest answers at once (a value repeated by a third of all
     rows is never sorted), one with at most ``max_rows`` rows is counted per distinct
     value, and a larger one is cut into ``BINS`` equal steps in the next pass
  3. each pass reads only the rows of the open ranges, all targets together. Keys span 2 %
     of a value, so three cuts reach the resolution of a double.

Order is total: NaN is the greatest value, as everywhere in Spark. ``global_prefix_sum``
takes running sums over a whole table ordered by one column (ROC/PR curves, row numbers).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.session import reliable_checkpoint

STEPS = 32            # keys per doubling in the first pass
BINS = 1 << 16        # steps of an open range in later passes
EDGE = 1 << 20        # keys of the infinities and of NaN


def coarse_key(v: Column) -> Column:
    """Monotone in ``v``: sign and logarithm, NaN above all."""
    x = v.cast("double")
    # magnitudes run from 2^-1074 to 2^1024
    size = F.floor((F.log2(F.abs(x)) + 1080) * STEPS).cast("int")
    return (F.when(F.isnan(x), F.lit(EDGE + 1)).when(x == float("inf"), F.lit(EDGE)).when(x == float("-inf"), F.lit(-EDGE))
            .when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size))


def _same(a, b) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def _hits(counted: DataFrame, part: list[str], bin_col: str, targets: DataFrame) -> DataFrame:
    """The bin of every target rank: running sums over the bins of each part (a few
    thousand rows each) joined with the targets."""
    w = Window.partitionBy(*part).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counted.withColumn("__to", F.sum("__n").over(w)).withColumn("__from", F.col("__to") - F.col("__n"))
    return running.join(F.broadcast(targets), part, "inner").where(
        (F.col("__rel") >= F.col("__from")) & (F.col("__rel") < F.col("__to")))


def _select(df: DataFrame, group_cols: list[str], value_col: str, first_targets, max_rows: int):
    """Answers ``[(group..., rank, value)]`` for the targets that ``first_targets`` derives
    from the counted keys ((group..., __key, __n, __min, __max) -> (group..., rank))."""
    spark = df.sparkSession
    vtype = df.schema[value_col].dataType
    groups = [T.StructField(g, df.schema[g].dataType) for g in group_cols]
    data = df.select(*group_cols, F.col(value_col).alias("__v")).where(F.col("__v").isNotNull())
    measure = [F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max")]
    keys = reliable_checkpoint(data.groupBy(*group_cols, coarse_key(F.col("__v")).alias("__key")).agg(*measure))
    targets = first_targets(keys).withColumn("__rel", F.col("rank"))
    rows = _hits(keys, group_cols, "__key", targets).collect()   # one row per target
    answers = []
    while rows:
        small, large = [], []
        for r in rows:
            t = (*[r[g] for g in group_cols], r["rank"], r["__rel"] - r["__from"], r["__min"], r["__max"])
            if _same(r["__min"], r["__max"]):
                answers.append((*t[:len(group_cols)], r["rank"], r["__min"]))
            else:
                (small if r["__n"] <= max_rows else large).append(t)
        rows = []
        for todo, exact in ((small, True), (large, False)):
            if not todo:
                continue
            ranges = sorted({(*t[:len(group_cols)], t[-2], t[-1]) for t in todo}, key=repr)
            number = {x: i for i, x in enumerate(ranges)}
            spans = spark.createDataFrame([(*x[:-2], i, x[-2], x[-1]) for x, i in number.items()], T.StructType(
                [*groups, T.StructField("__rid", T.IntegerType()), T.StructField("__lo", vtype), T.StructField("__hi", vtype)]))
            wanted = spark.createDataFrame(
                [(number[(*t[:len(group_cols)], t[-2], t[-1])], *t[:-2]) for t in todo], T.StructType(
                    [T.StructField("__rid", T.IntegerType()), *groups, T.StructField("rank", T.LongType()),
                     T.StructField("__rel", T.LongType())]))
            on = [data[g].eqNullSafe(spans[g]) for g in group_cols]
            # as many ranges as targets at most: a bounded broadcast
            d = data.join(F.broadcast(spans), on + [data["__v"].between(spans["__lo"], spans["__hi"])], "inner").select(
                "__rid", "__v", "__lo", "__hi")
            if exact:
                cut = F.col("__v")
            else:
                step = (F.col("__v") - F.col("__lo")).cast("double") / (F.col("__hi") - F.col("__lo")).cast("double")
                cut = F.floor(step * BINS)
            rows += _hits(d.groupBy("__rid", cut.alias("__bin")).agg(*measure), ["__rid"], "__bin", wanted).collect()
    return answers, T.StructType([*groups, T.StructField("rank", T.LongType()), T.StructField("value", vtype)])


def values_at_ranks(df: DataFrame, group_cols, value_col: str, targets: DataFrame,
                    max_rows: int = 2_000_000) -> DataFrame:
    """(group_cols..., rank, value): the value with 0-based ``rank`` in ascending
    order within its group (nulls left out, NaN last), for every row of ``targets``
    (group_cols..., rank); a rank beyond the group has no row. One row per target
    reaches the driver in each of at most four passes."""
    group_cols = list(group_cols)
    if not group_cols:
        out = values_at_ranks(df.withColumn("__g", F.lit(0)), ["__g"], value_col, targets.withColumn("__g", F.lit(0)), max_rows)
        return out.drop("__g")
    wanted = targets.select(*group_cols, F.col("rank").cast("long").alias("rank")).distinct()
    answers, schema = _select(df, group_cols, value_col, lambda keys: wanted, max_rows)
    return df.sparkSession.createDataFrame(answers, schema)


def exact_quantiles(df: DataFrame, group_cols, value_col: str, probs, max_rows: int = 2_000_000) -> DataFrame:
    """Linear-interpolation quantiles (numpy default, DuckDB ``quantile_cont``):
    (group_cols..., p, value) for every p in ``probs``. Group sizes come from the
    first counting pass."""
    group_cols = list(group_cols)
    if not group_cols:
        return exact_quantiles(df.withColumn("__g", F.lit(0)), ["__g"], value_col, probs, max_rows).drop("__g")
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    sizes = []

    def ranks(keys: DataFrame) -> DataFrame:
        t = (keys.groupBy(*group_cols).agg(F.sum("__n").alias("__n"))
             .select(*group_cols, "__n", F.explode(p_arr).alias("p"))
             .withColumn("__h", (F.col("__n") - 1) * F.col("p"))
             .withColumn("__lo", F.floor("__h").cast("long")).withColumn("__hi", F.ceil("__h").cast("long")))
        sizes.append(t)
        return t.select(*group_cols, F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias("rank")).distinct()

    answers, schema = _select(df, group_cols, value_col, ranks, max_rows)
    vals = df.sparkSession.createDataFrame(answers, schema)
    t, at = sizes[0], {g: F.col(g).alias(f"__{g}") for g in group_cols}
    vals = vals.select(*at.values(), "rank", "value")
    # One join (ranks lo and hi of each p) and one pivot; a few rows per group.
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group_cols]
    j = t.join(vals, same + [(F.col("rank") == F.col("__lo")) | (F.col("rank") == F.col("__hi"))], "inner")
    piv = j.groupBy(*group_cols, "p", "__h", "__lo", "__hi").agg(
        F.max(F.when(F.col("rank") == F.col("__lo"), F.col("value"))).alias("__vlo"),
        F.max(F.when(F.col("rank") == F.col("__hi"), F.col("value"))).alias("__vhi"))
    weight = F.col("__h") - F.col("__lo")
    # a weight of zero takes the lower value as it is (infinities and NaN stay out of the sum)
    return piv.select(*group_cols, "p", F.when(weight == 0, F.col("__vlo").cast("double")).otherwise(
        F.col("__vlo") + weight * (F.col("__vhi") - F.col("__vlo"))).alias("value"))


def global_prefix_sum(df: DataFrame, order_col: str, sum_cols, descending: bool = False,
                      n_ranges: int | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` over the whole table ordered by ``order_col``
    (ties share one running value: input should be one row per distinct order
    value). Adds ``cum_<c>`` (inclusive).

    The table is dealt out by range (``n_ranges`` ranges, the session's shuffle
    partitions by default) and stored once with its range numbers; range totals give
    offsets, and each range is summed in its own task. Splitters are the range
    exchange's own sample, so any orderable column will do (strings too) and nothing is
    gathered in one task but one total per range."""
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    dealt = df.repartitionByRange(n_ranges, order) if n_ranges else df.repartitionByRange(order)
    data = reliable_checkpoint(dealt.withColumn("__b", F.spark_partition_id()))
    totals = data.groupBy("__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    # one row per range: one small window and a broadcast of as many rows
    wt = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__b", *[F.coalesce(F.sum(f"__t_{c}").over(wt), F.lit(0)).alias(f"__off_{c}")
                                     for c in sum_cols])
    wl = Window.partitionBy("__b").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = data.select("*", *[F.sum(c).over(wl).alias(f"__loc_{c}") for c in sum_cols])
    out = local.join(F.broadcast(offsets), on="__b", how="inner")
    return out.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"cum_{c}")
                                     for c in sum_cols])
