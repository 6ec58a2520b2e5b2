"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Document rates minimise the bounded
entropy sum(r log r + (c - r) log(c - r)) against rate 1, subject to
sum(r * size) = target in every source; the optimum tilts the rates exponentially,
    r = c / (1 + (c - 1) exp(-lambda * size / mean size)),   c = MAX_COPIES,
and the convex dual has one unknown lambda per source. Distributed Newton iterations
(kept inside a bracket) solve all of them at once. Rates depend on a document only
through its source and size, so the iterations run over the counts of (source, size)
cells. Rates become whole copies: floors, then the fractions by systematic rounding
along descending sizes, then a few passes that spend what is still missing (or too
much) on the largest sizes that fit.

A cell's copies go to its documents in the order of a hash of the id. Ranks are
salted, so a cell or source may hold any share of the rows. The cells of one source
meet in one task: d distinct sizes need at least d(d-1)/2 words, so a source of 10^13
words has less than 4.5 million of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.common import n_salts, rank_in_groups, text_of, word_count, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
TOLERANCE = 1e-9
MAX_NEWTON = 60
FIX_PASSES = 4

SRC = ["_has", "_src"]


def source_targets(totals: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """Adds ``_target`` to (``_has``, ``_src``, ``_total``). Weights repeat along the
    sources in code point order, null last. Targets share the sum of all totals by
    weight; one that would exceed ``most`` times its total stops there and the excess
    is shared again, until none is above."""
    spark = totals.sparkSession
    ranged = written(spark, totals.repartitionByRange(F.col("_has").desc(), F.col("_src"))
                     .sortWithinPartitions(F.col("_has").desc(), F.col("_src"))
                     .withColumn("_id", F.monotonically_increasing_id()), "mix_sources")
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = (ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    rank = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    weight = reduce(lambda c, k: F.when(rank % len(weights) == k, float(weights[k])).otherwise(c),
                    range(len(weights)), F.lit(0.0))
    s = written(spark, ranged.withColumn("_part", part).join(offsets, "_part")
                .select(*SRC, "_total", weight.alias("_weight")), "mix_weights")
    capped = lambda rate: F.col("_weight") * rate > F.lit(float(most)) * F.col("_total")
    everything = s.agg(F.coalesce(F.sum("_total"), F.lit(0))).head()[0]
    rate, n_capped = 0.0, -1
    while True:
        full = capped(rate) if n_capped >= 0 else F.lit(False)
        n, taken, free = s.agg(F.count(F.when(full, 1)),
                               F.coalesce(F.sum(F.when(full, F.col("_total"))), F.lit(0)),
                               F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).head()
        if n == n_capped or not free:
            break
        rate, n_capped = (everything - most * taken) / free, n
    return s.withColumn("_target", F.least(F.col("_weight") * F.lit(float(rate)),
                                           (F.lit(float(most)) * F.col("_total"))))


def _rate(lam, z, most: int):
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(F.least(-lam * z, F.lit(700.0))))


def newton(cells: DataFrame, sources: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """``sources`` with the dual variable ``_lam`` of each; null where the target is
    ``most`` times the words (every rate is ``most``) or there are no words."""
    spark = cells.sparkSession
    state = written(spark, sources.withColumn(
        "_lam", F.when((F.col("_total") > 0) & (F.col("_target") < most * F.col("_total")), 0.0))
        .withColumn("_lo", F.lit(None).cast("double")).withColumn("_hi", F.lit(None).cast("double"))
        .withColumn("_gap", F.lit(1.0)), "mix_newton")
    for _ in range(MAX_NEWTON):
        z = F.col("_size") / F.col("_mean")
        r = _rate(F.col("_lam"), z, most)
        sums = (cells.join(state.where("_lam is not null").select(*SRC, "_lam", "_mean"), SRC)
                .groupBy(*SRC).agg(F.sum(F.col("_n") * F.col("_size") * r).alias("_g"),
                                   F.sum(F.col("_n") * F.col("_size") * z * r * (1 - r / most)).alias("_h")))
        d = state.drop("_gap").join(sums, SRC, "left")
        over = F.col("_g") - F.col("_target")
        lo = F.when(over < 0, F.col("_lam")).otherwise(F.col("_lo"))
        hi = F.when(over >= 0, F.col("_lam")).otherwise(F.col("_hi"))
        d = d.withColumn("_step", F.col("_lam") - over / F.col("_h")).withColumn("_gap", F.coalesce(
            F.abs(over) / F.greatest(F.col("_target"), F.lit(1.0)), F.lit(0.0)))
        d = d.withColumn("_lo", lo).withColumn("_hi", hi)
        # Newton's step where it stays inside the bracket, else halve or widen the bracket.
        inside = ((F.col("_lo").isNull() | (F.col("_step") > F.col("_lo")))
                  & (F.col("_hi").isNull() | (F.col("_step") < F.col("_hi")))
                  & (F.abs(F.col("_step") - F.col("_lam")) <= 4 + 2 * F.abs("_lam")))
        other = (F.when(F.col("_lo").isNull(), F.col("_hi") * 2 - F.lit(2.0) - F.abs("_hi"))
                 .when(F.col("_hi").isNull(), F.col("_lo") * 2 + F.lit(2.0) + F.abs("_lo"))
                 .otherwise((F.col("_lo") + F.col("_hi")) / 2))
        moved = F.when(F.col("_gap") <= TOLERANCE, F.col("_lam")).when(inside, F.col("_step")).otherwise(other)
        state = written(spark, d.withColumn("_lam", F.when(F.col("_lam").isNotNull(), moved))
                        .drop("_g", "_h", "_step"), "mix_newton")
        if not state.where(F.col("_gap") > TOLERANCE).head(1):
            break
    return state.drop("_lo", "_hi", "_gap")


def whole_copies(cells: DataFrame, sources: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """``cells`` with ``_copies``: how many copies the documents of a cell get together."""
    spark = cells.sparkSession
    d = cells.join(sources, SRC)
    r = F.when(F.col("_lam").isNotNull(), _rate(F.col("_lam"), F.col("_size") / F.col("_mean"), most))
    r = F.when(F.col("_size") == 0, 1.0).otherwise(F.coalesce(r, F.lit(float(most))))
    down = Window.partitionBy(*SRC).orderBy(F.col("_size").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_want", F.round(F.col("_n") * r, 9)).withColumn("_floor", F.floor("_want"))
    d = d.withColumn("_cum", F.sum(F.col("_want") - F.col("_floor")).over(upto))
    d = d.withColumn("_copies", (F.col("_floor") + F.floor(F.col("_cum") + 0.5) - F.floor(
        F.col("_cum") - (F.col("_want") - F.col("_floor")) + 0.5)).cast("long"))
    d = written(spark, d.withColumn("_copies", F.least(F.greatest(F.col("_copies"), F.lit(0)),
                                                       most * F.col("_n")))
                .select(*SRC, "_size", "_n", "_total", "_target", "_copies"), "mix_cells")
    every = Window.partitionBy(*SRC)
    for _ in range(FIX_PASSES):
        d = d.withColumn("_miss", F.col("_target") - F.sum(F.col("_size") * F.col("_copies")).over(every))
        room = F.when(F.col("_miss") > 0, most * F.col("_n") - F.col("_copies")).otherwise(F.col("_copies"))
        usable = (F.col("_size") > 0) & (F.col("_size") <= F.abs("_miss"))
        d = d.withColumn("_room", F.when(usable, room).otherwise(F.lit(0)))
        used = F.coalesce(F.sum(F.col("_size") * F.col("_room")).over(before), F.lit(0))
        fit = F.floor((F.abs("_miss") - used) / F.greatest("_size", F.lit(1)))
        step = F.least(F.greatest(fit, F.lit(0)), F.col("_room")) * F.signum("_miss").cast("long")
        d = written(spark, d.withColumn("_copies", (F.col("_copies") + step).cast("long"))
                    .drop("_miss", "_room"), "mix_cells")
    return d


def mix(docs: DataFrame, size: str, weights=WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """``docs`` plus ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    ``docs`` has ``doc_id``, ``source`` and the words per document in ``size``; these
    three names must be free. A null source is a source of its own, the last in order;
    documents without words keep one copy. Rows that repeat an id are separate
    documents. Reruns over the same rows agree. An empty table gives an empty result.
    """
    spark, cols = docs.sparkSession, docs.columns
    d = docs.withColumns({"_has": F.col("source").isNotNull(), "_src": F.coalesce("source", F.lit("")),
                          "_size": F.col(size).cast("long")})
    cells = written(spark, d.groupBy(*SRC, "_size").agg(F.count(F.lit(1)).alias("_n")), "mix_hist")
    totals = cells.groupBy(*SRC).agg(F.sum(F.col("_size") * F.col("_n")).alias("_total"),
                                     F.sum("_n").alias("_docs"))
    totals = written(spark, totals, "mix_totals")
    sources = source_targets(totals.select(*SRC, "_total"), weights, most).join(
        totals.select(*SRC, "_docs"), SRC)
    sources = newton(cells, sources.select(*SRC, "_total", "_target",
                                           F.greatest(F.col("_total") / F.col("_docs"), F.lit(1e-9)).alias("_mean")), most)
    planned = whole_copies(cells, sources, most)
    n_docs = totals.agg(F.coalesce(F.sum("_docs"), F.lit(0))).head()[0]
    key = F.xxhash64("doc_id")
    ranked = rank_in_groups(d, [*SRC, "_size"], [key, F.col("doc_id")], key, n_salts(n_docs), "_rank")
    ranked = ranked.join(planned, [*SRC, "_size"])
    each = F.floor(F.col("_copies") / F.col("_n"))
    copies = each + (F.col("_rank") < F.col("_copies") - each * F.col("_n")).cast("long")
    return ranked.select(*cols, F.col("_total").alias("source_size"),
                         F.col("_target").alias("target"), copies.cast("long").alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken. Null texts have
    size 0; other columns are not read."""
    sized = written(docs.sparkSession, docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        word_count(text_of()).alias("size")), "mix_sizes")
    return mix(sized, "size").select("doc_id", "size", "source_size", "target",
                                     (F.col("size") * F.col("copies")).alias("taken"))


def repeat_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns as they were."""
    cols = docs.columns
    packed = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                         word_count(text_of()).alias("size"), F.struct(*cols).alias("_row"))
    mixed = mix(packed, "size").where("copies > 0")
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
