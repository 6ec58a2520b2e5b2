"""Preparation operators: join, null profile, imputation, category codes, split."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.session import reliable_checkpoint

# Fixed values from the reference: columns never imputed or used as features,
# the literal used for missing categories, and the default offline period.
EXCLUDE_COLS = ("TransactionID", "isFraud", "TransactionDT")
MISSING = "missing"
DEFAULT_OFFLINE_WEEKS = 8

SMALL_VOCABULARY = 10_000              # a column's category codes are broadcast up to so many values
SMALL_VOCABULARY_BYTES = 1_000_000     # of so many bytes together

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def is_numeric(dtype) -> bool:
    return isinstance(dtype, _NUMERIC)


def is_string(dtype) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


# ------------------------------------------------------------------ J1 / J2
def left_join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left equi-join on a key unique on the right side. AQE turns it into a
    broadcast hash join only when the right side's runtime size is below the
    broadcast threshold, else a sort-merge join (skew splitting on)."""
    return left.join(right, on=key, how="left")


# ------------------------------------------------------------------ P9
def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one aggregate + unpivot.
    NaN counts as missing for floating columns (pandas ``isnull``)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            miss = miss | F.isnan(c)
        exprs.append(F.sum(miss.cast("long")).alias(f.name))
    wide = df.agg(*exprs)
    return wide.unpivot([], [f.name for f in df.schema.fields], "column", "nulls") \
        .select("column", F.coalesce("nulls", F.lit(0)).cast("long").alias("nulls"))


def any_null(df: DataFrame) -> Column:
    """P9 predicate as a scalar subquery column: true when any cell is missing."""
    return null_counts(df).select((F.sum("nulls") > 0).alias("any_null")).scalar()


# ------------------------------------------------------------------ P10
def impute(df: DataFrame, exclude=EXCLUDE_COLS) -> DataFrame:
    """P10 (F9): strings -> 'missing', numbers (null or NaN) -> 0, except the
    excluded columns; then the residual rule fills every remaining null with 0.

    Filling only touches missing cells, so "fill the rest with 0 if anything is
    still missing" equals "fill missing excluded numeric cells with 0": one
    projection, no driver round-trip.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if is_string(f.dataType):
            filled = F.coalesce(c, F.lit(MISSING)) if f.name not in exclude else c
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            filled = F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)).cast(f.dataType)
        elif is_numeric(f.dataType):
            filled = F.coalesce(c, F.lit(0)).cast(f.dataType)
        else:
            filled = c
        out.append(filled.alias(f.name))
    return df.select(*out)


# ------------------------------------------------------------------ P12
def _rank_vocabulary(vocab: DataFrame, n_buckets: int, single_bucket_max: int) -> DataFrame:
    """(column, value, code): 0-based rank of each distinct value in its column.

    Large vocabularies are split into value ranges: bounds are every 4th value
    of a hash sample of the *distinct* values (uniform over values, so a
    frequent value cannot skew it; about 4 x n_buckets values per column reach
    the driver). Per-range counts give offsets, and values are ranked only
    inside their (column, range).
    """
    sizes = {r["column"]: int(r["n"]) for r in
             vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    big = {c: n for c, n in sizes.items() if n > single_bucket_max}
    bounds: dict[str, list[str]] = {}
    if big:
        every = F.lit(1)
        for c, n in big.items():
            every = F.when(F.col("column") == F.lit(c), F.lit(max(1, n // (4 * n_buckets)))).otherwise(every)
        sample = vocab.filter(F.col("column").isin(list(big)) &
                              (F.pmod(F.xxhash64("value"), every.cast("long")) == 0)).collect()
        for c in big:
            vals = sorted(r["value"] for r in sample if r["column"] == c)
            bounds[c] = vals[3::4]
    b_arr = F.array().cast("array<string>")
    for c, bs in bounds.items():
        b_arr = F.when(F.col("column") == F.lit(c), F.array(*[F.lit(v) for v in bs])).otherwise(b_arr)
    v = F.col("value")
    bucketed = vocab.withColumn("__b", F.size(F.filter(b_arr, lambda x: x < v)))
    counts = bucketed.groupBy("column", "__b").agg(F.count(F.lit(1)).alias("__n"))
    w_off = Window.partitionBy("column").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("column", "__b", F.coalesce(F.sum("__n").over(w_off), F.lit(0)).alias("__off"))
    local = bucketed.withColumn("__r", F.row_number().over(
        Window.partitionBy("column", "__b").orderBy("value")) - 1)
    # offsets: at most n_buckets rows per column, a bounded broadcast.
    return local.join(F.broadcast(offsets), ["column", "__b"], "inner").select(
        "column", "value", (F.col("__off") + F.col("__r")).cast("int").alias("code"))


def category_lookup(df: DataFrame, declared=(), plain=(), n_buckets: int = 256,
                    single_bucket_max: int = 1_000_000) -> DataFrame:
    """Vocabulary table (column, value, code) for the given string columns.

    declared (typed as category at ingest): codes rank the distinct non-null
    values; null gets the code of a literal 'missing' if present, else the
    next code (appended last). plain strings: null is 'missing' and takes its
    sorted place. A null ``value`` row carries the null code.
    """
    declared, plain = list(declared), list(plain)
    cols = declared + plain
    if not cols:
        return None
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 (F.col(f"`{c}`") if c in declared
                  else F.coalesce(F.col(f"`{c}`"), F.lit(MISSING))).alias("value"))
        for c in cols])).alias("s")).select("s.column", "s.value")
    # Distinct (column, value) pairs, stored once: read again for sizing,
    # sampling and ranking (bounded by the columns' cardinalities).
    vocab = reliable_checkpoint(stacked.filter(F.col("value").isNotNull()).distinct())
    ranked = _rank_vocabulary(vocab, n_buckets, single_bucket_max)
    stats = ranked.groupBy("column").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.max(F.when(F.col("value") == F.lit(MISSING), F.col("code"))).alias("missing_code"))
    null_rows = stats.select(
        "column", F.lit(None).cast("string").alias("value"),
        F.when(F.col("column").isin(declared) if declared else F.lit(False),
               F.coalesce("missing_code", "n")).otherwise(F.col("missing_code")).alias("code"))
    return ranked.unionByName(null_rows)


def encode_categories(df: DataFrame, declared=(), plain=(), suffix: str = "") -> DataFrame:
    """Replace each listed string column by its integer code.

    One lookup table for all columns; each column joins its slice with a
    null-safe equi-join. A slice of at most ``SMALL_VOCABULARY`` values is broadcast,
    so the table stays where it lies: shuffled by a column of a few values, most of its
    rows would meet in one task. Longer slices are left to AQE.
    """
    declared, plain = list(declared), list(plain)
    lookup = category_lookup(df, declared, plain)
    if lookup is None:
        return df
    # The vocabulary (bounded by column cardinalities) is built by one pass over
    # the table and stored once, instead of being re-derived for every column.
    lookup = reliable_checkpoint(lookup)
    measured = lookup.groupBy("column").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(F.octet_length("value")).alias("size")).collect()  # one row per column
    small = {r["column"] for r in measured if r["n"] <= SMALL_VOCABULARY and (r["size"] or 0) <= SMALL_VOCABULARY_BYTES}
    out = df
    for c in declared + plain:
        tmp = f"__code_{c}"
        sl = lookup.filter(F.col("column") == F.lit(c)).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(tmp))
        if c in small:
            sl = F.broadcast(sl)
        key = F.col(f"`{c}`") if c in declared else F.coalesce(F.col(f"`{c}`"), F.lit(MISSING))
        out = out.join(sl, key.eqNullSafe(F.col(f"__v_{c}")), "left").drop(f"__v_{c}")
    sel = []
    for col in df.columns:
        if col in declared or col in plain:
            sel.append(F.col(f"__code_{col}").alias(col + suffix))
        else:
            sel.append(F.col(f"`{col}`"))
    return out.select(*sel)


# ------------------------------------------------------------------ P4 / P5
def split_train_test(df: DataFrame, offline_weeks: int = DEFAULT_OFFLINE_WEEKS,
                     day_col: str = "TransactionDay"):
    """P4 (F11): day < weeks*7 -> train, else test. Two filters on one input."""
    cut = int(offline_weeks) * 7
    return df.filter(F.col(day_col) < cut), df.filter(F.col(day_col) >= cut)


def split_profile(df: DataFrame, offline_weeks: int = DEFAULT_OFFLINE_WEEKS,
                  day_col: str = "TransactionDay", label_col: str = "isFraud") -> DataFrame:
    """P5: rows, positive rate and day range per side, in one aggregate."""
    cut = int(offline_weeks) * 7
    side = F.when(F.col(day_col) < cut, F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(label_col).cast("double")).alias("positive_rate"),
        F.min(day_col).alias("first_day"),
        F.max(day_col).alias("last_day"))


# ------------------------------------------------------------------ P6
def feature_columns(columns, exclude=EXCLUDE_COLS) -> list[str]:
    """Model inputs = every column except id, label and raw time."""
    return [c for c in columns if c not in set(exclude)]


# ------------------------------------------------------------------ P8
# ------------------------------------------------------------------ P13 / P14
def round_metrics(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def windows_label(windows) -> str | None:
    """P14: '1+3+7' or None for no windows."""
    return "+".join(str(w) for w in windows) if windows else None


# ------------------------------------------------------------------ P15
# Fixed family rules (name prefix or substring) from the dataset statistics report.
FAMILIES = (
    ("Card Features", "prefix", "card"),
    ("Address Features", "prefix", "addr"),
    ("Distance Features", "prefix", "dist"),
    ("Email Features", "contains_lower", "email"),
    ("Count Features", "prefix", "C"),
    ("Time Delta Features", "prefix", "D"),
    ("Match Features", "prefix", "M"),
    ("Vesta Features", "prefix", "V"),
    ("Identity Features", "prefix", "id_"),
)


def column_families(spark, columns) -> DataFrame:
    """Feature count per family over a schema (a small DataFrame of names).
    'Transaction Info' counts TransactionAmt/ProductCD when present; families
    with zero members are dropped."""
    names = spark.createDataFrame([(c,) for c in columns], "name string")
    rules = [F.when(F.col("name").isin("TransactionAmt", "ProductCD"), F.lit("Transaction Info"))]
    fams = []
    for fam, kind, pat in FAMILIES:
        cond = (F.lower("name").contains(pat) if kind == "contains_lower"
                else F.col("name").startswith(pat))
        fams.append(F.when(cond, F.lit(fam)))
    exploded = names.select("name", F.explode(F.filter(F.array(*rules, *fams),
                                                         lambda x: x.isNotNull())).alias("family"))
    return exploded.groupBy("family").agg(F.count(F.lit(1)).alias("features"))
