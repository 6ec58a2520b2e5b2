"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from txrisk.session import shared_path

#: ASCII white space of the contracts: space and 0x09-0x0D.
WS = " \t\n\x0b\f\r"
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir``: lineage ends
    there, and a lost executor does not lose what was computed. The folder may be
    removed once the results built on it are stored."""
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_RE)).cast("long")


def words_of(text: Column) -> Column:
    """Words of ``text`` in order; an empty array when there is none."""
    trimmed = F.btrim(text, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RE))


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed once however often they are used later: a
    one-element ``explode`` keeps the optimizer from copying the expressions into
    every place (lambdas included) that reads them."""
    packed = F.struct(*[c.alias(k) for k, c in cols.items()])
    d = df.withColumn("_once", F.explode(F.array(packed)))
    for k in cols:
        d = d.withColumn(k, F.col(f"_once.{k}"))
    return d.drop("_once")


def n_salts(n_rows: int, per_group: int = 1000, most: int = 65536) -> int:
    """How many salts spread one key that may hold every row, so that a (key, salt)
    group has about ``per_group`` rows (beyond ``most`` salts the groups grow, at a
    rate of one row in 65,536)."""
    return int(min(most, max(1, -(-n_rows // per_group))))


def rank_in_groups(df: DataFrame, keys: list[str], order: list[Column], salt: Column,
                   salts: int, rank: str = "rank") -> DataFrame:
    """0-based ranks inside each group of ``keys``, without one task per group: rows
    rank inside (keys, salt) and add the sizes of the group's lower salts. ``keys``
    must not be null. Rows that tie in ``order`` get their ranks in any order."""
    d = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    w = W.Window.partitionBy(*keys).orderBy("_salt").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = (d.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_salt", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")))
    inner = W.Window.partitionBy(*keys, "_salt").orderBy(*order)
    return (d.join(offsets, [*keys, "_salt"])
            .withColumn(rank, (F.row_number().over(inner) - 1 + F.col("_before")).cast("long"))
            .drop("_salt", "_before"))


def chunked_by_row(d: DataFrame, size: Column, chunks: int, chunk_bytes: int) -> DataFrame:
    """``d`` with a column ``chunk``: rows are dealt by their id and text length, and rows
    that share both and come to more than a quarter of a chunk (full repeats of one row,
    null ids) by a row number that is stored with them, so that no chunk gathers them."""
    key = {"_key_id": F.col("doc_id"), "_key_n": F.length("text")}
    heavy = (d.select(*[c.alias(k) for k, c in key.items()], size.alias("_size")).groupBy(*key)
             .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_size"))
             .where((F.col("_rows") > 1) & (F.col("_size") > chunk_bytes // 4)).select(*key))
    heavy = written(d.sparkSession, heavy, "heavy_rows")
    chunk = lambda *salt: F.pmod(F.xxhash64("doc_id", F.length("text"), *salt), F.lit(chunks))
    if heavy.isEmpty():
        return d.withColumn("chunk", chunk())
    same = F.col("_key_id").eqNullSafe(key["_key_id"]) & (F.col("_key_n") == key["_key_n"])
    numbered = written(d.sparkSession, d.join(heavy, same, "left_semi")
                       .withColumn("_row", F.monotonically_increasing_id()), "heavy_texts")
    return (d.join(heavy, same, "left_anti").withColumn("chunk", chunk())
            .unionByName(numbered.withColumn("chunk", chunk("_row")).drop("_row")))


def give_back() -> None:
    """Return a Python worker's freed memory to the system: the worker outlives its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc
    if trim:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
