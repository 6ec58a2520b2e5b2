"""Corpus pipeline: toxicity filter, exact dedup, SimHash near-dedup, source mixing,
packing. Each stage's result is written as Parquet and read again as the next one's
``docs``; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import exact_dedup, mixing, packing, simhash, toxicity
from txrisk.llm.common import documents, labels, written
from txrisk.session import ensure_checkpoint_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return toxicity.drop_toxic(docs, labels(spark, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shingle length and bit distance are those of the operator's contract."""
    _ready(spark)
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document the mix takes several times stands in as many rows."""
    _ready(spark)
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.pack(docs, with_ids=False)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("simhash_near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

#: Stages 1, 3 and 5 (decoder, fingerprints, tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
