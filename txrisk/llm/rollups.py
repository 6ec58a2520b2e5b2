"""Delta-maintained token-count rollups.

A rollup holds additive totals (documents, tokens) by source, language and tokenizer
version. Changes arrive as batches of signed rows: an insert adds a document's count,
a delete subtracts it, a revision subtracts the old count and adds the new one. A batch is
reduced to one delta per group (map-side combined, so a hot source costs one row per
task) and committed below its batch id: a folder ``batch=<id>`` written in one step
whose ``_SUCCESS`` marker is the commit. A batch that is committed already is not
applied again, one that broke off before its marker is written anew, so replays and
retries leave the totals unchanged. Totals are the sum of the committed deltas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import WORD_RE, text_of
from txrisk.session import path_exists, shared_path

#: Tokenizer versions: name and the pattern of one token.
VERSIONS = {"words-1": WORD_RE, "words-2": r"[A-Za-z0-9]+|[^\x20\x09-\x0DA-Za-z0-9]+"}
GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def token_count(text: Column, version: str) -> Column:
    return F.regexp_count(text, F.lit(VERSIONS[version])).cast("long")


def signed(docs: DataFrame, version: str, sign: int) -> DataFrame:
    """Signed change rows: every document of ``docs`` inserted (+1) or deleted (-1)
    under a tokenizer version. Null texts have no tokens; null sources and languages
    are groups of their own."""
    return docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.lit(version).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"),
                       (F.lit(sign) * token_count(text_of(), version)).alias("n_tokens"))


def revised(docs: DataFrame, old: str, new: str) -> DataFrame:
    """Change rows of documents recounted under another tokenizer version."""
    return signed(docs, old, -1).unionByName(signed(docs, new, 1))


class Rollup:
    """Totals below ``path`` (a folder all executors reach)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self.path}/batch={batch}/_SUCCESS")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once. Returns False, without work, where it was committed."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch id has letters, digits, - and _ only")
        if self.committed(batch):
            return False
        delta = (changes.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                 .where("n_docs <> 0 or n_tokens <> 0"))
        delta.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
            f"{self.path}/batch={batch}")
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Totals over the committed ones of ``batches``; groups that are back at zero
        are left out."""
        done = [f"{self.path}/batch={b}" for b in batches if self.committed(b)]
        d = self.spark.read.schema(SCHEMA).parquet(*done) if done else self.spark.createDataFrame([], SCHEMA)
        return (d.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0"))


def maintained_totals(docs: DataFrame) -> DataFrame:
    """A history over all documents that ends with every one of them: ``words-1`` counts arrive, a
    seventh of the documents (by id hash) is deleted and inserted again, every document is recounted
    under ``words-2``, and the deletion is sent a second time.

    Repeated rows count each, null ids like any other; null texts have no tokens, null sources and
    languages are groups of their own; an empty table gives no rows; other columns are not read."""
    rollup = Rollup(docs.sparkSession, shared_path(docs.sparkSession, "llm", "rollup", unique=True))
    gone = docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0)
    rollup.commit("load", signed(docs, "words-1", 1))
    rollup.commit("delete", signed(gone, "words-1", -1))
    rollup.commit("insert", signed(gone, "words-1", 1))
    rollup.commit("revise", revised(docs, "words-1", "words-2"))
    rollup.commit("delete", signed(gone, "words-1", -1))
    return rollup.totals(["load", "delete", "insert", "revise"])


ORACLE = """
SELECT source, lang, 'words-2' AS tokenizer, count(*) AS n_docs,
       CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^\\x20\\x09-\\x0DA-Za-z0-9]+'))) AS BIGINT) AS n_tokens
FROM documents GROUP BY source, lang
"""
