"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import (conversations as repairs, exact_dedup, lm_score, mixing, packing, pii, quality,
                        rollups, simhash, suffix_dedup, topk, toxicity, vector_codes)
from txrisk.llm.common import conversations, documents, embeddings, labels
from txrisk.session import ensure_checkpoint_dir, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


@query("op1_lm_scoring")
def op1(spark, sf):
    return lm_score.ctw_scores(documents(spark, sf))


@query("op2_mixing")
def op2(spark, sf):
    return mixing.mix_documents(documents(spark, sf))


@query("op3_simhash_near_dedup")
def op3(spark, sf):
    return simhash.near_groups(documents(spark, sf))


@query("op4_toxicity")
def op4(spark, sf):
    return toxicity.toxicity(documents(spark, sf), labels(spark, sf))


@query("op5_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
""")
def op5(spark, sf):
    return exact_dedup.exact_groups(documents(spark, sf))


@query("op6_packing")
def op6(spark, sf):
    return packing.pack(documents(spark, sf), with_ids=False)


@query("op7_pii")
def op7(spark, sf):
    return pii.find_pii(documents(spark, sf))


@query("op8_suffix_dedup")
def op8(spark, sf):
    return suffix_dedup.repeated_passages(documents(spark, sf)).drop("spans")


@query("op9_token_counts", rollups.ORACLE)
def op9(spark, sf):
    return rollups.maintained_totals(documents(spark, sf))


@query("op10_quality_rules")
def op10(spark, sf):
    return quality.quality_rules(documents(spark, sf), labels(spark, sf).where("quality = 1"))


@query("op11_vector_codes", vector_codes.oracle_sql())
def op11(spark, sf):
    return vector_codes.coded_rows(embeddings(spark, sf))


@query("op12_conversation_repair")
def op12(spark, sf):
    return repairs.repaired_conversations(conversations(spark, sf))


@query("op13_exact_top_k", r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS c_r,
         list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
),
t AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, c_r)::INTEGER AS "rank" FROM s
)
SELECT query_id, "rank", vec_id, score FROM t WHERE "rank" <= 5
""")
def op13(spark, sf):
    return topk.top_k(embeddings(spark, sf))
