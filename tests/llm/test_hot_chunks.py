"""Rows that share id and length are dealt over several chunks; results stay the same."""
import pytest
from pyspark.sql import functions as F

from txrisk.llm import lm_score, suffix_dedup
from txrisk.llm.common import chunked_by_row


def _docs(spark):
    passage = "the same sixty byte passage stands in every one of these rows. "
    rows = [(7, passage + "repeated in full") for _ in range(3000)]
    rows += [(None, passage + f"no id {i % 10}") for i in range(600)]
    rows += [(9, "before " + passage + "after"), (3, "short"), (4, None), (5, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_chunks_of_repeated_rows_are_bounded(spark):
    d = _docs(spark).withColumn("text", F.coalesce("text", F.lit("")))
    size = F.octet_length("text") + 64
    dealt = chunked_by_row(d, size, 40, 20000)
    assert dealt.columns == ["doc_id", "text", "chunk"]
    assert sorted(map(repr, dealt.drop("chunk").collect())) == sorted(map(repr, d.collect()))
    most = dealt.groupBy("chunk").agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0]
    assert most < 3 * 20000
    whole = chunked_by_row(d, size, 1, 8 << 20)
    assert whole.where("chunk <> 0").count() == 0 and whole.count() == d.count()


def test_passages_of_repeated_rows_do_not_depend_on_chunks(spark):
    docs = _docs(spark)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    small, whole = (sorted(map(repr, suffix_dedup.repeated_passages(docs, *sizes).select(columns).collect()))
                    for sizes in ((60000, 200000), (8 << 20, 48 << 20)))
    assert small == whole and len(whole) == docs.count()
    got = suffix_dedup.repeated_passages(docs, 60000, 200000)
    # The smallest id keeps its passage in every repeated row; larger and null ids lose it.
    assert got.where("doc_id = 7 and n_removed > 0").count() == 0
    assert got.where("doc_id = 9 and n_removed >= 63").count() == 1
    assert got.where("doc_id is null and n_removed >= 63").count() == 600


def test_scores_of_repeated_rows_do_not_depend_on_chunks(spark):
    docs = _docs(spark)
    small, whole = ({(r["doc_id"], r["n_bytes"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["n"]): r
                     for r in lm_score.ctw_scores(docs, chunk_bytes=size).groupBy(
                         "doc_id", "n_bytes", "held_out", "n_tokens", "n_known", "train_tokens")
                     .agg(F.count("*").alias("n"), F.min("score").alias("least"), F.max("score").alias("most"),
                          F.sum("base_score").alias("base")).collect()} for size in (20000, 8 << 20))
    assert small.keys() == whole.keys() and sum(k[-1] for k in small) == docs.count()
    for k, r in small.items():
        assert [r["least"], r["most"]] == pytest.approx([whole[k]["least"], whole[k]["most"]], rel=1e-5)
        assert r["base"] == pytest.approx(whole[k]["base"])
    rows = {(k[0], k[-1]) for k in small}
    assert (7, 3000) in rows and (None, 600) in rows
