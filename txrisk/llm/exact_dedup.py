"""Exact deduplication with a heavy-hitter split (native DataFrame code only).

Texts are equal when they agree after deleting every ASCII white-space character;
the SHA-256 of what is left stands for the text. A frequent digest may hold a large
share of all rows, so it never meets an ordinary shuffle:

1. Misra-Gries: the frequent-items sketch ``approx_top_k`` finds the frequent
   digests. It runs per shard of digest space, so sketches merge in ``SHARDS`` tasks
   and any digest with more than 1 in ``TOP`` of its shard's rows is found.
2. Verification: exact size and winner of every candidate by a map-side combined
   aggregate. At most ``SHARDS * TOP`` rows, which bounds the broadcast.
3. Rows of a verified digest are answered (or removed) map-side by that broadcast.
4. The remaining digests take an ordinary shuffle on the digest.

Of equal texts the row with the most code points in the original text stays, then
the smallest ``doc_id`` (null last), then any one row of full repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.common import SPACE_RE, text_of, written

SHARDS = 64          # digest shards, each with its own sketch
TOP = 256            # frequent digests taken from a shard
TRACKED = 2048       # counters of a sketch
HEAVY_MIN = 64       # estimated copies from which a digest is treated as frequent


def digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(text, SPACE_RE, "").cast("binary"), 256)


def heavy_winners(rows: DataFrame, heavy_min: int = HEAVY_MIN) -> DataFrame:
    """(``_digest``, ``_keep_id``, ``_keep_n``, ``_keep_row``, ``_size``) of the frequent digests of
    ``rows`` (``_id``, ``_n``, ``_digest``, ``_row``): at most ``SHARDS * TOP`` rows. The
    winner comes from an aggregate with map-side combining, row number last, so any number
    of equal rows leaves one."""
    shard = F.conv(F.substring("_digest", 1, 4), 16, 10).cast("int") % SHARDS
    found = (rows.groupBy(shard.alias("_shard"))
             .agg(F.expr(f"approx_top_k(_digest, {TOP}, {TRACKED})").alias("_top"))
             .select(F.explode("_top").alias("_top"))
             .where(F.col("_top.count") >= heavy_min)
             .select(F.col("_top.item").alias("_digest")))
    first = F.min(F.struct(-F.col("_n"), F.col("_id").isNull(), F.col("_id"), F.col("_row"), F.col("_n")))
    return (rows.join(F.broadcast(found), "_digest")
            .groupBy("_digest").agg(first.alias("_w"), F.count(F.lit(1)).alias("_size"))
            .select("_digest", F.col("_w._id").alias("_keep_id"), F.col("_w._n").alias("_keep_n"),
                    F.col("_w._row").alias("_keep_row"), "_size"))


def exact_groups(docs: DataFrame, heavy_min: int = HEAVY_MIN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and form one group with empty and white-space texts.
    Repeated rows are separate rows of their group, one of which is kept. An empty
    table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    text = text_of()
    rows = written(spark, docs.select(F.col("doc_id").alias("_id"), F.length(text).alias("_n"), digest(text).alias("_digest"),
                                      F.monotonically_increasing_id().alias("_row")), "exact_digests")
    heavy = written(spark, heavy_winners(rows, heavy_min), "exact_heavy")
    by_digest = Window.partitionBy("_digest")
    ranked = by_digest.orderBy(F.col("_n").desc(), F.col("_id").asc_nulls_last(), "_row")
    out = [F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"),
           F.col("_size").cast("long").alias("group_size"), F.col("_kept").alias("kept"),
           F.col("_digest").alias("text_sha256")]
    frequent = (rows.join(F.broadcast(heavy), "_digest")
                .withColumn("_kept", F.col("_row") == F.col("_keep_row")))
    rest = (rows.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti")
            .withColumn("_kept", F.row_number().over(ranked) == 1)
            .withColumn("_keep_id", F.first("_id").over(ranked))
            .withColumn("_size", F.count(F.lit(1)).over(by_digest)))
    return frequent.select(*out).unionByName(rest.select(*out))


def drop_exact_copies(docs: DataFrame, heavy_min: int = HEAVY_MIN) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep (of rows that tie in
    length and id, any one stays), all columns as they were, whatever their names. Rows of
    a frequent digest go map-side, down to one per task; one shuffle carries the rest."""
    spark = docs.sparkSession
    text = text_of()
    narrow = written(spark, docs.select(F.col("doc_id").alias("_id"), F.length(text).alias("_n"), digest(text).alias("_digest"),
                                        F.lit(0).alias("_row")), "exact_digests")
    heavy = written(spark, heavy_winners(narrow, heavy_min), "exact_heavy")
    d = docs.select(F.struct("*").alias("_doc"), F.length(text).alias("_n"), digest(text).alias("_digest"))
    ranked = Window.partitionBy("_digest").orderBy(F.col("_n").desc(), F.col("_doc.doc_id").asc_nulls_last())
    wins = F.col("_doc.doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("_n") == F.col("_keep_n"))
    frequent = (d.join(F.broadcast(heavy), "_digest").where(wins)
                .groupBy("_digest").agg(F.first("_doc").alias("_doc")))
    rest = (d.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti")
            .withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1"))
    return frequent.select("_doc.*").unionByName(rest.select("_doc.*"))
