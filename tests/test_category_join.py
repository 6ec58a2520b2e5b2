"""Category codes reach the rows where they lie: a column of a few values must not gather the table in a few tasks."""

from pyspark.sql import functions as F

from txrisk.operators import prep


def _rows(spark, n=4000):
    c = F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 1000 == 7, F.lit(None)).otherwise("a")
    return spark.range(0, n, 1, 4).select("id", c.cast("string").alias("c"))


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_a_short_vocabulary_moves_no_rows(spark):
    coded = prep.encode_categories(_rows(spark), declared=["c"])
    assert sorted(_sizes(coded)) == [1000] * 4
    counts = {r["c"]: r["count"] for r in coded.groupBy("c").count().collect()}
    assert counts == {0: 3596, 1: 400, 2: 4}     # null is coded last


def test_a_long_vocabulary_gives_the_same_codes(spark, monkeypatch):
    want = sorted(map(tuple, prep.encode_categories(_rows(spark), declared=["c"]).collect()))
    monkeypatch.setattr(prep, "SMALL_VOCABULARY", 1)
    coded = prep.encode_categories(_rows(spark), declared=["c"])
    assert sorted(map(tuple, coded.collect())) == want and len(want) == 4000
