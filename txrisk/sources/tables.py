"""Driver tables and the transaction-shaped views over them (FIXTURES §2).

Every view is a lazy projection of a Parquet scan, so Catalyst prunes columns
and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.time import epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tx_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in transaction shape: id, dt, amt, card1, card2, addr1, product, y, score.

    card2 comes from the JSON ``props.k``; addr1 = card2 % 10 with 0 mapped to
    null (the null-key case); y marks ``error`` events; score = amt / 500 is a
    rule score used by metric queries.
    """
    ev = table(spark, sf_dir, "events")
    card2 = F.get_json_object("props", "$.k").cast("int")
    addr = F.pmod(card2, F.lit(10))
    return ev.select(
        F.col("event_id").alias("id"),
        epoch_seconds(ev, "ts").alias("dt"),
        F.col("value").alias("amt"),
        F.col("user_id").alias("card1"),
        card2.alias("card2"),
        F.when(addr == 0, F.lit(None).cast("int")).otherwise(addr).alias("addr1"),
        F.col("event_type").alias("product"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        (F.col("value") / F.lit(500.0)).alias("score"),
    )


def tied_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` keyed by customer with day-resolution time (many ties)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        epoch_seconds(o, "o_orderdate").alias("dt"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_custkey").alias("cust"),
    )


def side_table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial side table: ``labels`` covers only some ``documents``."""
    return table(spark, sf_dir, "labels")


def documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


def labelled_scores_view(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """(id, y, score) with score = least(n_chars, 5000) / 5000 over labelled documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("y"))
    return lab.join(d, "doc_id", "inner").select(
        F.col("doc_id").alias("id"),
        F.col("y").cast("int").alias("y"),
        (F.least(F.col("n_chars"), F.lit(5000)) / F.lit(5000.0)).alias("score"),
    )


def vectors_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features array<double>, y) over ``embeddings``; y = (label == 0)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        F.col("label").alias("label"),
    )


def tx_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx`` plus P1-P3 time features (seconds_of_day, cents, day)."""
    from txrisk.functions.time import add_time_features
    return add_time_features(tx_view(spark, sf_dir), time_col="dt", amount_col="amt",
                             seconds_col="seconds_of_day", cents_col="cents", day_col="day")


def joined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over the partial side table: documents LEFT JOIN labels."""
    from txrisk.operators.prep import left_join_unique
    return left_join_unique(documents_view(spark, sf_dir), side_table_view(spark, sf_dir), "doc_id")


def tx_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx`` under the transaction table's column names (TransactionID, isFraud,
    TransactionDT, TransactionAmt, ProductCD, card1, card2, addr1)."""
    return tx_view(spark, sf_dir).select(
        F.col("id").alias("TransactionID"), F.col("y").alias("isFraud"),
        F.col("dt").alias("TransactionDT"), F.col("amt").alias("TransactionAmt"),
        F.col("product").alias("ProductCD"), "card1", "card2", "addr1")


def tx_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 over ``tx``: time features -> impute -> category codes."""
    from txrisk.functions.time import add_time_features
    from txrisk.operators.prep import EXCLUDE_COLS, encode_categories, impute
    d = add_time_features(tx_transactions(spark, sf_dir))
    declared = ["ProductCD"]  # stays null through imputation, so that null is coded last
    return encode_categories(impute(d, exclude=(*EXCLUDE_COLS, *declared)), declared=declared)


def tx_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_prepared`` without ProductCD: the label is derived from the same event
    type, so that column would give it away."""
    return tx_prepared(spark, sf_dir).drop("ProductCD")


CSV_ROWS = 25_000     # rows of a wide CSV file: compressed files are read whole, one per task


def wide_csv_cells(spark: SparkSession, sf_dir: str, schema) -> DataFrame:
    """``tx_transactions`` as text cells in all declared columns: numbers and categories that follow from the
    row, null tokens, and now and then a number that is none. The narrow rows are dealt over files' worth of
    rows; the cells follow from them in one projection and are stored nowhere but in the files."""
    d = tx_transactions(spark, sf_dir)
    d = d.repartition(max(1, -(-d.count() // CSV_ROWS)))
    row, k, cols = "TransactionID", "card2", []
    for j, f in enumerate(schema.fields):
        # an expression a column: arrays over all columns would be filled value by value, uncompiled
        kind = f.dataType.simpleString()
        if f.name in d.columns:
            c = f"cast(`{f.name}` as string)"
        elif kind == "string":
            c = f"""case when ({row} + {j}) % 3 = 0 then 'NA' when ({row} + {j}) % 3 = 1 then 'T' else 'F "q", x' end"""
        else:
            c = f"case when ({k} + {j}) % 7 = 0 then 'nan' else cast(({k} * {j + 1}) % 1000 + 0.5D as string) end"
        if kind == "double" and f.name != "TransactionAmt":
            c = f"case when ({row} + {j}) % 1009 = 0 then concat('bad', cast({row} + {j} as string)) else {c} end"
        cols.append(f"{c} as `{f.name}`")
    return d.selectExpr(*cols)


def identity_csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A side table of every fourth transaction: id_01, id_12, DeviceType."""
    d = tx_transactions(spark, sf_dir).where(F.col("TransactionID") % 4 == 0)
    k = F.col("card2")
    return d.select("TransactionID", F.when(k % 3 != 0, -k).alias("id_01"),
                    F.when(k % 5 != 0, F.when(k % 2 == 0, "Found").otherwise("NotFound")).alias("id_12"),
                    F.when(k % 5 != 1, F.when(k % 2 == 0, "mobile").otherwise("desktop")).alias("DeviceType"))
