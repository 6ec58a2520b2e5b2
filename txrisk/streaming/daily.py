"""Tumbling one-day windows as a streaming aggregate.

Rows are staged as Parquet files partitioned by day; the stream reads them
them and counts rows and positives per one-day window in ``update`` mode, and each micro-batch overwrites only the day partitions it
updated (dynamic partition overwrite), so replays are idempotent.

A replay reads files in no order of event time, so by default there is no watermark
and no row is late; the state is one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.time import SECONDS_PER_DAY


def stage_by_day(df: DataFrame, path: str, time_col: str = "TransactionDT") -> None:
    df.withColumn("__day", F.floor(F.col(time_col) / SECONDS_PER_DAY).cast("long")) \
        .sortWithinPartitions("__day").write.mode("overwrite").partitionBy("__day").parquet(path)


def stream_daily_counts(spark: SparkSession, staged: str, out: str, checkpoint: str,
                        time_col: str = "TransactionDT", label_col: str = "isFraud",
                        watermark: str | None = None, files_per_trigger: int = 8,
                        origin: int | None = None, timeout_s: int | None = None) -> DataFrame:
    """Returns (day, window_start, n, positives) read back from the sink.

    Days start at ``origin`` (default: the earliest staged time), like the day
    index ``floor((dt - min dt) / 86400)``; ``day`` is that index.
    """
    schema = spark.read.parquet(staged).schema
    if origin is None:
        origin = int(spark.read.parquet(staged).agg(F.min(time_col)).first()[0])
    offset = int(origin) % SECONDS_PER_DAY
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", int(files_per_trigger)).parquet(staged)
           .withColumn("__ts", F.timestamp_seconds(F.col(time_col))))
    if watermark:  # only where files arrive in order of event time
        src = src.withWatermark("__ts", watermark)
    agg = (src.groupBy(F.window("__ts", "1 day", startTime=f"{offset} seconds").alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("long")).alias("positives")))

    def sink(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select(
            F.floor((F.unix_seconds(F.col("w.start")) - F.lit(int(origin))) / SECONDS_PER_DAY)
            .cast("long").alias("day"),
            F.col("w.start").alias("window_start"), "n", "positives")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("day").parquet(out)

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(*[timeout_s] * (timeout_s is not None))
    if q.isActive:
        q.stop()
        raise TimeoutError("daily stream did not finish")
    # partition discovery infers int for the day column; keep the written type
    return spark.read.parquet(out).withColumn("day", F.col("day").cast("long"))
