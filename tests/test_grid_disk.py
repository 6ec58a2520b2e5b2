"""A grid leaves neither the shuffle files nor the checkpoints of an experiment behind."""

import glob
import os
import time

from pyspark.sql import functions as F

from txrisk.plans import experiments as ex
from txrisk.session import ensure_checkpoint_dir, freed_shuffles, reliable_checkpoint, scratch_checkpoints


def _shuffles(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def _checkpoints(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in glob.glob(f"{base}/**/rdd-*/part-*", recursive=True)}


def _gone(spark, before):
    for _ in range(100):
        if not (new := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    return not new


def _dealt(spark, n=1000):
    return spark.range(n).repartition(5, F.col("id") % 7).groupBy("id").agg(F.max("id").alias("top"))


def test_shuffles_of_a_query_are_freed(spark):
    before, kept = _shuffles(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    with freed_shuffles(spark):
        df = _dealt(spark)
        assert reliable_checkpoint(df).count() == 1000
        assert df.count() == df.count() == 1000          # again: it shuffles again
    assert _gone(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept


def test_scratch_checkpoints_are_deleted_and_others_stay(spark):
    outer = reliable_checkpoint(spark.range(5))
    at, folder = _checkpoints(spark), os.path.dirname(spark.sparkContext.getCheckpointDir())
    with scratch_checkpoints(spark):
        assert reliable_checkpoint(spark.range(10)).count() == 10
        assert len(_checkpoints(spark) - at) > 0
    assert not _checkpoints(spark) - at
    assert os.path.dirname(spark.sparkContext.getCheckpointDir()) == folder
    assert outer.count() == 5 and reliable_checkpoint(spark.range(3)).count() == 3


def test_experiments_leave_nothing_to_the_next(spark, monkeypatch):
    found, at, before = [], _checkpoints(spark), _shuffles(spark)
    monkeypatch.setattr(ex, "GRID_ROWS", 1)

    def run(e):
        found.append((_gone(spark, before), len(_checkpoints(spark) - at)))
        return reliable_checkpoint(_dealt(spark)).count()

    assert ex._side_by_side(spark, run, ["a", "b", "c"], 1000) == [1000] * 3
    assert found == [(True, 0)] * 3
