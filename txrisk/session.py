"""Session construction and shared storage locations."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every txrisk job relies on. AQE re-plans joins/partition counts at
# runtime and splits skewed sort-merge join partitions; the session zone is pinned
# so TIMESTAMP columns map to epoch seconds identically everywhere.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove reliable-checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "txrisk", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster master and a
    shuffle-partition count sized to the data (≈ input bytes / 128 MB)."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points to shared storage (HDFS/S3/ABFS) and is
    only read here. Only when it is unset (local tests) a private folder is
    created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    ctx_dir = spark.sparkContext.getCheckpointDir()
    base = conf_dir or ctx_dir
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (HDFS/S3/ABFS) "
                               "on a cluster")
        base = tempfile.mkdtemp(prefix="txrisk-ckpt-")  # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", base)
    if not ctx_dir:
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder (for staged tables, stream
    checkpoints and written intermediate results)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    segs = ["txrisk", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return base + "/" + "/".join(segs)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem API (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def path_size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return 0
    return int(fs.getContentSummary(hpath).getLength())


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(hpath) if s.isDirectory())



def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create one small file through the Hadoop FileSystem API (any scheme);
    used for commit markers, not for data."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``txrisk`` importable in Python workers (pandas UDF bodies refer to
    its functions), whatever the driver's working directory: zip the package
    once per application, stage it in the shared folder and register it with
    ``addPyFile`` (the programmatic ``--py-files``)."""
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = shared_path(spark, "pyfiles", app, "txrisk.zip")
    write_bytes(spark, target, buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(app)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def short_methods(spark: SparkSession):
    """Within it, a stage whose generated method is longer than HotSpot compiles (8,000 bytes of
    bytecode) runs by operator, in methods that are compiled, instead of being interpreted."""
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def freed_shuffles(spark: SparkSession):
    """The shuffle files of DataFrames made within it are deleted when a job on them ends, not when
    the driver happens to collect garbage. Such a DataFrame is meant to run once: again, it shuffles again."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def scratch_checkpoints(spark: SparkSession):
    """Checkpoints taken within it lie in a folder of their own, which is deleted at its end:
    nothing that reads them may outlive it. The folder is one for the whole application."""
    sc = spark.sparkContext
    root = shared_path(spark, "scratch", unique=True)
    before = sc.getCheckpointDir().rsplit("/", 1)[0]  # Spark adds a folder of its own
    sc.setCheckpointDir(root)
    try:
        yield
    finally:
        sc.setCheckpointDir(before)
        delete_path(spark, root)


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (never ``localCheckpoint``): survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
