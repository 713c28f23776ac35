"""Session settings the operators rely on, and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results: instants are UTC, parse failures are NULL via
# try_* functions, and the datetime parser is the java.time one.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}
# Settings for throughput: adaptive execution re-plans joins and shuffle sizes.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # rows go to a few partition folders at once, without a sort (more folders: sorted as before)
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Pin the result-relevant settings on an existing session."""
    for k, v in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vitals") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A session that names none gets a private folder if its master is local (tests,
    bench), and an error on a cluster, whose executors would not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="vitals-ckpt-")
        _delete_at_end(spark, named)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Make ``path`` and have it deleted when the driver's JVM ends."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for intermediate tables.

    All of them lie in one folder of the application, which goes when the driver ends.
    """
    base = checkpoint_dir(spark).rstrip("/")
    if base not in _SCRATCH:
        _SCRATCH[base] = f"{base}/vitals-scratch-{uuid.uuid4().hex[:12]}"
        _delete_at_end(spark, _SCRATCH[base])
    return f"{_SCRATCH[base]}/{name}-{uuid.uuid4().hex[:12]}"
