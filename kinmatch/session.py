"""Session helper and the lineage cut shared by the iterative operators."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_SCOPES: list[list[str]] = []


def build_session(app: str = "kinmatch", cpus: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, it is a folder
    of this application under the warehouse, which all executors reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = f"{warehouse}/kinmatch_scratch/{spark.sparkContext.applicationId}"
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, noted in the innermost open scope."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`scratch_path` handed out inside, once the block is left.

    For jobs whose result is written before the block ends. Checkpoints are Spark's
    own to remove (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps iterated plans short."""
    root = scratch_root(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


# Shuffle output that one task of an eager step reads, and the parts that a shuffle is cut into before they are merged to that.
TASK_BYTES = 8 << 20
SHUFFLE_PARTS = 1024


@contextlib.contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks of bounded input for what runs inside: more tasks for more rows, not larger ones.

    ``spark.sql.shuffle.partitions`` alone bounds the number of tasks, so that each grows with
    the input. Only for steps that run before the block is left; what is planned later has the session's own settings.
    """
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": max(own, SHUFFLE_PARTS),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * TASK_BYTES,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def use_all_cores(df: DataFrame) -> DataFrame:
    """Spread a small input before costly row work; large inputs pass unchanged.

    A file with one row group is one task however long its texts are. Inputs that
    already have a partition per core are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
