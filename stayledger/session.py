"""Session helpers: a local session for tests and the bench, the shared folder, and size estimates."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

PARTITION_BYTES = 8 * 1024 * 1024  # file bytes per shuffle partition; rows take 15 to 20 times that in memory
SPLIT_BYTES = 32 * 1024 * 1024  # file bytes of a task that sorts whole rows before it writes them
SENT_BYTES = 32 * 1024 * 1024  # file bytes of a table that is still sent to every executor


def local_session(cpus: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the cluster's own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayledger")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder; on a cluster a missing setting is an
    error, because a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stayledger-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there, so later passes see the same partitions."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as columns to the shared folder and continue from there: smaller than a checkpoint, and its size is known."""
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def scan_bytes(df: DataFrame) -> int | None:
    """Bytes of the files behind a plain scan, from the optimizer's statistics (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    except Exception:  # e.g. a remote session without JVM access
        return None


def shuffle_width(df: DataFrame) -> int | None:
    """Partitions to ask for when re-partitioning a scan.

    ``None`` leaves the choice to the session's setting and adaptive coalescing. A number is returned only when
    the scan is so large that the session's setting would make partitions bigger than an executor should sort.
    """
    size = scan_bytes(df)
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size is None or size <= configured * PARTITION_BYTES:
        return None
    return -(-size // PARTITION_BYTES)


def sent_if_small(df: DataFrame) -> DataFrame:
    """A side of a join that is sent along if its files are at most ``SENT_BYTES``, so the many rows of the other side stay
    where they are. A larger one is left to Catalyst."""
    size = scan_bytes(df)
    return F.broadcast(df) if size is not None and size <= SENT_BYTES else df


@contextmanager
def splits_of(spark: SparkSession, size: int):
    """Scans planned and run inside are cut into splits of at most ``size`` file bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_sized_for(*scans: DataFrame):
    """Raise the session's shuffle partitions while working on scans too large for the current setting.

    Adaptive execution merges what turns out small, so only a number that is too low does harm.
    """
    spark = scans[0].sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = [width for width in map(shuffle_width, scans) if width is not None]
    if wanted:
        spark.conf.set(key, str(max(wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """The shuffle files of a query run inside go when it ends, rather than when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
