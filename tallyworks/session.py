"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: The most bytes that go to a Python worker in one Arrow batch. Spark's own limit counts rows only.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_root: str | None = None


def build_session(master: str | None = "local[*]", app: str = "tallyworks", **settings: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Adaptive execution sizes the shuffles and splits skewed join partitions.
    Pass no master to use the one that the program was submitted with, and the
    shuffle partition count that fits the cluster.
    """
    builder = SparkSession.builder if master is None else SparkSession.builder.master(master)
    builder = (
        builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names, also made known for checkpoints.

    Only a local session may go without the setting; a cluster needs a folder
    that every executor can reach.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tallyworks-")
        root = _local_root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_folder(spark: SparkSession, label: str) -> str:
    """The name of a fresh folder below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, place: str):
    """A path and its file system, which need not be a local one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, place: str) -> str:
    """A path with the scheme of the file system that Spark takes it for, for programs that would take it for a local one."""
    path, system = _located(spark, place)
    return system.makeQualified(path).toString()


def remove_folder(spark: SparkSession, place: str) -> None:
    """Remove a folder or file; one that is gone already is no error."""
    path, system = _located(spark, place)
    system.delete(path, True)


def set_file_times(spark: SparkSession, folder: str, seconds: int) -> None:
    """Give the files right inside a folder a modification time, in seconds since 1970."""
    path, system = _located(spark, folder)
    for status in system.listStatus(path):
        if status.isFile():
            system.setTimes(status.getPath(), seconds * 1000, -1)


def write_note(spark: SparkSession, place: str, text: str) -> None:
    """Write a small file of text, in the place of one that is there."""
    path, system = _located(spark, place)
    stream = system.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_note(spark: SparkSession, place: str) -> str | None:
    """The text of a small file; None if there is no such file."""
    path, system = _located(spark, place)
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """From now on rows go to Python workers in Arrow batches of about so many bytes, unless the session names a limit.

    Otherwise the JVM and the worker hold ten thousand texts at once, whatever their length.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(size))


def computed(df: DataFrame) -> DataFrame:
    """The rows of a DataFrame, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
