"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "patronage", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; cluster sizing stays outside."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for staged tables and model checkpoints, named in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/patronage-{context.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For inputs that several passes read: each pass then scans a few Parquet columns
    instead of repeating the work, all passes see the same rows, and a lost executor
    costs a re-read.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Paths staged inside the blocks of ``staging`` that are open.
_OPEN: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted when it ends. What is built from them
    must be written before."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove(spark, path)


def _file_system(spark: SparkSession, path: str):
    java = spark._jvm.org.apache.hadoop.fs.Path(path)
    return java.getFileSystem(spark._jsc.hadoopConfiguration()), java


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any store that Spark writes to."""
    files, java = _file_system(spark, path)
    files.delete(java, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, java = _file_system(spark, path)
    return files.exists(java)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a short text at a path in one step: readers see the old one or the new one."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jvm.java.net.URI(path) if "://" in path else spark._jvm.java.net.URI(f"file://{path}"),
        spark._jsc.hadoopConfiguration(),
    )
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    files, _ = _file_system(spark, path)
    stream = files.create(written)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(written, target, options)
