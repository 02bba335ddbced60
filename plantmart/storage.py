"""Small metadata operations on the session's Hadoop file system.

Only names, sizes and records of a few kilobytes pass through here; table data never does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Stores without an atomic rename; there one complete put is the atomic step.
_OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cosn"}


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible children of a folder; empty if there is no such folder."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(name for name in names if not name.startswith(("_", ".")))


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    fs, target = _resolve(spark, path)
    return fs.getFileStatus(target).getModificationTime()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings spell it."""
    fs, target = _resolve(spark, path)
    return fs.makeQualified(target).toString()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, target = _resolve(spark, path)
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a complete record appear under a name that must not exist yet."""
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        raise FileExistsError(f"{path} was already published")
    if fs.getScheme() in _OBJECT_STORES:
        write_text(spark, path, text, overwrite=False)
        return
    staged = f"{path}.{uuid.uuid4().hex}.staged"
    write_text(spark, staged, text)
    if not fs.rename(_resolve(spark, staged)[1], target):
        raise FileExistsError(f"{path} could not be published")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
