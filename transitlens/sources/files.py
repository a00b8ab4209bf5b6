"""Small file operations on whatever file system Spark's paths name.

For manifests and clean-up only: lists, short texts, renames and deletions go
through Hadoop's file system interface, as Spark's own readers and writers do;
data is never moved through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when files of a path (a file or folder) are replaced, added or removed."""
    p, fs = _path(spark, path)
    found = fs.listFiles(p, True)
    parts = []
    while found.hasNext():
        s = found.next()
        parts.append(f"{s.getPath().toString()}:{s.getLen()}:{s.getModificationTime()}")
    return uuid.uuid5(uuid.NAMESPACE_URL, "\n".join(sorted(parts))).hex


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that appears whole (written beside and renamed); an existing one is an error."""
    folder, _, name = path.rpartition("/")
    beside, fs = _path(spark, f"{folder}/_{name}.{uuid.uuid4().hex}")
    target, _ = _path(spark, path)
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(beside, target):
        fs.delete(beside, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
