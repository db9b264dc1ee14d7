"""Small file operations on whatever file system a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_new_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Create a file, whole or not at all: it is written aside and renamed. Fails
    if it is there already (the commit point of a table); one writer is assumed,
    as some file systems overwrite in a race."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.rename(aside, p):
        fs.delete(aside, False)
        raise FileExistsError(path)


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    write_new_bytes(spark, path, text.encode("utf-8"))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _fs(spark, old)
    _, target = _fs(spark, new)
    if not fs.rename(source, target):
        raise IOError(f"could not rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all that is in it."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
