"""File operations through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if the folder is missing."""
    fs, p = _resolve(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def move(spark: SparkSession, source: str, dest: str) -> None:
    """Rename a folder or file, making the parent of the new place first."""
    fs, src = _resolve(spark, source)
    _, dst = _resolve(spark, dest)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {dest}")


def make(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: it appears under its name once it is complete."""
    fs, p = _resolve(spark, path)
    _, part = _resolve(spark, f"{path.rsplit('/', 1)[0]}/_{path.rsplit('/', 1)[1]}.{uuid.uuid4().hex[:8]}")
    fs.mkdirs(p.getParent())
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is missing."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    into = fs.open(p)
    try:
        return bytes(into.readAllBytes()).decode()
    finally:
        into.close()
