"""Small file-system steps of a table's driver: list, test, remove, write one small file.

They go through Hadoop's FileSystem, so any store that Spark reads will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; false if it is there already."""
    p, fs = _at(spark, path)
    if fs.exists(p):
        return False
    part, _ = _at(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.part")  # names from _ on are hidden from readers
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
