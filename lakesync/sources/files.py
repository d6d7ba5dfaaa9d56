"""Directory metadata through Hadoop's FileSystem (works for file:, hdfs:,
s3a: ... alike). Only directory-level calls run on the driver; file-level
listings are Spark jobs (see ``operators.maintenance``)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def child_dirs(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """``(name, full path, modification time ms)`` of the sub-directories."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isDirectory():
            out.append((st.getPath().getName(), st.getPath().toString(), int(st.getModificationTime())))
    return out


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()] if fs.exists(p) else []


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``; ``False`` if it exists already."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
