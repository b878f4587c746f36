"""Small files and renames on any file system that Spark can write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Moves a file or folder in one step; a file in its place is replaced, a folder is not."""
    jvm = spark.sparkContext._jvm
    fs, a = _at(spark, old)
    a, b = fs.makeQualified(a), fs.makeQualified(_at(spark, new)[1])
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(a, b, how)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and moves it there: readers see the old text or the new one."""
    new = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}-{uuid.uuid4().hex}"
    fs, at = _at(spark, new)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename(spark, new, path)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def copy(spark: SparkSession, old: str, new: str) -> None:
    """Copies one file, or a folder with all in it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, at = _at(spark, old)
    b, to = _at(spark, new)
    b.mkdirs(to.getParent())
    jvm.org.apache.hadoop.fs.FileUtil.copy(a, at, b, to, False, conf)
