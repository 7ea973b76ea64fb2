"""Small files of a table's folder, through the file system that Spark uses for it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str) -> tuple:
    """A path and its file system."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held, held.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    held, files = folder(spark, path)
    files.delete(held, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing where there is none."""
    held, files = folder(spark, path)
    if not files.exists(held):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(held))


def subfolders(spark: SparkSession, path: str) -> set[str]:
    held, files = folder(spark, path)
    return {s.getPath().getName() for s in files.listStatus(held) if s.isDirectory()}


def read_text(spark: SparkSession, path: str) -> str:
    held, files = folder(spark, path)
    stream = files.open(held)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file as a whole, unless there is one of its name; tells whether it was written.

    The text is written aside and then renamed, which neither replaces a file nor shows
    a part of one on file systems with atomic renames.
    """
    held, files = folder(spark, path)
    if files.exists(held):
        return False
    aside = spark._jvm.org.apache.hadoop.fs.Path(held.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    conf = spark._jsc.hadoopConfiguration()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(held).toUri(), conf
    )
    gateway = spark.sparkContext._gateway
    plain = gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(held), plain)
    except (PySparkException, Py4JError):
        files.delete(aside, False)
        if files.exists(held):
            return False
        raise
    return True
