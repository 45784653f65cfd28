"""Folders of a store that Spark can reach, whatever file system holds them."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DONE = "_SUCCESS"
MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def _place(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` whose write has ended.

    That is told by the marker Spark leaves; without markers no folder could be trusted.
    """
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    if not spark.sparkContext._jsc.hadoopConfiguration().getBoolean(MARKS, True):
        raise RuntimeError(f"{MARKS} is off: complete folders cannot be told from broken ones")
    jvm = spark.sparkContext._jvm
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return sorted(n for n in names if files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/{DONE}")))


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def file_names(spark: SparkSession, path: str, suffix: str) -> list[str]:
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    names = (s.getPath().getName() for s in files.listStatus(place) if s.isFile())
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith("."))


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole under a name; False when the name is taken."""
    place, files = _place(spark, path)
    if files.exists(place):
        return False
    part, _ = _place(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.rename(part, place):
        return True
    files.delete(part, False)
    return False
