"""Small file-system steps on the driver: a path or a short text each, never data."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    system, at = _at(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    system, at = _at(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isFile())


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _at(spark, path)
    system.mkdirs(at)


def delete(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return bool(system.delete(at, True))


def read_text(spark: SparkSession, path: str) -> str:
    system, at = _at(spark, path)
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a new file, complete from the moment it can be seen; False if there is one already."""
    system, at = _at(spark, path)
    _, aside = _at(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    try:
        if system.getUri().getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Paths.get(system.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(local(at), local(aside))
        else:
            option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(option, 1)
            options[0] = option.NONE
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(aside, at, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(aside, False)
    return True
