"""Small files and folders on whatever file system Spark reads, through Spark's own Hadoop configuration."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def _failed_with(error: Py4JJavaError, *classes: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in classes


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no such folder."""
    files, name = _opened(spark, folder)
    try:
        return sorted(status.getPath().getName() for status in files.listStatus(name))
    except Py4JJavaError as error:
        if _failed_with(error, "FileNotFoundException"):
            return []
        raise


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    files, name = _opened(spark, path)
    return time.time() - files.getFileStatus(name).getModificationTime() / 1000


def exists(spark: SparkSession, path: str) -> bool:
    files, name = _opened(spark, path)
    return files.exists(name)


def read_text(spark: SparkSession, path: str) -> str:
    files, name = _opened(spark, path)
    stream = files.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole or not at all; False, and nothing is changed, if there is one already.

    The file is written under another name and renamed, which file systems with atomic renames do for one of several
    writers only. On object stores without them there must be one writer at a time.
    """
    jvm = spark._jvm
    folder, _, own = path.rpartition("/")
    files, staged = _opened(spark, f"{folder}/.{own}-{uuid.uuid4().hex}")
    stream = files.create(staged, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), files.getConf())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    # Both names in full, as a file context knows no working folder of the file system's.
    target = files.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    try:
        context.rename(files.makeQualified(staged), target, options)
    except Py4JJavaError as error:
        files.delete(staged, False)
        if _failed_with(error, "FileAlreadyExistsException"):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    files, name = _opened(spark, path)
    files.delete(name, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another, which is gone for the moment between two renames.

    A call that is cut short leaves the old folder beside it as ``<path>.replaced``; the next one clears that away.
    """
    files, name = _opened(spark, path)
    _, new = _opened(spark, staged)
    _, old = _opened(spark, f"{path}.replaced")
    if files.exists(name):
        files.delete(old, True)
        files.rename(name, old)
    if not files.rename(new, name):
        raise OSError(f"{staged} can't be renamed to {path}")
    files.delete(old, True)
