"""Folders as the cluster's file systems see them: names, sizes and small notes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from hitloom.session import fresh_folder


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and authority, so that two spellings compare equal."""
    path, system = _path(spark, folder)
    return system.makeQualified(path).toString().rstrip("/")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; none if the folder does not exist."""
    path, system = _path(spark, pattern)
    return [found.getPath().toString() for found in system.globStatus(path) or []]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below; 0 if the folder does not exist."""
    path, system = _path(spark, folder)
    return system.getContentSummary(path).getLength() if system.exists(path) else 0


def remove(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A path below the shared folder that is removed at the end, if anything took it."""
    folder = fresh_folder(spark, label)
    try:
        yield folder
    finally:
        remove(spark, folder)


def exists(spark: SparkSession, folder: str) -> bool:
    path, system = _path(spark, folder)
    return system.exists(path)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False if it is gone or the new name is taken."""
    path, system = _path(spark, source)
    return not exists(spark, target) and system.rename(path, _path(spark, target)[0])


def read_text(spark: SparkSession, file: str) -> str:
    path, system = _path(spark, file)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, file: str, text: str) -> None:
    """A small file under a name that nobody took before; readers never see a part of it.

    Raises FileExistsError when the name is taken.
    """
    if exists(spark, file):
        raise FileExistsError(file)
    folder, _, name = file.rpartition("/")
    draft, system = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    try:
        no_options = spark.sparkContext._gateway.new_array(rename, 0)
        context.rename(draft, _path(spark, file)[0], no_options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise FileExistsError(file) from error
        raise
