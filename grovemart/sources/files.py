"""Files as they are: copied, moved or removed without being parsed, on any Hadoop file system."""

from __future__ import annotations

import os
import re
import uuid
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import urlparse

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def literal(path: str) -> str:
    """The path with glob characters escaped, for readers that expand them."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _located(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, where = _located(spark, target)
    system.mkdirs(where.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), where):
        raise OSError(f"cannot move {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder over another on the same file system."""
    remove(spark, target)
    move(spark, source, target)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.getFileStatus(where).isDirectory()


def length(spark: SparkSession, path: str) -> int:
    system, where = _located(spark, path)
    return system.getFileStatus(where).getLen()


def last_byte(spark: SparkSession, path: str) -> int | None:
    """The last byte of a file; None if it is empty."""
    system, where = _located(spark, path)
    size = system.getFileStatus(where).getLen()
    if not size:
        return None
    stream = system.open(where)
    try:
        stream.seek(size - 1)
        return stream.read()
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file, uncompressed if its suffix names a codec; None if the file is empty."""
    system, where = _located(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(system.getConf()).getCodec(where)
    stream = system.open(where)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        reader = spark._jvm.java.io.InputStreamReader(stream, encoding)
        return spark._jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()


class Entry(NamedTuple):
    """What a folder holds."""

    path: str
    name: str
    is_folder: bool
    millis: int
    length: int


def entries(spark: SparkSession, path: str, hidden: bool = False) -> list[Entry]:
    """What is in a folder, by name, or the `hidden` part of it, whose names Spark's listings skip; nothing if it
    is not there."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    found = []
    for status in system.listStatus(where):
        at = status.getPath()
        if at.getName().startswith(("_", ".")) == hidden:
            found.append(
                Entry(at.toString(), at.getName(), status.isDirectory(), status.getModificationTime(), status.getLen())
            )
    return sorted(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it is not there."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    return [status.getPath().getName() for status in system.listStatus(where)]


def same_system(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths lie on one file system, so that a rename moves from one to the other."""
    (a, _), (b, _) = _located(spark, one), _located(spark, other)
    return a.getUri().equals(b.getUri())


def create_new(spark: SparkSession, path: str, line: str) -> bool:
    """Create a file of one line unless it is there already; False if it is.

    The file appears whole or not at all, and of several writers one succeeds: a file of another name is
    renamed (or linked, on a local disk, where a rename would replace) to this one. That holds for
    file systems whose rename does not replace, such as HDFS; object stores need a connector that has
    such a rename.
    """
    system, where = _located(spark, path)
    if system.exists(where):
        return False
    system.mkdirs(where.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_incoming-{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(line.encode())
    finally:
        stream.close()
    try:
        if urlparse(system.getUri().toString()).scheme != "file":
            return system.rename(hidden, where)
        os.link(hidden.toUri().getPath(), system.makeQualified(where).toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        system.delete(hidden, False)


def timestamp(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it is not there."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())
