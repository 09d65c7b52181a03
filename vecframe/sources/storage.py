"""Small driver-side steps on a file system, by Hadoop's own client, so that every scheme Spark reads works: list, read and write a marker, remove."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none if it is missing."""
    system, at = _opened(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _opened(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; one that is missing is no error."""
    system, at = _opened(spark, path)
    system.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and move it, so that it is there whole or not at all; an existing file is an error."""
    system, at = _opened(spark, path)
    folder = at.getParent()
    system.mkdirs(folder)
    aside = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{at.getName()}-{uuid.uuid4().hex}")
    out = system.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(aside, at):
        system.delete(aside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    system, at = _opened(spark, path)
    source = system.open(at)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file, unless it was moved before; a target that is there is an error."""
    system, at = _opened(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not system.exists(at) and system.exists(to):
        return
    if not system.rename(at, to):
        raise FileExistsError(target)
