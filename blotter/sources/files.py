"""Listing, reading, putting and removing files through Hadoop's file systems (any store Spark reads)."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if it does not exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def state(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the names, sizes and times of the files at ``paths`` (a file, or a
    folder of files); it changes when any of them is rewritten."""
    h = hashlib.sha256()
    for path in paths:
        fs, p = _at(spark, path)
        for s in sorted(fs.listStatus(p), key=lambda s: s.getPath().getName()) if fs.exists(p) else []:
            h.update(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}\n".encode())
    return h.hexdigest()


def size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files and folders at ``paths``."""
    found = [_at(spark, path) for path in paths]
    return sum(fs.getContentSummary(p).getLength() for fs, p in found if fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a small file in place as a whole; False if there is a file already."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(p), options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)
