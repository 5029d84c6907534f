"""Small file operations on the file system of a path, through Hadoop's API (any store that Spark reads)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    p, fs = _path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one: a new file is renamed over it."""
    p, fs = _path(spark, path)
    new, _ = _path(spark, f"{path}.{uuid.uuid4().hex[:8]}.new")
    fs.mkdirs(p.getParent())
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(p), options)


def first_line(spark: SparkSession, path: str) -> bytes:
    """The first line of a (perhaps compressed) file; nothing else of it is read."""
    p, fs = _path(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        source = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "ISO-8859-1")).readLine()
    finally:
        stream.close()
    return (line or "").encode("latin-1")  # byte for byte
