"""Paths, through the file system the path belongs to (local, HDFS, object store)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def expand(spark: SparkSession, patterns: str | Sequence[str]) -> list[str]:
    """Files matching any of the patterns, each once, sorted."""
    found: set[str] = set()
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        fs, jpath = _fs(spark, pattern)
        found.update(str(s.getPath().toString()) for s in fs.globStatus(jpath) or [])
    return sorted(found)


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these paths exists: {list(paths)}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it is missing."""
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a text file, compressed ones by their ending; no more of it is read. None if it is empty."""
    fs, jpath = _fs(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(jpath)
    stream = fs.open(jpath)
    try:
        text = codec.createInputStream(stream) if codec is not None else stream
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(text, encoding)).readLine()
    finally:
        stream.close()
