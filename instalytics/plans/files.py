"""Small files on the shared file system, through Spark's own Hadoop client
(any scheme the session can read; nothing here touches the data)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and modification time of every file at or below ``path``."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    if not fs.getFileStatus(p).isDirectory():
        s = fs.getFileStatus(p)
        return [(path, s.getLen(), s.getModificationTime())]
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str):
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_json(spark: SparkSession, path: str, value) -> bool:
    """Write a new file whole: under another name, then renamed. False (and
    nothing changed) if the name is taken. Needs a file system that renames
    atomically and not onto an existing file."""
    fs, p = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_part-{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        stream.close()
    if not fs.exists(p) and fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False
