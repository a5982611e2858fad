"""File-system helpers over the session's Hadoop client.

Engine state sits next to the data on whatever file system the cluster uses
(HDFS, an object store, a local disk in tests), so every call goes through
``org.apache.hadoop.fs.FileSystem`` rather than Python's ``os`` module.  These
are metadata operations on a handful of small files; no data passes here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualify(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    return str(fs.makeQualified(p).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _resolve(spark, path)
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _resolve(spark, src)
    return bool(fs.rename(p, _resolve(spark, dst)[1]))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write a small text file.  With ``overwrite=False`` the file appears
    whole or not at all: it is written beside its place and renamed there, and
    ``False`` is returned when the place is taken.  The rename must be atomic
    and refuse an existing target, as HDFS's is."""
    fs, p = _resolve(spark, path)
    target = p if overwrite else spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        p.getParent(), f".{p.getName()}.{uuid.uuid4().hex[:12]}")
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if overwrite:
        return True
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(target), fs.makeQualified(p), plain)
        return True
    except Exception as exc:
        fs.delete(target, False)
        if "AlreadyExists" in str(exc):
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty when it is missing)."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def set_times(spark: SparkSession, path: str, epoch_ms: int) -> None:
    """Set a file's modification time, as a copy that preserves times does."""
    fs, p = _resolve(spark, path)
    fs.setTimes(p, epoch_ms, -1)


def file_status(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """``(length, modification_time_ms)`` of one file, or ``None``."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    st = fs.getFileStatus(p)
    return int(st.getLen()), int(st.getModificationTime())
