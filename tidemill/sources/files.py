"""Small files through Hadoop's file systems, so that any store that Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or null if there is none."""
    if not exists(spark, path):
        return None
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move(spark: SparkSession, source: str, path: str) -> None:
    """Move a file over ``path`` in one step."""
    p, fs = _path(spark, source)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), overwrite)


def copy(spark: SparkSession, source: str, path: str) -> None:
    """Copy a file to a temporary name, then move it over ``path`` in one step."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    (a, fs), (b, other) = _path(spark, source), _path(spark, temporary)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, other, b, False, spark._jsc.hadoopConfiguration())
    move(spark, temporary, path)


def write_text(spark: SparkSession, path: str, chunks) -> None:
    """Write a text, or chunks of text or bytes, to a temporary name, then move it over ``path`` in one step."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    p, fs = _path(spark, temporary)
    stream = fs.create(p, True)
    try:
        for chunk in [chunks] if isinstance(chunks, str) else chunks:
            stream.write(bytearray(chunk.encode() if isinstance(chunk, str) else chunk))
    finally:
        stream.close()
    move(spark, temporary, path)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def by_age(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, the oldest first."""
    p, fs = _path(spark, path)
    return [n for _, n in sorted((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(p))] if fs.exists(p) else []


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()
