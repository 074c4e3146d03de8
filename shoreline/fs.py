"""Small file-system helpers over Hadoop's FileSystem (works for local, HDFS
and object stores the cluster is configured for)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file with ``text`` at ``path``; False if one is there already (lost
    race). The text is written beside it first and then moved without
    overwriting, so nobody sees a part of it: by a hard link on a local file
    system (whose rename replaces), by rename elsewhere (atomic on HDFS). Any
    other failure raises."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.io.File
            jvm.java.nio.file.Files.createLink(local(p.toUri().getPath()).toPath(), local(temp.toUri().getPath()).toPath())
        else:
            modes = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            modes[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(temp), fs.makeQualified(p), modes)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        fs.delete(temp, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` lies on a local (or mounted) file system."""
    fs, _ = _fs(spark, path)
    return fs.getUri().getScheme() == "file"


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds of a file's last change."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)
