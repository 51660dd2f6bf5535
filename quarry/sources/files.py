"""Small file-system helpers over Hadoop's FileSystem API.

These work on any Hadoop-compatible store the cluster is configured for
(HDFS, object stores, local files in tests). They touch metadata and small
files only: list a directory, move a file the engine made, delete a directory.
"""

from __future__ import annotations

import os
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; True if something was deleted."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path`` (not recursive)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (one metadata call, no data read)."""
    fs, p = _fs_and_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (SQL scripts, metadata lists)."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


#: Config files (SQL text, column metadata) may have this many bytes.
SMALL_TEXT = 16 << 20


def read_small_text(spark: SparkSession, uri: str) -> str:
    """The text of exactly one file of at most ``SMALL_TEXT`` bytes; checked before it is read."""
    fs, p = _fs_and_path(spark, uri)
    found = [st for st in (fs.globStatus(p) or []) if st.isFile()]
    if len(found) != 1:
        raise ValueError(f"{uri} must name exactly one file, it matches {len(found)}")
    if found[0].getLen() > SMALL_TEXT:
        raise ValueError(f"{uri} has {found[0].getLen()} bytes, more than the {SMALL_TEXT} of a config file")
    return spark.read.text(found[0].getPath().toString(), wholetext=True).first()[0]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system spells it: scheme, authority, no doubled slashes."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def same_path(spark: SparkSession, a: str, b: str) -> bool:
    return qualified(spark, a) == qualified(spark, b)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file or directory; False if it is not there or the target is."""
    fs, p = _fs_and_path(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    return bool(fs.exists(p)) and not fs.exists(to) and bool(fs.rename(p, to))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths below ``path``, relative to it, of the files that readers see."""
    fs, p = _fs_and_path(spark, path)
    root, found, listed = fs.makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()[len(root) + 1:]
        if not any(part.startswith((".", "_")) and "=" not in part for part in name.split("/")):
            found.append(name)
    return sorted(found)


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a small file; False if it is there already. Of many that try at once
    one succeeds."""
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":  # Hadoop's local create looks first and then makes it
        try:
            handle = os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as f:
            f.write(text)
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_if_there(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, p = _fs_and_path(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError:
        if fs.exists(p):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified_ms(spark: SparkSession, path: str) -> int | None:
    fs, p = _fs_and_path(spark, path)
    try:
        return int(fs.getFileStatus(p).getModificationTime())
    except Py4JJavaError:
        return None


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.setTimes(p, int(time.time() * 1000), -1)
