"""Files on any Hadoop file system: listing as a DataFrame, moving, deleting.

Only names and sizes are handled here, never contents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, pattern: str) -> bool:
    """Does anything match the path or glob?"""
    target, fs = _hadoop(spark, pattern)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    target, fs = _hadoop(spark, path)
    return fs.getContentSummary(target).getLength()


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, name and size of the files that match. Contents are not read: only the
    listing columns of the binary source are selected."""
    if not exists(spark, pattern):
        return spark.createDataFrame([], "path string, name string, size bigint")
    listing = spark.read.format("binaryFile").load(pattern)
    return listing.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below `path`."""
    target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`; none if it is absent."""
    target, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target, fs = _hadoop(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; what follows is not read, but for one buffer."""
    target, fs = _hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(target)
    stream = fs.open(target)
    try:
        text = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that is there whole or not at all; False if there is one already."""
    target, fs = _hadoop(spark, path)
    if fs.exists(target):
        return False
    parent, name = path.rsplit("/", 1)
    staged, _ = _hadoop(spark, f"{parent}/_{uuid.uuid4().hex}-{name}")
    fs.mkdirs(staged.getParent())
    stream = fs.create(staged, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.exists(target) and fs.rename(staged, target):
        return True
    fs.delete(staged, False)
    return False


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        target, fs = _hadoop(spark, path)
        fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished file or folder in place of `target`. What stood there goes only once
    the new one stands; if that fails it is put back."""
    from_path, fs = _hadoop(spark, source)
    to_path, _ = _hadoop(spark, target)
    parent, name = target.rstrip("/").rsplit("/", 1)
    # hidden from readers
    old_path, _ = _hadoop(spark, f"{parent}/_old-{uuid.uuid4().hex}-{name}")
    fs.mkdirs(to_path.getParent())
    held = fs.exists(to_path)
    if held and not fs.rename(to_path, old_path):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(from_path, to_path):
        if held:
            fs.rename(old_path, to_path)
        raise OSError(f"could not rename {source} to {target}")
    if held:
        fs.delete(old_path, True)


def move_into(spark: SparkSession, paths: Iterable[str], folder: str) -> None:
    target, fs = _hadoop(spark, folder)
    fs.mkdirs(target)
    for path in paths:
        rename(spark, path, f"{folder}/{path.rsplit('/', 1)[1]}")
