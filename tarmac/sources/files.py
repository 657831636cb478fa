"""Small metadata helpers on the session's file system (driver side, no data)."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a pattern, in name order."""
    fs, jpath = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(jpath) or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, jpath = _fs(spark, old)
    if not fs.rename(jpath, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old} to {new}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def first_line(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, path)
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(
        jvm.java.io.InputStreamReader(fs.open(jpath), jvm.java.nio.charset.StandardCharsets.UTF_8)
    )
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def first_lines(spark: SparkSession, paths: Iterable[str], threads: int = 16) -> dict[str, str]:
    """First line of each file, empty for one that cannot be read; the files are opened side by side."""

    def line(path: str) -> str:
        try:
            return first_line(spark, path)
        except Py4JJavaError:
            return ""

    paths = list(paths)
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(paths, pool.map(line, paths)))
