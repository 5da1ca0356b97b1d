"""File operations of the sinks, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def child(parent: str, name: str) -> str:
    return f"{parent.rstrip('/')}/{name}"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename where nothing stands yet at ``target``; its parent is made."""
    fs, p = _path(spark, source)
    _, q = _path(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority."""
    fs, p = _path(spark, path)
    return str(fs.makeQualified(p))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a path or glob names; none where nothing is there."""
    fs, p = _path(spark, pattern)
    return [str(s.getPath()) for s in (fs.globStatus(p) or [])]


def listed(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _path(spark, folder)
    return [str(s.getPath()) for s in fs.listStatus(p)]


def copy_over(spark: SparkSession, source: str, target: str) -> None:
    """The content of the file ``source`` as the file ``target``, replacing one."""
    jvm = spark.sparkContext._jvm
    fs, p = _path(spark, source)
    to, q = _path(spark, target)
    done = jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, False, True, spark.sparkContext._jsc.hadoopConfiguration())
    if not done:
        raise OSError(f"cannot copy {source} to {target}")
