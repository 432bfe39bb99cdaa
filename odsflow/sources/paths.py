"""Folder names on the store that holds the tables.

Only names pass through the driver: partition and run folders, whose number is
that of loaded days, never the files or rows inside.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def _children(spark: SparkSession, path: str, folders: bool) -> list[str]:
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() == folders]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, hidden ones left out."""
    return _children(spark, path, True)


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, hidden ones left out."""
    return _children(spark, path, False)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    fs, target = _handle(spark, path)
    fs.create(target, True).close()


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a file or folder on one store, making the folder above ``target``."""
    fs, source = _handle(spark, path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(place.getParent())
    if not fs.rename(source, place):
        raise OSError(f"cannot move {path} to {target}")
