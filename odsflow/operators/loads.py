"""Load strategies into catalog tables: slice, increment, full replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from odsflow.functions.cleaning import stamp
from odsflow.sources import partitions, paths


def load_slice(
    df: DataFrame, table: str, day: str, part: str = "data_dt", stamp_col: str | None = "etl_dt"
) -> str:
    """The whole source as partition ``part = day``; other days stay."""
    rows = stamp(df, day, stamp_col) if stamp_col else df
    return partitions.swap_partition(df.sparkSession, table, rows, ((part, day),))


def load_increment(df: DataFrame, table: str, day: str, part: str = "etl_dt") -> str:
    """One day's rows as partition ``part = day``; also fills a chain's staging."""
    return partitions.swap_partition(df.sparkSession, table, df, ((part, day),))


def load_increments(df: DataFrame, table: str, part: str = "etl_dt") -> list[str]:
    """Many days at once; ``df`` carries each row's day in column ``part``."""
    return partitions.swap_partitions(df.sparkSession, table, df, part)


def load_replace(df: DataFrame, table: str, day: str | None = None, stamp_col: str = "etl_dt") -> str:
    """Delete all, insert all, as one switch of the table to the new rows."""
    rows = stamp(df, day, stamp_col) if day else df
    return partitions.swap_table(df.sparkSession, table, rows)


_DONE = "_DONE"


def _archived(spark: SparkSession, path: str) -> list[str]:
    return [n for n in paths.child_dirs(spark, path) if paths.exists(spark, f"{path}/{n}/{_DONE}")]


def archive(df: DataFrame, path: str) -> str:
    """Keep a copy of a raw load; returns its folder.

    Each copy is a new folder under ``path``, numbered after those that are there,
    and counts once it is complete, so a load that fails leaves the last one whole.
    """
    spark = df.sparkSession
    numbers = [int(n.split("-")[0]) for n in paths.child_dirs(spark, path)]
    folder = f"{path}/{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    paths.touch(spark, f"{folder}/{_DONE}")
    return folder


def newest_archive(spark: SparkSession, path: str) -> str:
    """The folder of the last complete copy."""
    found = _archived(spark, path)
    if not found:
        raise FileNotFoundError(f"no archived load at {path}")
    return f"{path}/{found[-1]}"


def discard_archives(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the last ``keep`` complete copies, and incomplete ones before them."""
    kept = _archived(spark, path)[-keep:] if keep else []
    gone = [n for n in paths.child_dirs(spark, path) if not kept or n < kept[0]]
    for name in gone:
        paths.delete(spark, f"{path}/{name}")
    return gone


def reload_partition(spark: SparkSession, path: str, table: str, day: str, part: str = "data_dt") -> str:
    """Rebuild a partition from the last archived copy, without the source."""
    rows = spark.read.parquet(newest_archive(spark, path))
    return partitions.swap_partition(spark, table, rows, ((part, day),))
