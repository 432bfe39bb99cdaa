"""Broadcast only what has been measured; deal large inputs out by rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from odsflow.settings import broadcast_limit, fresh_dir
from odsflow.sources import paths

_ROW_OVERHEAD = 32
_FIXED_WIDTH = 16

#: Rows of a large input that one task sorts and hashes.
PART_ROWS = 400_000


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long")
    return F.lit(_FIXED_WIDTH).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size of ``df``; one distributed sum, one row back, one run of ``df``."""
    total = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(_ROW_OVERHEAD))
    return df.agg(F.sum(total)).first()[0] or 0


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """True when ``df`` fits the session's broadcast threshold (or ``limit``)."""
    bound = broadcast_limit(df.sparkSession) if limit is None else limit
    return bound > 0 and measured_bytes(df) <= bound


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that several branches of a plan use: it is computed one time,
    outlives lost executors and costs next to nothing to measure.
    """
    spark = df.sparkSession
    folder = fresh_dir(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def task_parts(spark: SparkSession, rows: int) -> int | None:
    """Partitions that leave ``PART_ROWS`` rows to a task; None where a task of every core holds no more anyway.

    Adaptive execution merges partitions by their compressed bytes and down to the
    number of cores, so its tasks grow with the input; partitions of a given number stay.
    """
    least = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return -(-rows // PART_ROWS) if rows > PART_ROWS * least else None


def place(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` in ``parts`` partitions by ``keys``, or as it is without a number."""
    return df.repartition(parts, *keys) if parts else df


@contextmanager
def settled(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``settle`` for work that ends within a block; the folder goes with it."""
    spark = df.sparkSession
    folder = fresh_dir(spark, name)
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        paths.delete(spark, folder)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast after measuring ``df``; beyond the bound Spark shuffles."""
    return F.broadcast(df) if is_small(df, limit) else df
