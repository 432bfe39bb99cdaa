"""Comparison of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def _single(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys beside the packed row; a repeated or null key fails instead of pairing up or not."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    packed = df.select(*keys, F.struct(*df.columns).alias("_row"), rank.alias("_rank"))
    repeated = F.raise_error(
        F.concat(F.lit(f"key repeated in {name} snapshot, or null: "), F.to_json(F.struct(*keys)))
    ).cast(df.schema)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return packed.select(
        *keys, F.when((F.col("_rank") == 1) & known, F.col("_row")).otherwise(repeated).alias(f"_{name}")
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: its outcome and both versions as ``old`` and ``new`` structs.

    Outcomes are ``inserted``, ``deleted``, ``changed`` and ``same``; rows are
    compared null-safe over every column.
    """
    both = _single(old, keys, "old").join(
        _single(new.select(*old.columns), keys, "new"), list(keys), "full_outer"
    )
    outcome = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same")
        .otherwise("changed")
    )
    return both.select(
        *keys, outcome.alias("outcome"), F.col("_old").alias("old"), F.col("_new").alias("new")
    )


def all_columns_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of both snapshots, matched on every column, nulls as values.

    ``n_old`` and ``n_new`` count the row's copies on each side. Copies are
    counted before the shuffle, so a row repeated many times stays cheap.
    """
    cols = old.columns
    sides = old.select(*cols, F.lit(1).alias("_o"), F.lit(0).alias("_n")).unionByName(
        new.select(*cols, F.lit(0).alias("_o"), F.lit(1).alias("_n"))
    )
    counted = sides.groupBy(*cols).agg(F.sum("_o").alias("n_old"), F.sum("_n").alias("n_new"))
    outcome = (
        F.when(F.col("n_old") == 0, "inserted").when(F.col("n_new") == 0, "deleted").otherwise("same")
    )
    return counted.withColumn("outcome", outcome)
