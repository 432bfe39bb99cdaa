"""Newest row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from odsflow.sizing import broadcast_if_small, settle


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key.

    An aggregate instead of ``row_number() = 1``: every task reduces its own
    rows to one per key before the shuffle, so a key holding a large share of
    the rows costs no more than any other. Equal ``order`` values fall back on
    the remaining columns, so the choice never depends on row placement.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(
        *[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def newest(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Greatest ``order`` tuple per group, without the other columns."""
    top = df.groupBy(*group).agg(F.max(F.struct(*order)).alias("_top"))
    return top.select(*group, *[F.col(f"_top.`{c}`").alias(c) for c in order])


_ADDRESS = ("_file", "_place")


def newest_addresses(stored: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(_file, _place): where each key's row with the greatest ``order`` values lies.

    ``stored`` reads files. Only keys, order and addresses are read and shuffled,
    one row a key after the step within each task.
    """
    address = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")]
    narrow = stored.select(*keys, *[F.col(c) for c in order if c not in keys], *address)
    picked = F.max(F.struct(*order, *_ADDRESS)).alias("_row")
    return narrow.groupBy(*keys).agg(picked).select(*[F.col(f"_row.{c}").alias(c) for c in _ADDRESS])


def latest_stored(stored: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What ``latest_per_key`` returns, for wide rows that lie in files.

    The winners' addresses are found first; their rows are then fetched by a
    join on the address, in which the winners are broadcast where they measure
    small, so that no wide row is sorted or shuffled, and no row but the winners is
    sent on. Of rows with equal ``order`` values the last one of the last file counts.
    """
    winners = settle(newest_addresses(stored, keys, order), "newest_addresses")
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    return placed.join(broadcast_if_small(winners), list(_ADDRESS), "left_semi").select(*stored.columns)
