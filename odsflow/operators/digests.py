"""Snapshots compared by digests first; whole rows are moved only where they differ.

A row's digest is two 64-bit hashes over its columns, nulls told apart. Keys fall
into ``ranges`` by their hash; a range's digest is the count of its rows and sums
over their digests, taken in the tasks that read them. Ranges with equal digests
hold the same rows and go no further. Of the others only keys and digests are
shuffled, and only the rows that turn out to differ are fetched whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from odsflow.sizing import broadcast_if_small, settle

#: Ranges of keys; a changed row costs the keys and digests of its range.
RANGES = 65_536

_LOW = 0xFFFFFFFF


def _hash(columns: Sequence[str], salt: int) -> Column:
    """Null and empty differ, and so do values that move from one column to the next."""
    parts = [p for c in columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def row_digests(df: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """(keys, _range, _d1, _d2) of every row: narrow, so it can be stored beside a snapshot.

    A null key fails the job.
    """
    _hashable(df)
    columns = sorted(df.columns)
    null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    wrong = F.raise_error(F.concat(F.lit("null key in snapshot: "), F.to_json(F.struct(*keys)))).cast("int")
    place = F.pmod(_hash(list(keys), 0), F.lit(ranges)).cast("int")
    return df.select(
        *keys, F.when(null, wrong).otherwise(place).alias("_range"), _hash(columns, 1).alias("_d1"), _hash(columns, 2).alias("_d2")
    )


def _hashable(df: DataFrame) -> None:
    for field in df.schema.fields:
        if "map<" in field.dataType.simpleString() or isinstance(field.dataType, T.VariantType):
            raise TypeError(f"{field.name}: {field.dataType.simpleString()} has no digest")


def range_digests(digests: DataFrame) -> DataFrame:
    """(_range, n, sums) of ``row_digests``: at most a row a range, summed before its shuffle."""
    halves = [h for d in ("_d1", "_d2") for h in (F.col(d).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(F.col(d), 32))]
    return digests.groupBy("_range").agg(F.count("*").alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)])


def unequal_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """(_range) whose rows are not the same in both ``row_digests``."""
    sums = ["n", "s0", "s1", "s2", "s3"]
    sides = [range_digests(d).select("_range", F.struct(*sums).alias(name)) for d, name in ((old, "_o"), (new, "_n"))]
    both = sides[0].join(sides[1], "_range", "full_outer")
    return both.where(~F.col("_o").eqNullSafe(F.col("_n"))).select("_range")


def _single(digests: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys with their digest; a repeated key fails instead of pairing up."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    repeated = F.raise_error(
        F.concat(F.lit(f"key repeated in {name} snapshot: "), F.to_json(F.struct(*keys)))
    ).cast("struct<_d1:bigint,_d2:bigint>")
    ranked = digests.withColumn("_rank", rank)
    return ranked.select(*keys, F.when(F.col("_rank") == 1, F.struct("_d1", "_d2")).otherwise(repeated).alias(name))


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, outcome) of the keys whose rows differ, from two ``row_digests``.

    The digests of unequal ranges are settled: they are all that is shuffled.
    """
    places = settle(unequal_ranges(old, new), "unequal_ranges")
    wanted = [settle(d.join(broadcast_if_small(places), "_range", "left_semi"), "digests") for d in (old, new)]
    both = _single(wanted[0], keys, "old").join(_single(wanted[1], keys, "new"), list(keys), "full_outer")
    outcome = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, outcome.alias("outcome"))


def snapshot_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ranges: int = RANGES,
    old_digests: DataFrame | None = None,
) -> DataFrame:
    """What ``snapshot_diff`` reports except rows that are the same: keys, outcome, ``old`` and ``new`` structs.

    ``old_digests`` are the stored ``row_digests`` of the old snapshot, by the same
    ``ranges``; then its unchanged rows are not read again. Both snapshots are read
    several times, so pass stored tables. Repeated keys fail where their range
    has changed; in an unchanged range both snapshots repeat them alike.
    """
    new = new.select(*old.columns)
    before = row_digests(old, keys, ranges) if old_digests is None else old_digests
    changed = settle(changed_keys(before, row_digests(new, keys, ranges), keys), "changed_keys")
    wanted = broadcast_if_small(changed.select(*keys))
    sides = [
        df.join(wanted, list(keys), "left_semi").select(*keys, F.struct(*df.columns).alias(name))
        for df, name in ((old, "old"), (new, "new"))
    ]
    found = changed.join(sides[0], list(keys), "left").join(sides[1], list(keys), "left")
    return found.select(*keys, "outcome", "old", "new")
