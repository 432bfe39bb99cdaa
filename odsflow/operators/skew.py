"""Joins whose key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odsflow.sizing import PART_ROWS, broadcast_if_small, is_small, place, settle, task_parts

#: Rows of one key that a task may hold; a key with more is dealt to several.
TASK_ROWS = 4_000_000
FRACTION = 0.001
#: Bytes of hot keys that may be broadcast; there are at most rows / TASK_ROWS of them.
HOT_BROADCAST = 64 << 20


def key_rows(df: DataFrame, key: str, fraction: float | None = None) -> DataFrame:
    """(_key, _rows) of the values of ``key``, by a sampled count.

    The sample only steers how a join is planned, never what it returns.
    """
    fraction = fraction or FRACTION
    sampled = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull())
    if fraction < 1:
        sampled = sampled.sample(fraction, seed=7)
    return sampled.groupBy("_key").agg((F.count("*") / F.lit(fraction)).alias("_rows"))


def _hot(counts: DataFrame, rows: int | None) -> DataFrame:
    slices = F.ceil(F.col("_rows") / F.lit(rows or TASK_ROWS)).cast("int")
    return counts.select("_key", slices.alias("_slices")).where("_slices > 1")


def hot_keys(df: DataFrame, key: str, rows: int | None = None, fraction: float | None = None) -> DataFrame:
    """(_key, _slices) of the values of ``key`` with more than ``rows`` rows, by a sampled count."""
    return _hot(key_rows(df, key, fraction), rows)


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rows: int | None = None,
    fraction: float | None = None,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``key``, kept even when some keys are hot on the left.

    A right side that measures small is broadcast. Otherwise a hot key's rows on
    the left are dealt to slices by a hash of the whole row, and its rows on the
    right are given to every slice; both sides are joined once. An aggregate above
    cannot reuse that placement, so it does not gather a hot key. The hot keys are
    sampled from ``sampled``, a stored table with the key, or else by running the
    left side once more. The same sample tells the rows, and so the partitions that
    both sides are dealt to, whose size does not grow with the input; a key with more
    rows than such a partition counts as hot then.
    """
    if is_small(right):
        return left.join(F.broadcast(right), key)
    counts = settle(key_rows(left if sampled is None else sampled, key, fraction), "key_rows")
    total = counts.agg(F.sum("_rows").cast("long")).first()[0] or 0
    # Keys of two types are placed unlike, so the join places them itself.
    alike = left.schema[key].dataType == right.schema[key].dataType
    parts = task_parts(left.sparkSession, total) if alike else None
    hot = _hot(counts, rows or (min(TASK_ROWS, PART_ROWS) if parts else TASK_ROWS))
    if hot.isEmpty():
        return place(left, parts, key).join(place(right, parts, key), key)
    hot = broadcast_if_small(hot.withColumnRenamed("_key", key), HOT_BROADCAST)
    slices = F.coalesce("_slices", F.lit(1))
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), slices).cast("int")
    each = F.explode(F.sequence(F.lit(0), slices - 1))
    lefts = left.join(hot, key, "left").withColumn("_slice", dealt).drop("_slices")
    rights = right.join(hot, key, "left").withColumn("_slice", each).drop("_slices")
    by = [key, "_slice"]
    return place(lefts, parts, *by).join(place(rights, parts, *by), by).drop("_slice")
