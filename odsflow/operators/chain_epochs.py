"""Stored chains read as of early days, by epochs.

A chain is partitioned by end day, so an early day's versions lie in every later
partition. An epoch table is partitioned by epoch, a run of days, and holds in each
all versions that were valid on any of its days: those that the epoch before
carried over and those that began in it. A day is then read from one partition.

A version that outlives its epoch is stored there without its end, which a later
day may still change; so a merge of a day touches only that day's epoch and later ones.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.operators.chain import CHAIN, ChainLayout
from odsflow.sources import partitions

EPOCH = "epoch"


def epoch_of(starts: Sequence[str], day: str) -> str:
    """The first day of the epoch that ``day`` lies in; ``starts`` are the epochs' first days in order."""
    at = bisect_right(starts, day)
    if not at:
        raise ValueError(f"{day} is before the first epoch, {starts[0] if starts else 'of which there is none'}")
    return starts[at - 1]


def _number(starts: Sequence[str], day: Column) -> Column:
    """How many epochs have begun by ``day``."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= day))


def by_epoch(history: DataFrame, starts: Sequence[str], since: str | None = None, layout: ChainLayout = CHAIN) -> DataFrame:
    """Every version once for each epoch (from the one that begins on ``since``) on a day of which it was valid.

    A version that is valid beyond an epoch has the open end there.
    """
    starts = list(starts)
    if starts != sorted(set(starts)) or not starts:
        raise ValueError("epochs begin on different days, given in order")
    first = starts.index(since) if since else 0
    begin = F.greatest(_number(starts, F.col(layout.start)) - 1, F.lit(first))
    # The last day on which a version is valid lies before its end.
    ended = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s < F.col(layout.end))) - 1
    spread = history.where(F.col(layout.end) > starts[first]).withColumn("_from", begin).withColumn("_to", ended)
    spread = spread.where("_from <= _to").withColumn("_at", F.explode(F.sequence("_from", "_to")))
    names = F.array(*[F.lit(s) for s in starts])
    following = F.array(*[F.lit(s) for s in [*starts[1:], layout.open_end]])
    last = F.element_at(following, F.col("_at") + 1)
    kept = F.when(F.col(layout.end) < last, F.col(layout.end)).otherwise(F.lit(layout.open_end))
    return spread.select(
        *[kept.alias(c) if c == layout.end else F.col(f"`{c}`") for c in history.columns],
        F.element_at(names, F.col("_at") + 1).alias(EPOCH),
    )


def create_epoch_table(spark: SparkSession, chain: str, table: str, location: str | None = None) -> None:
    """A table for the epochs of a stored chain, with the chain's columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(chain).schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {EPOCH} STRING) USING parquet PARTITIONED BY ({EPOCH}){where}")


def refresh_epochs(
    spark: SparkSession, chain: str, table: str, starts: Sequence[str], day: str | None = None, layout: ChainLayout = CHAIN
) -> list[str]:
    """Write the epochs from that of ``day`` on, all by default, out of the stored chain.

    Call it after the merge of ``day``, or after a replay from it on. Of the chain only
    partitions are read that end after the epoch began.
    """
    since = epoch_of(starts, day) if day else starts[0]
    rows = by_epoch(spark.table(chain), starts, since, layout)
    partitions.swap_partitions(spark, table, rows, EPOCH)
    held = {s[0][1] for s in partitions.partition_specs(spark, table)}
    filled = {r[EPOCH] for r in rows.select(EPOCH).distinct().collect()}
    stale = {e for e in held if e >= since and e not in filled}
    partitions.drop_partitions(spark, table, lambda s: s[EPOCH] in stale)
    return sorted(filled)


def epoch_as_of(epochs: DataFrame, starts: Sequence[str], day: str, layout: ChainLayout = CHAIN) -> DataFrame:
    """Versions valid on ``day``, without their end, from the one partition of its epoch."""
    own = epochs.where(F.col(EPOCH) == epoch_of(starts, day))
    return own.where((F.col(layout.start) <= day) & (F.col(layout.end) > day)).drop(EPOCH, layout.end)
