"""Stored history chains, one partition per end day.

A day's merge reads the open partition (and, when a day is run again, the
partitions closed since) and writes only two: the open one and the day's own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.operators.chain import CHAIN, ChainLayout, chain_day, chain_init, live_before, replay_days
from odsflow.sizing import is_small
from odsflow.sources import partitions, paths


@dataclass(frozen=True)
class ChainRun:
    """What a merge did; ``replaced`` lists folders no partition uses any more."""

    day: str
    broadcast: bool
    dropped: list[str] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class _Store:
    location: str
    buckets: int
    bucketed_by: list[str]


def _store(spark: SparkSession, table: str) -> _Store:
    known = partitions.table_details(spark, table)
    buckets = max(0, int(known.get("Num Buckets") or 0))
    names = known.get("Bucket Columns", "").strip("[]")
    return _Store(
        partitions.table_home(spark, table), buckets, [n.strip().strip("`") for n in names.split(",")] if buckets else []
    )


def _write_run(table: str, store: _Store, rows: DataFrame, folder: str, by: str) -> None:
    """Rows into ``folder`` by partition, clustered the way the table is."""
    writer = rows.write.format("parquet").partitionBy(by)
    if not store.buckets:
        writer.save(folder)
        return
    holder = f"{table}_{uuid.uuid4().hex}"
    clustered = writer.bucketBy(store.buckets, *store.bucketed_by).sortBy(*store.bucketed_by)
    clustered.option("path", folder).saveAsTable(holder)
    rows.sparkSession.sql(f"DROP TABLE {holder}")


def load_chain_init(
    df: DataFrame, table: str, day: str, layout: ChainLayout = CHAIN, keys: Sequence[str] | None = None
) -> None:
    """Make the whole source the open partition; ``keys`` are checked where they are given."""
    spark = df.sparkSession
    load_chain(spark, table, chain_init(df, day, layout, keys), layout)


def load_chain(spark: SparkSession, table: str, history: DataFrame, layout: ChainLayout = CHAIN) -> None:
    """Store a complete chain, such as one built in bulk, as the table's content."""
    store = _store(spark, table)
    folder = partitions.new_run(store.location, "all")
    rows = partitions.as_stored(history, table)
    rows = (
        rows.repartition(store.buckets, *store.bucketed_by)
        if store.buckets
        else rows.hint("rebalance", F.col(layout.end))
    )
    _write_run(table, store, rows, folder, layout.end)
    mapping = {
        ((layout.end, name.split("=", 1)[1]),): f"{folder}/{name}"
        for name in paths.child_dirs(spark, folder)
    }
    partitions.mount_partitions(spark, table, mapping)


def load_chain_day(
    spark: SparkSession,
    table: str,
    delta: DataFrame,
    keys: Sequence[str],
    day: str,
    layout: ChainLayout = CHAIN,
    broadcast_limit: int | None = None,
) -> ChainRun:
    """Merge one day's changed rows into a stored chain.

    ``delta`` is a stored table, usually the day's staging partition: its size
    is measured before the join is chosen. Running a day again, or an earlier
    day, first undoes that day and all later ones.

    The day's closed versions are attached before the open partition is
    exchanged. A driver lost in between leaves versions both closed and open;
    the next run of the day reads one of each and so completes the work.
    """
    open_spec = ((layout.end, layout.open_end),)
    day_spec = ((layout.end, day),)
    stored = spark.table(table)
    live, later = _live(spark, table, keys, day, layout)
    changes = partitions.as_stored(delta, table, layout.marks)
    small = is_small(changes, broadcast_limit)
    store = _store(spark, table)
    if store.buckets and not small:
        changes = changes.repartition(store.buckets, *keys)
    folder = partitions.new_run(store.location, day)
    touched = chain_day(live, changes, keys, day, layout, small_delta=small)
    _write_run(table, store, touched.select(*stored.columns), folder, layout.end)

    replaced = [
        partitions.table_details(spark, table, spec).get("Location")
        for spec in partitions.partition_specs(spark, table)
        if spec == open_spec or spec in later
    ]
    written = {n.split("=", 1)[1] for n in paths.child_dirs(spark, folder)}
    if day in written:
        closed = f"{folder}/{layout.end}={day}"
        if not store.buckets:
            closed = _repacked(spark, closed, f"{folder}/closed")
        partitions.attach_partitions(spark, table, {day_spec: closed}, own=True)
    if layout.open_end in written:
        path = f"{folder}/{layout.end}={layout.open_end}"
        partitions.attach_partitions(spark, table, {open_spec: path}, own=True)
    stale = {dict(s)[layout.end] for s in later} - ({day} & written)
    if layout.open_end not in written:
        stale.add(layout.open_end)
    dropped = partitions.drop_partitions(spark, table, lambda s: s[layout.end] in stale)
    return ChainRun(day, small, [dict(s)[layout.end] for s in dropped], [p for p in replaced if p])


def _live(
    spark: SparkSession, table: str, keys: Sequence[str], day: str, layout: ChainLayout
) -> tuple[DataFrame, set[partitions.Spec]]:
    """The open versions as they stood before ``day``, and the partitions closed on it or later.

    A run that was cut off may have left a version both closed and open; one of each is taken.
    """
    if not layout.first < day < layout.open_end:
        raise ValueError(f"{day} is not between {layout.first} and {layout.open_end}")
    later = {
        spec for spec in partitions.partition_specs(spark, table)
        if day <= dict(spec)[layout.end] < layout.open_end
    }
    live = live_before(spark.table(table), day, layout)
    return (live.dropDuplicates(list(keys)) if later else live), later


def load_chain_range(
    spark: SparkSession,
    table: str,
    changes: DataFrame,
    keys: Sequence[str],
    first: str,
    day_col: str = "etl_dt",
    layout: ChainLayout = CHAIN,
    broadcast_limit: int | None = None,
) -> ChainRun:
    """Replay all days from ``first`` on into a stored chain, in one pass.

    ``changes`` is a stored table that holds every change of these days, one row per
    key and day; days before ``first`` in it are left out. What the chain holds of
    ``first`` and later days is undone. Only the open partition and those closed
    on or after ``first`` are read and written; the open one is exchanged last, so
    a driver lost in between leaves versions both closed and open, which the next
    run repairs.
    """
    stored = spark.table(table)
    live, later = _live(spark, table, keys, first, layout)
    wanted = changes.where(F.col(day_col) >= first)
    wanted = partitions.as_stored(wanted, table, layout.marks, [day_col])
    small = is_small(wanted, broadcast_limit)
    store = _store(spark, table)
    if store.buckets and not small:
        wanted = wanted.repartition(store.buckets, *keys)
    folder = partitions.new_run(store.location, f"{first}-on")
    after = replay_days(live, wanted, keys, f"_given_{day_col}", first, layout, small)
    _write_run(table, store, after.select(*stored.columns), folder, layout.end)

    specs = {s for s in partitions.partition_specs(spark, table) if s in later or dict(s)[layout.end] == layout.open_end}
    replaced = [partitions.table_details(spark, table, s).get("Location") for s in sorted(specs)]
    written = {n.split("=", 1)[1]: f"{folder}/{n}" for n in paths.child_dirs(spark, folder)}
    closed = {d: p for d, p in written.items() if d != layout.open_end}
    if closed and not store.buckets:
        closed = _repacked_days(spark, closed, f"{folder}/closed", layout.end)
    partitions.attach_partitions(spark, table, {((layout.end, d),): p for d, p in sorted(closed.items())}, own=True)
    if layout.open_end in written:
        partitions.attach_partitions(spark, table, {((layout.end, layout.open_end),): written[layout.open_end]}, own=True)
    stale = {dict(s)[layout.end] for s in specs} - set(written)
    dropped = partitions.drop_partitions(spark, table, lambda s: s[layout.end] in stale)
    return ChainRun(first, small, [dict(s)[layout.end] for s in dropped], [p for p in replaced if p])


def _repacked_days(spark: SparkSession, days: dict[str, str], target: str, column: str) -> dict[str, str]:
    """All days' closed versions, spread over the replay's tasks, in files of even size; one job."""
    base = next(iter(days.values())).rsplit("/", 1)[0]
    rows = spark.read.option("basePath", base).parquet(*days.values())
    rows = rows.withColumn(column, F.col(column).cast("string"))
    rows.hint("rebalance", F.col(column)).write.partitionBy(column).parquet(target)
    return {d: f"{target}/{column}={d}" for d in days}


def _repacked(spark: SparkSession, path: str, target: str) -> str:
    """The day's closed versions, spread thinly over the merge's tasks, in files of even size."""
    spark.read.parquet(path).hint("rebalance").write.parquet(target)
    return target
