"""Row-count reconciliation and the load logs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.functions.scalars import parse_day, parse_run_time
from odsflow.operators.chain import CHAIN, ChainLayout

# The columns of the load log and of the completion log.
LOG_KEYS = ("db_name", "table_name", "data_date", "run_time")
LOG_COUNTS = ("source_count_1", "source_count_2", "target_count")
BATCH_KEYS = ("sys", "step", "data_dt")

# Which count a round writes, and which ones it clears.
ROUNDS = {
    "source_before": ("source_count_1", ("source_count_2", "target_count")),
    "source_after": ("source_count_2", ()),
    "target": ("target_count", ()),
}


def slice_condition(day: str, part: str = "data_dt") -> Column:
    return F.col(part) == day


def as_of_condition(day: str, layout: ChainLayout = CHAIN) -> Column:
    return (F.col(layout.start) <= day) & (F.col(layout.end) > day)


def row_count(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    kept = df if where is None else df.where(where)
    return kept.agg(F.count("*").alias("n_rows"))


def reconcile(
    before: DataFrame, target: DataFrame, after: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts per key of source before, target and source after, with a verdict.

    ``ok`` when all agree, ``moving`` when the source changed meanwhile,
    ``differs`` when a steady source and the target disagree. One shuffle of
    partial counts, however rows spread over the keys.
    """
    tagged = [
        df.select(*keys, *[F.lit(int(i == j)).cast("long").alias(c) for j, c in enumerate(LOG_COUNTS)])
        for i, df in ((0, before), (1, after), (2, target))
    ]
    counts = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    summed = counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in LOG_COUNTS])
    first, second, loaded = (F.col(c) for c in LOG_COUNTS)
    verdict = (
        F.when(first != second, "moving").when(first != loaded, "differs").otherwise("ok")
    )
    return summed.withColumn("status", verdict)


def upsert(
    log: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    reset: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """``log`` after writing ``rows`` by key.

    A known key takes the new ``update`` values, nulls in ``reset`` and keeps
    the rest; an unknown key is added. Of several rows with one key the last
    by ``order`` counts; unlike rows of equal rank fail the job. A single
    aggregate, reduced before its shuffle.
    """
    def ranked(side: int, values: Sequence[Column]) -> list[Column]:
        mark = F.lit(side)
        return [mark.alias("_side"), (F.struct(mark.alias("_side"), *values) if order else mark).alias("_rank")]

    unset = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
    told = [p for c in update for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    old = log.select(*log.columns, *ranked(0, unset), F.lit(0).cast("long").alias("_print"))
    new = rows.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in keys or f.name in update
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in log.schema.fields
        ],
        *ranked(1, [F.col(c) for c in order]),
        F.xxhash64(F.lit(0), *told).alias("_print"),
    )
    # The last rows by rank agree when the greatest and the least of their prints do.
    most, least = F.max(F.struct("_rank", "_print")), F.max(F.struct("_rank", F.bitwise_not("_print").alias("_print")))
    tied = F.raise_error(F.concat(F.lit("rows of equal rank differ: "), F.to_json(F.struct(*keys)))).cast("boolean")
    agreed = F.when(most["_print"] != F.bitwise_not(least["_print"]), tied).otherwise(F.lit(True)).alias("_agreed")
    is_new = F.max("_side") == 1
    values = []
    for c in log.columns:
        if c in keys:
            continue
        kept = F.max_by(c, F.when(F.col("_side") == 0, 1))
        if c in update:
            value = F.max_by(c, "_rank")
        elif c in reset:
            value = F.when(~is_new, kept)
        else:
            value = kept
        values.append(value.alias(c))
    merged = old.unionByName(new).groupBy(*keys).agg(*values, agreed)
    return merged.where("_agreed").select(*log.columns)


def write_log(log: DataFrame, rows: DataFrame, round_name: str) -> DataFrame:
    """One round of counts into the load log; ``rows`` has the keys and ``n_rows``.

    The first source count of a run starts its row over, clearing the others.
    """
    column, cleared = ROUNDS[round_name]
    return upsert(log, rows.withColumnRenamed("n_rows", column), LOG_KEYS, [column], cleared)


def batch_complete(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Completion times, the last write per (system, step, day) kept whole."""
    rest = [c for c in log.columns if c not in BATCH_KEYS]
    return upsert(log, rows, BATCH_KEYS, rest, order=["complete_time"])


def log_row(
    spark: SparkSession, db: str, table: str, day: str, run_time: str, counts: dict[str, int | None]
) -> DataFrame:
    """One load-log row; ``day`` is ``yyyyMMdd``, ``run_time`` ``yyyyMMdd HH:mm:ss``."""
    return spark.range(1).select(
        F.lit(db).alias("db_name"),
        F.lit(table).alias("table_name"),
        parse_day(F.lit(day)).alias("data_date"),
        parse_run_time(F.lit(run_time)).alias("run_time"),
        *[F.lit(counts.get(c)).cast("long").alias(c) for c in LOG_COUNTS],
    )


def audited(
    spark: SparkSession,
    db: str,
    table: str,
    day: str,
    source: Callable[[], DataFrame | int],
    load: Callable[[], object],
    target: Callable[[], DataFrame | int],
    run_time: str | None = None,
    write: Callable[[str, DataFrame], object] | None = None,
) -> DataFrame:
    """Count the source, load, count the target and the source again.

    Both sides are given already filtered alike, as rows or as a count that was
    taken without reading any, and every round carries the
    same run time, so the three counts meet in one log row. ``write`` gets each
    round's name and row (the log's keys and ``n_rows``) as soon as it is counted.
    """
    moment = run_time or dt.datetime.now().strftime("%Y%m%d %H:%M:%S")
    counts: dict[str, int | None] = {}

    def count(round_name: str, side: Callable[[], DataFrame | int]) -> None:
        column = ROUNDS[round_name][0]
        found = side()
        counts[column] = found if isinstance(found, int) else found.count()
        if write:
            row = log_row(spark, db, table, day, moment, counts)
            write(round_name, row.select(*LOG_KEYS, F.col(column).alias("n_rows")))

    count("source_before", source)
    load()
    count("target", target)
    count("source_after", source)
    return log_row(spark, db, table, day, moment, counts)
