"""Which run holds the content of a date."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.functions.scalars import parse_run, run_parts
from odsflow.operators.latest import newest
from odsflow.sizing import broadcast_if_small, settle
from odsflow.sources import paths
from odsflow.sources.partitions import attach_partitions, mount_partitions, point_table

OPEN_PARTITION = "20991231"


_STATUS_FOLDER = "success"


def _bare(name: str) -> str:
    """``x`` from a folder named ``x`` or ``<column>=x``."""
    return name.split("=", 1)[-1]


def list_runs(spark: SparkSession, root: str, dates: Sequence[str] | None = None) -> DataFrame:
    """(date, run, path) of the run folders ``<root>/<date>/<run>``.

    Only folder names are listed, one call per date; ``dates`` narrows them.
    """
    found = [
        (_bare(day), _bare(run), f"{root}/{day}/{run}")
        for day in paths.child_dirs(spark, root)
        if dates is None or _bare(day) in dates
        for run in paths.child_dirs(spark, f"{root}/{day}")
    ]
    return spark.createDataFrame(found, "date string, run string, path string")


def chain_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status lines of the newest ``<ts>_<id>.<ext>`` file in ``folder``."""
    named = [re.match(r"([0-9]{14})_([0-9]+)", n) for n in paths.child_files(spark, folder)]
    runs_found = [(m[1], int(m[2]), m.string) for m in named if m]
    if not runs_found:
        raise FileNotFoundError(f"no status file in {folder}")
    return parse_status(spark.read.text(f"{folder}/{max(runs_found)[2]}"))


def parse_status(lines: DataFrame, value: str = "value") -> DataFrame:
    """Status lines ``<ts>_<id>[<tab><schema json>]`` -> (ts, id, schema_json)."""
    parts = F.split(F.col(value), "\t", 2)
    ts, run_id = run_parts(parts.getItem(0))
    return lines.where(F.length(value) > 0).select(
        ts.alias("ts"), run_id.alias("id"), F.get(parts, F.lit(1)).alias("schema_json")
    )


def latest_run(df: DataFrame, run_col: str) -> DataFrame:
    """Rows of the newest run; names that are not a run time are left out.

    Each name is parsed once, and the newest is one scalar: no row is moved.
    """
    names = df.select(run_col).distinct()
    top = names.where(parse_run(F.col(run_col)).isNotNull()).agg(F.max(run_col))
    return df.where(F.col(run_col) == top.scalar())


def latest_run_per_date(df: DataFrame, date_col: str, run_cols: Sequence[str]) -> DataFrame:
    """Rows of the newest run of each date, the run columns kept.

    The newest names, one row per date, are settled first and measured before
    they are broadcast; the rows themselves then stay where they are, however
    unevenly dates are filled.
    """
    by = [date_col, *run_cols]
    top = settle(newest(df.select(*by), [date_col], run_cols), "newest_runs")
    return df.join(broadcast_if_small(top), by, "left_semi").select(*df.columns)


def newest_run_names(runs: DataFrame, date_col: str = "date", run_col: str = "run") -> DataFrame:
    """Per date the greatest run name, compared as text."""
    return newest(runs, [date_col], [run_col])


def resolve_chain_runs(status: DataFrame, listing: DataFrame, today: str) -> DataFrame:
    """(partition, run) for every listed date and for the open partition.

    Each date maps to its newest ``<ts>_<id>`` run, ids compared as numbers. The
    open partition maps to the newest run of the status lines; when that run
    is from ``today``, so does every date. ``status`` has (ts, id),
    ``listing`` has (date, ts, id).
    """
    name = F.concat_ws("_", "ts", F.col("id").cast("string"))
    top = newest(status, [], ["ts", "id"]).select(name.alias("run"))
    per_date = newest(
        listing.where(~F.col("date").isin(_STATUS_FOLDER, OPEN_PARTITION)), ["date"], ["ts", "id"]
    )
    current = top.scalar()
    chosen = F.when(F.substring(current, 1, 8) == today, current).otherwise(name)
    dates = per_date.select(F.col("date").alias("partition"), chosen.alias("run"))
    return dates.unionByName(top.select(F.lit(OPEN_PARTITION).alias("partition"), "run"))


def mount_runs(spark: SparkSession, table: str, mapping: DataFrame, column: str) -> None:
    """Make the resolved run folders the table's only partitions.

    ``mapping`` has (partition, path), one row per loaded date.
    """
    found = mapping.select("partition", "path").collect()
    mount_partitions(spark, table, {((column, r["partition"]),): r["path"] for r in found})


def mount_date(spark: SparkSession, table: str, column: str, date: str, path: str) -> None:
    """Let one date's partition read its newest run; other dates stay as they are."""
    attach_partitions(spark, table, {((column, date),): path})


def mount_current(spark: SparkSession, table: str, listing: DataFrame, date: str) -> str:
    """Let the current table read the newest run of ``date``; returns its folder.

    ``listing`` has (date, run, path). Names that are not a run time, and runs
    marked as taken, are left out.
    """
    found = listing.where((F.col("date") == date) & parse_run(F.col("run")).isNotNull())
    top = found.agg(F.max_by("path", "run")).first()[0]
    if top is None:
        raise FileNotFoundError(f"no run for {date}")
    point_table(spark, table, top)
    return top


def readiness(status: DataFrame, cutoff: str, group: Sequence[str] = (), ts_col: str = "ts") -> DataFrame:
    """Per group the newest processed time and whether it is strictly after ``cutoff``."""
    top = status.groupBy(*group).agg(F.max(ts_col).alias("newest"))
    after = F.col("newest") > F.lit(cutoff).cast(status.schema[ts_col].dataType)
    return top.withColumn("ready", F.coalesce(after, F.lit(False)))
