"""Run folders, exported files with checksums, partition copies."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from odsflow.sizing import broadcast_if_small, settled
from odsflow.sources import delimited, partitions, paths

#: Bytes of an export's part, at most; a part is hashed in one piece.
PART_BYTES = 2**30
HASHED_BYTES = 2**31 - 2**20


def read_run(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """A run folder under the declared schema; nothing is inferred."""
    return spark.read.schema(schema).parquet(path)


def export_folder(path: str, date: str, system: str, table: str, suffix: str) -> str:
    return f"{path.rstrip('/')}/{date}/{system}/{table}_{date}.{suffix}"


def part_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_bytes) of the part files under ``path``; no content is read."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return parts.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("n_bytes"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_bytes, md5) of the part files under ``path``, hashed where they lie.

    Lengths are looked at first: a part that no task could hold is refused.
    """
    longest = part_lengths(spark, path).orderBy(F.desc("n_bytes")).first()
    if longest and longest["n_bytes"] > HASHED_BYTES:
        raise ValueError(f"{longest['file']} has {longest['n_bytes']} bytes; at most {HASHED_BYTES} can be hashed")
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return parts.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("n_bytes"),
        F.md5("content").alias("md5"),
    )


def _numbered_parts(lines: DataFrame, part_bytes: int, small: ExitStack) -> DataFrame:
    """(value, part) of stored ``lines`` (value, _bytes, _task, _nth): parts of even size, none above ``part_bytes``.

    A line's place is what all lines before it take up, by running sums within
    each task and over the tasks; a part begins at every half of the bound. A line
    wider than that is a part by itself (its number is negative) and takes no place.
    Only the lengths go through the sums. Each task's lines then learn their part
    from the places where its parts begin.
    """
    half = max(1, part_bytes // 2)
    narrow = lines.select("_task", "_nth", F.when(F.col("_bytes") <= half, F.col("_bytes")).otherwise(0).alias("_size"))
    in_task = Window.partitionBy("_task").orderBy("_nth")
    before = in_task.rowsBetween(Window.unboundedPreceding, -1)
    # One row a task goes through this window.
    over_tasks = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    totals = narrow.groupBy("_task").agg(F.sum("_size").alias("_total"))
    offsets = totals.select("_task", F.coalesce(F.sum("_total").over(over_tasks), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.coalesce(F.sum("_size").over(before), F.lit(0))
    part = F.when(F.col("_size") == 0, -1 - F.col("_nth")).otherwise(F.floor(place / half))
    # Two numbers a task, so a broadcast is bounded by the number of tasks.
    numbered = narrow.join(F.broadcast(offsets), "_task").withColumn("_part", part)
    begins = numbered.withColumn("_last", F.lag("_part").over(in_task)).where(~F.col("_part").eqNullSafe(F.col("_last")))
    cuts = begins.groupBy("_task").agg(F.sort_array(F.collect_list(F.struct("_nth", "_part"))).alias("_cuts"))
    cuts = small.enter_context(settled(cuts, "part_cuts"))
    own = F.element_at(F.filter("_cuts", lambda c: c["_nth"] <= F.col("_nth")), -1)["_part"]
    return lines.join(broadcast_if_small(cuts), "_task").select("value", own.alias("part"))


def write_parts(df: DataFrame, path: str, part_bytes: int = PART_BYTES) -> list[str]:
    """Rows as delimited text in files ``part-00000`` on, of even size and at most ``part_bytes``.

    A row that is wider by itself is a longer file. The query runs once: its lines
    are settled with their lengths, from which the parts are chosen.
    """
    spark = df.sparkSession
    lines = delimited.to_lines(df).select(
        "value",
        (F.octet_length("value") + 1).cast("long").alias("_bytes"),
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_nth"),
    )
    # Beside the export, not in it, until every part is whole.
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    with ExitStack() as scratch:
        stored = scratch.enter_context(settled(lines, "export_lines"))
        parts = _numbered_parts(stored, part_bytes, scratch).repartition("part")
        parts.write.partitionBy("part").option("lineSep", "\n").text(staged)
    numbers = sorted(int(n.split("=", 1)[1]) for n in paths.child_dirs(spark, staged))
    found = [f"{staged}/part={n}/{f}" for n in numbers for f in paths.child_files(spark, f"{staged}/part={n}")]
    names = [f"part-{i:05d}.dat" for i in range(len(found))]
    for source, name in zip(found, names):
        paths.rename(spark, source, f"{path}/{name}")
    paths.touch(spark, f"{path}/_SUCCESS")
    paths.delete(spark, staged)
    return names


def export_file(
    df: DataFrame,
    path: str,
    date: str,
    system: str,
    table: str,
    rows_per_file: int | None = None,
    part_bytes: int = PART_BYTES,
) -> tuple[str, str]:
    """Rows as delimited text under a dated name, with an MD5 list beside them.

    ``<table>_<date>.dat`` is a folder of parts, each hashed by itself into
    ``<table>_<date>.md5``. Parts are cut by bytes; with ``rows_per_file`` by rows.
    """
    spark = df.sparkSession
    data = export_folder(path, date, system, table, "dat")
    sums = export_folder(path, date, system, table, "md5")
    if rows_per_file:
        delimited.write_delimited(df, data, rows_per_file=rows_per_file)
    else:
        write_parts(df, data, part_bytes)
    manifest(spark, data).select(F.concat_ws("  ", "md5", "file").alias("value")).write.text(sums)
    return data, sums


def export_query(
    spark: SparkSession, sql: str, path: str, date: str, system: str, table: str, **options
) -> tuple[str, str]:
    """Export a query; ``:date`` in it stands for the date."""
    return export_file(spark.sql(sql, args={"date": date}), path, date, system, table, **options)


def verify_export(spark: SparkSession, data: str, sums: str) -> DataFrame:
    """The manifest with ``intact``: does each part still have its recorded MD5?"""
    lines = spark.read.text(sums).select(F.split("value", "  ").alias("p"))
    recorded = lines.select(F.col("p")[0].alias("recorded"), F.col("p")[1].alias("file"))
    return (
        manifest(spark, data)
        .join(recorded, "file", "full_outer")
        .withColumn("intact", F.col("md5").eqNullSafe(F.col("recorded")))
    )


def copy_partitions(spark: SparkSession, source: str, target: str, column: str, values: Collection[str]) -> list[str]:
    """Copy several partitions of one table into another in one job; one without rows becomes empty there."""
    kept = set(partitions.partition_values(spark, source)) & set(values)
    rows = spark.table(source).where(F.col(column).isin(sorted(kept)))
    written = {n.split("=", 1)[1] for n in partitions.swap_partitions(spark, target, rows, column)}
    for value in sorted(kept - written):
        copy_partition(spark, source, target, column, value)
    return sorted(kept)


def copy_partition(spark: SparkSession, source: str, target: str, column: str, value: str) -> str:
    """Copy partition ``column = value`` of one table into another."""
    rows = spark.table(source).where(F.col(column) == value)
    return partitions.swap_partition(spark, target, rows, ((column, value),))
