"""Intake of staged runs, each taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from odsflow.functions.scalars import path_value


def staged_runs(
    spark: SparkSession,
    staged: str,
    schema: T.StructType,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream of rows under ``<staged>/<date>/<run>/`` with their date and run.

    ``archive`` names a folder that taken files are moved to, which keeps the
    listing of the staging area short.
    """
    # The source leaves out files of an age; this one no file reaches.
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500000d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    folder = F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "")
    return reader.parquet(f"{staged.rstrip('/')}/*/*").select(
        "*", path_value(folder, 2).alias("date"), path_value(folder).alias("run")
    )


def intake(
    spark: SparkSession,
    staged: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    max_files: int | None = None,
    archive: str | None = None,
    files_per_run: int | None = None,
) -> StreamingQuery:
    """Copy every staged run not yet taken into ``target``; returns the finished query.

    The checkpoint remembers what was taken, so a second call takes only new
    runs, and a call that was cut off is completed by the next one. Read
    ``target`` as a whole: its sink log leaves out files of failed attempts.
    ``max_files`` bounds a batch where the backlog is large. Without
    ``files_per_run`` each task writes a file for each run that it holds rows of;
    with it, rows are dealt so that a batch writes at most so many files a run.
    """
    rows = staged_runs(spark, staged, schema, max_files, archive)
    if files_per_run:
        dealt = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]), F.lit(files_per_run))
        rows = rows.repartition("date", "run", dealt)
    query = (
        rows.writeStream.format("parquet")
        .partitionBy("date", "run")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_taken(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows taken so far, with their date and run."""
    marks = [T.StructField(c, T.StringType()) for c in ("date", "run")]
    return spark.read.schema(T.StructType([*schema.fields, *marks])).parquet(target)
