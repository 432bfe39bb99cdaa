"""Row counts that read no rows: out of file footers, or inside the database."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.config import TableConfig
from odsflow.sources import partitions, paths, rdbms

# Settings of a session of its own, in which the parquet reader takes aggregates.
_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_counts(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """(n_rows) of the parquet files in ``folders``, summed from their footers."""
    own = spark.newSession()
    for key, value in _FOOTERS.items():
        own.conf.set(key, value)
    return own.read.parquet(*folders).agg(F.count("*").alias("n_rows"))


def _total(spark: SparkSession, folders: Sequence[str]) -> int:
    # Of files without rows nothing comes out of the footers, and so no sum.
    return (footer_counts(spark, folders).first()["n_rows"] if folders else 0) or 0


def _has_files(spark: SparkSession, folder: str) -> bool:
    return paths.exists(spark, folder) and bool(paths.child_files(spark, folder) or paths.child_dirs(spark, folder))


def stored_count(
    spark: SparkSession, table: str, which: Callable[[dict[str, str]], bool] = lambda _: True
) -> int:
    """Rows in the table's partitions that ``which`` accepts, or in a table without partitions.

    The catalog names the folders and their files' footers hold the counts; no
    row is read. A condition on other columns than the partition's needs
    ``row_count``.
    """
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        chosen = [s for s in partitions.partition_specs(spark, table) if which(dict(s))]
        folders = [partitions.table_details(spark, table, s)["Location"] for s in chosen]
    else:
        folders = [partitions.table_location(spark, table)]
    folders = [f for f in folders if _has_files(spark, f)]
    return _total(spark, folders)


def count_query(cfg: TableConfig, predicate: str | None = None) -> str:
    where = f" where {predicate}" if predicate else ""
    return f"select count(*) n_rows from {rdbms.source_name(cfg)}{where}"


def count_options(cfg: TableConfig, predicate: str | None = None) -> dict[str, str]:
    """Options of a JDBC read of one row: the database counts."""
    return {**rdbms.login(cfg), "query": count_query(cfg, predicate)}


def source_count(spark: SparkSession, cfg: TableConfig, predicate: str | None = None) -> int:
    """Rows of a source table, counted inside the database.

    A folder of parquet tables is counted from its footers, or where there is a
    predicate by reading the columns that it names.
    """
    if cfg.url.startswith("jdbc:"):
        return int(spark.read.format("jdbc").options(**count_options(cfg, predicate)).load().first()[0])
    if predicate:
        return rdbms.read_source(spark, cfg, predicate).count()
    return _total(spark, [rdbms.source_folder(cfg)])
