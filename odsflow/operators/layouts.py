"""Table layouts: the columns and partition key a load strategy adds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession, types as T

from odsflow.config import TableConfig
from odsflow.operators.schema import stored_columns


@dataclass(frozen=True)
class Layout:
    partition: str | None
    lead: tuple[str, ...] = ()
    trail: tuple[str, ...] = ()
    suffix: str = ""
    binary_blob: bool = False


# Bookkeeping columns and partition key per load strategy.
LAYOUTS = {
    "base": Layout("biz_end_date", suffix="_s"),
    "slice": Layout("data_dt", lead=("etl_dt",), binary_blob=True),
    "append": Layout("etl_dt"),
    "chain": Layout("end_dt", lead=("etl_dt", "start_dt")),
    "staging": Layout("etl_dt"),
    "old_chain": Layout("e_dt", trail=("s_dt",), suffix="_his"),
    "replace": Layout(None),
}


def staging_name(table: str) -> str:
    """The staging table of a chain: last character replaced by ``m``."""
    return table[:-1] + "m"


def layout_columns(cfg: TableConfig, layout: str) -> list[tuple[str, str]]:
    """(name, SQL type) of every stored column, the partition key last."""
    chosen = LAYOUTS[layout]
    names = [(c, "STRING") for c in chosen.lead]
    names += stored_columns(cfg, chosen.binary_blob)
    names += [(c, "STRING") for c in chosen.trail]
    if chosen.partition:
        names.append((chosen.partition, "STRING"))
    return names


def layout_schema(cfg: TableConfig, layout: str) -> tuple[T.StructType, list[str]]:
    """The layout's stored columns as a schema, and its partition columns."""
    ddl = ", ".join(f"`{c}` {t}" for c, t in layout_columns(cfg, layout))
    part = LAYOUTS[layout].partition
    return T.StructType.fromDDL(ddl), [part] if part else []


def table_name(cfg: TableConfig, layout: str) -> str:
    name = staging_name(cfg.hive_table) if layout == "staging" else cfg.hive_table
    return f"{cfg.hive_db}.{name}{LAYOUTS[layout].suffix}"


def create_table(
    spark: SparkSession,
    cfg: TableConfig,
    layout: str,
    location: str | None = None,
    table: str | None = None,
    buckets: int | None = None,
) -> str:
    """Drop and create the table of a layout; returns its name.

    ``buckets`` clusters a chain by its keys: the daily merge then reads the
    open rows already placed by key and shuffles only the day's changes.
    """
    name = table or table_name(cfg, layout)
    columns = ", ".join(f"`{c}` {t}" for c, t in layout_columns(cfg, layout))
    parts = [f"CREATE TABLE {name} ({columns}) USING parquet"]
    if LAYOUTS[layout].partition:
        parts.append(f"PARTITIONED BY (`{LAYOUTS[layout].partition}`)")
    if buckets:
        keys = ", ".join(f"`{k}`" for k in cfg.key_names)
        parts.append(f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS")
    if location:
        parts.append(f"LOCATION '{location}'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(" ".join(parts))
    return name


def create_chain_tables(
    spark: SparkSession, cfg: TableConfig, location: str | None = None, buckets: int | None = None
) -> tuple[str, str]:
    """The chain and its staging table."""
    def under(name: str) -> str | None:
        return f"{location}/{name}" if location else None

    chain = create_table(spark, cfg, "chain", under("chain"), buckets=buckets)
    return chain, create_table(spark, cfg, "staging", under("staging"))
