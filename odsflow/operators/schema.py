"""Declared schemas: source conversions, conforming casts, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from odsflow.config import Column, TableConfig
from odsflow.functions.scalars import schema_of, second_text

# Config types a source conversion treats specially.
_TIME_TYPES = {"datetime", "timestamp", "date"}
_LARGE_TYPES = {"clob", "blob", "raw"}


def _converted(column: Column, dialect: str):
    source = F.col(f"`{column.name}`")
    kind = column.type.lower()
    if kind in _TIME_TYPES and dialect == "mysql":
        return second_text(source).alias(column.name)
    if kind in _LARGE_TYPES:
        return F.lit(None).cast("string").alias(column.name)
    if kind == "rowid" and dialect == "oracle":
        return source.cast("string").alias(f"g_{column.name}")
    if kind == "tinyint" and dialect == "mysql":
        return source.cast("int").alias(column.name)
    return source


def convert_columns(df: DataFrame, cfg: TableConfig, dialect: str | None = None) -> DataFrame:
    """Source conversions in declared column order.

    MySQL dates become text, large objects become null (so a database read
    never fetches them), Oracle row ids become ``g_<name>`` text, MySQL
    tinyints become integers.
    """
    chosen = cfg.dialect if dialect is None else dialect
    return df.select(*[_converted(c, chosen) for c in cfg.ordered])


def stored_columns(cfg: TableConfig, binary_blob: bool = False) -> list[tuple[str, str]]:
    """(name, SQL type) of the stored table, in column order."""
    pairs = [(c.name, cfg.sql_type(c, binary_blob)) for c in cfg.ordered]
    if not cfg.use_chain and cfg.import_type == "inc":
        pairs.append(("cdc_type", "STRING"))
    return pairs


def conform(df: DataFrame, cfg: TableConfig, binary_blob: bool = False) -> DataFrame:
    """Declared order and types, by name; text that does not parse becomes null.

    A row id converted to ``g_<name>`` is stored under its declared name.
    """

    def source(name: str):
        renamed = name not in df.columns and f"g_{name}" in df.columns
        return F.col(f"`g_{name}`" if renamed else f"`{name}`")

    return df.select(
        *[source(n).try_cast(t).alias(n) for n, t in stored_columns(cfg, binary_blob)]
    )


def conform_losses(df: DataFrame, cfg: TableConfig, binary_blob: bool = False) -> DataFrame:
    """(column, n_lost, example) of the columns in which ``conform`` turns values into nulls.

    One pass and one row of sums; an empty result means that nothing is lost.
    """
    pairs = []
    for name, kind in stored_columns(cfg, binary_blob):
        source = f"`{name}`" if name in df.columns or f"g_{name}" not in df.columns else f"`g_{name}`"
        lost = F.col(source).isNotNull() & F.col(source).try_cast(kind).isNull()
        pairs.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count_if(lost).alias("n_lost"),
                F.min(F.when(lost, F.col(source).cast("string"))).alias("example"),
            )
        )
    return df.agg(F.array(*pairs).alias("_all")).select(F.inline("_all")).where("n_lost > 0")


def schema_drift(
    status: DataFrame,
    expected: Sequence[tuple[str, str]],
    schema_col: str = "schema_json",
    carry: Sequence[str] = ("run",),
) -> DataFrame:
    """Declared columns that a run did not record, or recorded with another type.

    Columns a run has in addition are allowed. One row per offence; an empty
    result means every run fits. Each run is judged inside its own row.
    """
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in expected]
    )
    recorded = schema_of(F.col(schema_col)).getField("columns")
    listed = status.select(
        *carry, recorded.alias("_recorded"), F.explode(wanted).alias("_wanted")
    )
    found = F.filter(F.col("_recorded"), lambda c: c["name"] == F.col("_wanted.name"))
    return (
        listed.select(
            *carry,
            F.col("_wanted.name").alias("column"),
            F.col("_wanted.type").alias("expected"),
            F.try_element_at(found, F.lit(-1)).getField("type").alias("actual"),
        )
        .where(~F.col("expected").eqNullSafe(F.col("actual")))
    )
