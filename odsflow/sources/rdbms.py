"""Source tables in a database, read in even shares at once, and export back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.config import TableConfig
from odsflow.operators.schema import convert_columns

# Parallel connections for reading and for export.
DEFAULT_READERS = 4
EXPORT_WRITERS = 5
FETCH_ROWS = 10_000

#: How each system hashes a column to 0 .. n - 1; the empty name is Spark itself.
BUCKET_OF = {
    "mysql": "mod(crc32(coalesce({column}, '')), {n})",
    "oracle": "ora_hash({column}, {last})",
    "postgresql": "mod(abs(hashtext(coalesce({column}::text, ''))::bigint), {n})",
    "": "mod(crc32(cast(coalesce(cast({column} as string), '') as binary)), {n})",
}


def source_name(cfg: TableConfig) -> str:
    return f"{cfg.database}.{cfg.table}"


def login(cfg: TableConfig) -> dict[str, str]:
    return _login(cfg.url, cfg.user, cfg.password)


def source_folder(cfg: TableConfig) -> str:
    """Where a source lies that is no database."""
    return f"{cfg.url.removeprefix('parquet:').rstrip('/')}/{cfg.table}.parquet"


def _login(url: str, user: str, password: str) -> dict[str, str]:
    pairs = {"url": url, "user": user, "password": password}
    return {k: v for k, v in pairs.items() if v}


def quantile_query(cfg: TableConfig, readers: int, predicate: str | None = None) -> str:
    """The greatest split value of each of ``readers`` groups of equal numbers of rows."""
    where = f" where {predicate}" if predicate else ""
    dealt = f"select {cfg.split_by} v, ntile({readers}) over (order by {cfg.split_by}) g from {source_name(cfg)}{where}"
    return f"select max(v) b from ({dealt}) t group by g order by b"


def _literal(value: object) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"date '{value:%Y-%m-%d}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that part a column's values after each bound; every row meets one, nulls the first."""
    cuts = list(dict.fromkeys(b for b in bounds if b is not None))
    if not cuts:
        return ["1 = 1"]
    found = [f"{column} <= {_literal(cuts[0])} or {column} is null"]
    found += [f"{column} > {_literal(low)} and {column} <= {_literal(high)}" for low, high in zip(cuts, cuts[1:])]
    return [*found, f"{column} > {_literal(cuts[-1])}"]


def hash_predicates(column: str, readers: int, dialect: str = "") -> list[str]:
    """Conditions that deal a column's values to ``readers`` by their hash; nulls are one value."""
    if dialect not in BUCKET_OF:
        raise ValueError(f"no hash is known for {dialect!r}; name a split column")
    bucket = BUCKET_OF[dialect].format(column=column, n=readers, last=readers - 1)
    return [f"{bucket} = {i}" for i in range(readers)]


def read_predicates(
    cfg: TableConfig, readers: int, quantiles: Callable[[str], Sequence[object]], predicate: str | None = None
) -> list[str]:
    """One condition per reader, which together cover every row once.

    A split column is parted at its quantiles, which ``quantiles`` gets by a query,
    so readers have even shares however its values lie. Without one the first key
    is dealt by its hash. Only ``readers=1``, or a table without either, reads in one task.
    """
    if readers < 2 or not (cfg.split_by or cfg.key_names):
        parts = ["1 = 1"]
    elif cfg.split_by:
        # The last group's greatest value bounds nothing.
        parts = range_predicates(cfg.split_by, list(quantiles(quantile_query(cfg, readers, predicate)))[:-1])
    else:
        parts = hash_predicates(cfg.key_names[0], readers, cfg.dialect)
    return [f"({p}) and ({predicate})" for p in parts] if predicate else parts


def jdbc_options(cfg: TableConfig) -> dict[str, str]:
    return {**login(cfg), "dbtable": source_name(cfg), "fetchsize": str(FETCH_ROWS)}


def read_source(
    spark: SparkSession, cfg: TableConfig, predicate: str | None = None, readers: int | None = None
) -> DataFrame:
    """Unconverted source rows.

    ``jdbc:`` addresses go to the database, in even shares, one for each of
    ``readers``; any other address is a folder of parquet tables, where Spark
    pushes the predicate down.
    """
    if cfg.url.startswith("jdbc:"):
        options = jdbc_options(cfg)

        def quantiles(query: str) -> list[object]:
            found = spark.read.format("jdbc").options(**login(cfg)).option("query", query).load()
            return [r[0] for r in found.collect()]

        parts = read_predicates(cfg, readers or DEFAULT_READERS, quantiles, predicate)
        more = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=parts, properties=more)
    rows = spark.read.parquet(source_folder(cfg))
    return rows.where(F.expr(predicate)) if predicate else rows


def read_query(spark: SparkSession, cfg: TableConfig, query: str) -> DataFrame:
    """What a query of the database returns, over one connection."""
    return spark.read.format("jdbc").options(**login(cfg), query=query, fetchsize=str(FETCH_ROWS)).load()


def cdc_query(cfg: TableConfig, day: str) -> str:
    """The last change of each key on ``day`` in ``<table>_cdc``, with the base row it left, for a database."""
    keys = cfg.key_names
    columns = [f"c.key_{c.name} {c.name}" if c.name in keys else f"b.{c.name}" for c in cfg.ordered]
    logged = ", ".join(f"key_{k}" for k in keys)
    name = source_name(cfg)
    met = " and ".join(f"b.{k} = c.key_{k}" for k in keys)
    own_day = {"mysql": "date_format(cdc_ts, '%Y%m%d')"}.get(cfg.dialect, "to_char(cdc_ts, 'YYYYMMDD')")
    last = (
        f"select {logged}, cdc_type, row_number() over (partition by {logged} order by id desc) nth"
        f" from {name}_cdc where {own_day} = '{day}'"
    )
    return f"select {', '.join(columns)}, c.cdc_type from ({last}) c left join {name} b on {met} where c.nth = 1"


def day_predicate(predicate: str, day: str) -> str:
    """``predicate`` with the day for its ``%s``; other signs stay as they are."""
    return predicate.replace("%s", day)


def read_table(spark: SparkSession, cfg: TableConfig, readers: int | None = None) -> DataFrame:
    """The whole table, columns converted; only declared columns are fetched."""
    return convert_columns(read_source(spark, cfg, None, readers), cfg)


def read_increment(
    spark: SparkSession, cfg: TableConfig, predicate: str, day: str, readers: int | None = None
) -> DataFrame:
    """Rows matching ``predicate``, whose ``%s`` stands for the day."""
    return convert_columns(read_source(spark, cfg, day_predicate(predicate, day), readers), cfg)


def export_options(url: str, table: str, user: str = "", password: str = "") -> dict[str, str]:
    return {**_login(url, user, password), "dbtable": table, "batchsize": str(FETCH_ROWS)}


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str = "",
    password: str = "",
    writers: int = EXPORT_WRITERS,
    mode: str = "append",
) -> None:
    """Push rows to a database table over a fixed number of connections.

    The shuffle ahead of the write lets the query itself run wide.
    """
    options = export_options(url, table, user, password)
    df.repartition(writers).write.format("jdbc").options(**options).mode(mode).save()
