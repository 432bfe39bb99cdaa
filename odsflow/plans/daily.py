"""A table's daily run, end to end: read, convert, clean, load, count.

Each run returns its load-log row, and leaves it in the stored logs under ``log``
where that is given. Where the configuration names a source
root, the cleaned rows are first kept under ``<root>/<input>/.../<day>/<layout>`` and
loaded from there, so the source is read once and a day can be rebuilt later.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from odsflow.config import TableConfig
from odsflow.functions.cleaning import drop_delims
from odsflow.functions.scalars import day_bounds
from odsflow.operators import audit, chain_table, loads, log_store
from odsflow.operators.cdc import cdc_latest
from odsflow.operators.chain import chain_as_of
from odsflow.operators.layouts import LAYOUTS, table_name
from odsflow.operators.schema import conform, convert_columns
from odsflow.sources.counts import source_count, stored_count
from odsflow.sources.rdbms import cdc_query, day_predicate, read_increment, read_query, read_source, read_table


def _prepared(source: Callable[[], DataFrame], cfg: TableConfig, layout: str, day: str, staged: bool = False) -> DataFrame:
    """The day's rows to load; with ``staged``, those of the last copy that was kept, without the source."""
    if staged:
        spark = SparkSession.active()
        return conform(spark.read.parquet(loads.newest_archive(spark, archive_path(cfg, day, layout))), cfg, LAYOUTS[layout].binary_blob)
    rows = conform(drop_delims(source()), cfg, LAYOUTS[layout].binary_blob)
    if not cfg.source_root:
        return rows
    kept = loads.archive(rows, archive_path(cfg, day, layout))
    return rows.sparkSession.read.schema(rows.schema).parquet(kept)


def archive_path(cfg: TableConfig, day: str, layout: str) -> str:
    """Where the day's raw loads of a layout are kept, one folder each."""
    return cfg.run_path(cfg.category_input, day, layout)


def _logged(
    spark: SparkSession,
    cfg: TableConfig,
    day: str,
    source: Callable[[], DataFrame | int],
    load: Callable[[], object],
    target: Callable[[], DataFrame | int],
    run_time: str | None,
    log: str | None,
    step: str,
) -> DataFrame:
    """The run's load-log row; with ``log``, every count goes into the stored load
    log there as it is taken, and the finished run into its completion log."""
    database = cfg.url.rstrip("/").split("/")[-1]
    write = (lambda name, row: log_store.write_round(row, log, name)) if log else None
    row = audit.audited(spark, database, cfg.table, day, source, load, target, run_time, write)
    if log:
        log_store.complete(spark, log, database, [f"{step}:{cfg.table}"], day)
    return row


def import_day(
    spark: SparkSession, cfg: TableConfig, layout: str, day: str, predicate: str | None = None
) -> str:
    """Only keep a copy of the day's source rows, for a run with ``staged`` to load; returns its folder."""
    source = read_increment(spark, cfg, predicate, day) if predicate else read_table(spark, cfg)
    return loads.archive(conform(drop_delims(source), cfg, LAYOUTS[layout].binary_blob), archive_path(cfg, day, layout))


def run_slice(
    spark: SparkSession,
    cfg: TableConfig,
    day: str,
    run_time: str | None = None,
    log: str | None = None,
    staged: bool = False,
    layout: str = "slice",
) -> DataFrame:
    """The whole source as the day's slice; ``layout="base"`` loads the older one, by business date and without a stamp."""
    table, part = table_name(cfg, layout), LAYOUTS[layout].partition
    stamp_col = "etl_dt" if "etl_dt" in LAYOUTS[layout].lead else None
    return _logged(
        spark, cfg, day,
        source=lambda: source_count(spark, cfg),
        load=lambda: loads.load_slice(
            _prepared(lambda: read_table(spark, cfg), cfg, layout, day, staged), table, day, part, stamp_col
        ),
        target=lambda: stored_count(spark, table, lambda s: s[part] == day),
        run_time=run_time, log=log, step="slice",
    )


def _run_partition(
    spark: SparkSession, cfg: TableConfig, layout: str, step: str, predicate: str | None, day: str,
    run_time: str | None, log: str | None, staged: bool,
) -> DataFrame:
    """Source rows, those of the day's predicate where there is one, as the day's load partition."""
    table = table_name(cfg, layout)
    own = day_predicate(predicate, day) if predicate else None

    def source() -> DataFrame:
        return read_increment(spark, cfg, predicate, day) if predicate else read_table(spark, cfg)

    return _logged(
        spark, cfg, day,
        source=lambda: source_count(spark, cfg, own),
        load=lambda: loads.load_increment(_prepared(source, cfg, layout, day, staged), table, day),
        target=lambda: stored_count(spark, table, lambda s: s["etl_dt"] == day),
        run_time=run_time, log=log, step=step,
    )


def run_increment(
    spark: SparkSession, cfg: TableConfig, predicate: str, day: str, run_time: str | None = None,
    log: str | None = None, staged: bool = False,
) -> DataFrame:
    """The rows matching the day's predicate as the day's partition; both sides count these only."""
    return _run_partition(spark, cfg, "append", "append", predicate, day, run_time, log, staged)


def run_increment_init(
    spark: SparkSession, cfg: TableConfig, day: str, run_time: str | None = None, log: str | None = None, staged: bool = False
) -> DataFrame:
    """An append table's first load: the whole source as the partition of ``day``."""
    return _run_partition(spark, cfg, "append", "append_init", None, day, run_time, log, staged)


def run_staging(
    spark: SparkSession, cfg: TableConfig, predicate: str, day: str, run_time: str | None = None,
    log: str | None = None, staged: bool = False,
) -> DataFrame:
    """The day's changed rows into a chain's staging only; the merge is a run of its own."""
    return _run_partition(spark, cfg, "staging", "staging", predicate, day, run_time, log, staged)


def run_replace(
    spark: SparkSession, cfg: TableConfig, day: str, run_time: str | None = None, log: str | None = None, staged: bool = False
) -> DataFrame:
    """The whole source instead of the table's content."""
    table = table_name(cfg, "replace")
    return _logged(
        spark, cfg, day,
        source=lambda: source_count(spark, cfg),
        load=lambda: loads.load_replace(_prepared(lambda: read_table(spark, cfg), cfg, "replace", day, staged), table),
        target=lambda: stored_count(spark, table),
        run_time=run_time, log=log, step="replace",
    )


def run_cdc(
    spark: SparkSession, cfg: TableConfig, day: str, run_time: str | None = None, log: str | None = None, staged: bool = False
) -> DataFrame:
    """The last image of every key that changed on ``day``, with its kind of change, as the day's partition.

    The changes are read from ``<table>_cdc``, of which both sides count keys. A
    database reduces the log and joins the base itself.
    """
    table = table_name(cfg, "append")
    plain = replace(cfg, use_chain=True)

    def images() -> DataFrame:
        if cfg.url.startswith("jdbc:"):
            return read_query(spark, cfg, cdc_query(cfg, day))
        events = read_source(spark, replace(cfg, table=f"{cfg.table}_cdc"))
        base = convert_columns(read_source(spark, cfg), plain)
        return cdc_latest(events, base, cfg.key_names, day)

    def keys() -> int:
        if cfg.url.startswith("jdbc:"):
            return int(read_query(spark, cfg, f"select count(*) n from ({cdc_query(cfg, day)}) t").first()[0])
        events = read_source(spark, replace(cfg, table=f"{cfg.table}_cdc"))
        own = events.where(day_bounds(events, "cdc_ts", day))
        return own.select(*[f"key_{k}" for k in cfg.key_names]).distinct().count()

    return _logged(
        spark, cfg, day,
        source=keys,
        load=lambda: loads.load_increment(_prepared(images, cfg, "append", day, staged), table, day),
        target=lambda: stored_count(spark, table, lambda s: s["etl_dt"] == day),
        run_time=run_time, log=log, step="cdc",
    )


def run_chain_init(spark: SparkSession, cfg: TableConfig, day: str, run_time: str | None = None, log: str | None = None) -> DataFrame:
    """The whole source as the chain's first open versions."""
    table = table_name(cfg, "chain")
    return _logged(
        spark, cfg, day,
        source=lambda: source_count(spark, cfg),
        load=lambda: chain_table.load_chain_init(
            conform(drop_delims(read_table(spark, cfg)), cfg), table, day, keys=cfg.key_names
        ),
        target=lambda: chain_as_of(spark.table(table), day),
        run_time=run_time, log=log, step="chain_init",
    )


def run_chain(
    spark: SparkSession, cfg: TableConfig, predicate: str, day: str, run_time: str | None = None, log: str | None = None
) -> DataFrame:
    """The day's changed rows into staging, then merged into the chain.

    The log compares the whole source with the versions valid on the day.
    """
    chain, staging = table_name(cfg, "chain"), table_name(cfg, "staging")

    def load() -> None:
        changed = _prepared(lambda: read_increment(spark, cfg, predicate, day), cfg, "staging", day)
        loads.load_increment(changed, staging, day)
        delta = spark.table(staging).where(audit.slice_condition(day, "etl_dt"))
        chain_table.load_chain_day(spark, chain, delta, cfg.key_names, day)

    return _logged(
        spark, cfg, day,
        source=lambda: source_count(spark, cfg),
        load=load,
        target=lambda: chain_as_of(spark.table(chain), day),
        run_time=run_time, log=log, step="chain",
    )


def reload_slice(spark: SparkSession, cfg: TableConfig, day: str) -> None:
    """Rebuild a day's slice from its kept copy, without the source."""
    rows = spark.read.parquet(loads.newest_archive(spark, archive_path(cfg, day, "slice")))
    loads.load_slice(rows, table_name(cfg, "slice"), day)
