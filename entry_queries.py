"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.config import Column, TableConfig
from odsflow.functions import cleaning, scalars
from odsflow.operators import (
    audit,
    cdc,
    chain,
    chain_epochs,
    chain_table,
    diff,
    digests,
    latest,
    layouts,
    loads,
    log_store,
    runs,
    schema,
    skew,
)
from odsflow.plans import daily, mounts, repurchase, sql_jobs
from odsflow.settings import fresh_dir
from odsflow.sources import counts, delimited, files, partitions, paths, rdbms
from odsflow.streaming import chain_stream, intake

DETAIL_RANGE = ("1995-01-01", "2002-01-01")
KEYS = ["user_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new database over a new shared folder, for queries that store tables."""
    folder = fresh_dir(spark, name)
    database = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return database, folder


# Table configurations ------------------------------------------------------

ORDERS = TableConfig(
    columns=(
        Column(1, "o_orderkey", "long", True),
        Column(2, "o_custkey", "long"),
        Column(3, "o_orderstatus", "string"),
        Column(4, "o_totalprice", "double"),
        Column(5, "o_orderdate", "datetime"),
        Column(6, "o_orderpriority", "string"),
    ),
    keys=("O_ORDERKEY",),
    table="orders",
    hive_table="orders_h",
)

CUSTOMER = TableConfig(
    columns=(
        Column(2, "c_name", "string"),
        Column(1, "c_custkey", "long", True),
        Column(3, "c_nationkey", "int"),
        Column(4, "c_acctbal", "double"),
        Column(5, "c_mktsegment", "string"),
    ),
    keys=("c_custkey",),
    table="customer",
    hive_table="customer_h",
)

EVENTS = TableConfig(
    columns=(
        Column(1, "event_id", "long", True),
        Column(2, "ts", "datetime"),
        Column(3, "user_id", "long"),
        Column(4, "event_type", "string"),
        Column(5, "value", "double"),
        Column(6, "props", "string"),
    ),
    keys=("event_id",),
    table="events",
    hive_table="events_h",
)

STATES = TableConfig(
    columns=(Column(1, "user_id", "long", True), Column(2, "event_type", "string")),
    keys=("user_id",),
    hive_table="states_h",
)


def configured(cfg: TableConfig, **changes) -> TableConfig:
    return TableConfig(**{**cfg.__dict__, **changes})


# History chains -------------------------------------------------------------


def day_states(events: DataFrame) -> DataFrame:
    """Each user's last event type per day: one changed row per key and day."""
    rows = events.select("user_id", F.to_date("ts").alias("day"), "event_type", "ts", "event_id")
    last = latest.latest_per_key(rows, ["user_id", "day"], ["ts", "event_id"])
    return last.select("user_id", "event_type", scalars.day_text(F.col("day")).alias("etl_dt"))


def last_days(events: DataFrame, n: int) -> list[str]:
    days = events.select(F.to_date("ts").alias("d")).distinct().orderBy(F.desc("d")).limit(n)
    return [r.d.strftime("%Y%m%d") for r in days.collect()][::-1]


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_build(day_states(table(spark, sf_dir, "events")), KEYS, "etl_dt")


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    (day,) = last_days(events, 1)
    before = scalars.day_bounds(events, "ts", "19000101", day) & ~scalars.day_bounds(events, "ts", day)
    history = chain.chain_build(day_states(events.where(before)), KEYS, "etl_dt")
    delta = day_states(events.where(scalars.day_bounds(events, "ts", day))).drop("etl_dt")
    return chain.chain_merge(history, delta, KEYS, day)


def scd2_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored chain: bulk history, two daily merges, one day again, then a replay."""
    events = table(spark, sf_dir, "events")
    database, folder = scratch(spark, "scd2_daily")
    cfg = configured(STATES, hive_db=database)
    stored, staging = layouts.create_chain_tables(spark, cfg, folder)
    loads.load_increments(day_states(events), staging)
    first, second = last_days(events, 2)
    staged = spark.table(staging)
    chain_table.load_chain(spark, stored, chain.chain_build(staged.where(F.col("etl_dt") < first), KEYS, "etl_dt"))
    for day in (first, second, second, first, second):
        delta = spark.table(staging).where(F.col("etl_dt") == day).drop("etl_dt")
        chain_table.load_chain_day(spark, stored, delta, KEYS, day)
    return spark.table(stored)


def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored chain without two days that come late; all days from the first of them on are replayed at once."""
    events = table(spark, sf_dir, "events")
    database, folder = scratch(spark, "scd2_replay")
    cfg = configured(STATES, hive_db=database)
    stored, staging = layouts.create_chain_tables(spark, cfg, folder)
    loads.load_increments(day_states(events), staging)
    days = last_days(events, 6)
    on_time = ~F.col("etl_dt").isin(days[0], days[3])
    chain_table.load_chain(spark, stored, chain.chain_build(spark.table(staging).where(on_time), KEYS, "etl_dt"))
    chain_table.load_chain_range(spark, stored, spark.table(staging), KEYS, days[0])
    return spark.table(stored)


def scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain kept by a stream of all events, stopped half way; the second half begins with a day that is late."""
    events = table(spark, sf_dir, "events")
    database, folder = scratch(spark, "scd2_stream")
    stored, _ = layouts.create_chain_tables(spark, configured(STATES, hive_db=database), folder)
    staged = events.select("user_id", "event_type", "ts", "event_id", scalars.day_text(F.col("ts")).alias("etl_dt"))
    half = last_days(events, 15)[0]
    late = last_days(events, 18)[0]
    first = (F.col("etl_dt") < half) & (F.col("etl_dt") != late)
    for n, part in enumerate((first, ~first)):
        staged.where(part).write.parquet(f"{folder}/staged/{n}")
        chain_stream.merge_stream(
            spark, f"{folder}/staged", staged.schema, stored, KEYS, ["ts", "event_id"], f"{folder}/checkpoint"
        )
    return spark.table(stored)


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_as_of(scd2_history(spark, sf_dir), "20240115")


def scd2_as_of_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of epochs of ten days, which were refreshed after a replay of the last days."""
    events = table(spark, sf_dir, "events")
    database, folder = scratch(spark, "epochs")
    stored, staging = layouts.create_chain_tables(spark, configured(STATES, hive_db=database), folder)
    loads.load_increments(day_states(events), staging)
    days = last_days(events, 400)
    late = days[len(days) // 3 + 1]
    changes = spark.table(staging)
    chain_table.load_chain(spark, stored, chain.chain_build(changes.where(F.col("etl_dt") < late), KEYS, "etl_dt"))
    starts = days[::10]
    chain_epochs.create_epoch_table(spark, stored, f"{database}.epochs", f"{folder}/epochs")
    chain_epochs.refresh_epochs(spark, stored, f"{database}.epochs", starts)
    chain_table.load_chain_range(spark, stored, changes, KEYS, late)
    chain_epochs.refresh_epochs(spark, stored, f"{database}.epochs", starts, late)
    return chain_epochs.epoch_as_of(spark.table(f"{database}.epochs"), starts, "20240115")


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_current(scd2_history(spark, sf_dir))


def scd2_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_init(table(spark, sf_dir, "customer"), "20240101")


def scd2_init_old_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_init(table(spark, sf_dir, "customer"), "20240101", chain.OLD_CHAIN)


def _moved_customers(spark: SparkSession, sf_dir: str, buckets: int | None, limit: int | None) -> DataFrame:
    """Customers as a stored chain, then the solvent ones' new segment as a day's change."""
    database, folder = scratch(spark, "customers")
    cfg = configured(CUSTOMER, hive_db=database)
    stored, _ = layouts.create_chain_tables(spark, cfg, folder, buckets=buckets)
    customer = table(spark, sf_dir, "customer")
    chain_table.load_chain_init(customer, stored, "20240101")
    moved = customer.where(F.col("c_acctbal") > 0).withColumn("c_mktsegment", F.lit("MACHINERY"))
    chain_table.load_chain_day(spark, stored, moved, ["c_custkey"], "20240102", broadcast_limit=limit)
    return spark.table(stored)


def scd2_init_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved_customers(spark, sf_dir, None, None)


def scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a chain clustered by key, joined without a broadcast."""
    return _moved_customers(spark, sf_dir, 8, 0)


# Change logs, newest rows, comparison ----------------------------------------


def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("key_c_custkey"),
        F.col("event_type").alias("cdc_type"),
        F.col("ts").alias("cdc_ts"),
    )
    base = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return cdc.cdc_latest(log, base, ["c_custkey"], "20240101", "20240131")


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["event_id"])


def latest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest document of each language, source and length; texts are fetched for the winners only."""
    keys = ["lang", "source", "n_chars"]
    return latest.latest_stored(table(spark, sf_dir, "documents"), keys, ["doc_id"])


def _next_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers, and a later state: insolvent ones gone, one segment renamed, suppliers new."""
    old = table(spark, sf_dir, "customer")
    kept = old.where(F.col("c_acctbal") >= 0).withColumn(
        "c_mktsegment",
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")),
    )
    added = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return old, kept.unionByName(added)


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _next_customers(spark, sf_dir)
    return diff.snapshot_diff(old, new, ["c_custkey"]).select(
        "c_custkey",
        "outcome",
        F.col("old.c_mktsegment").alias("old_segment"),
        F.col("new.c_mktsegment").alias("new_segment"),
    )


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a later state, compared by stored digests: some gone, some cut, some new."""
    folder = fresh_dir(spark, "snapshots")
    old = table(spark, sf_dir, "documents")
    cut = F.when(F.col("source") == "src3", F.substring("text", 1, 100)).otherwise(F.col("text"))
    kept = old.where(F.col("n_chars") >= 50).withColumn("text", cut)
    added = table(spark, sf_dir, "benchmark").select(
        (-1 - F.col("item_id")).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"),
        F.lit("benchmark").alias("source"), F.length("text").cast(old.schema["n_chars"].dataType).alias("n_chars"),
    )
    kept.unionByName(added).write.parquet(f"{folder}/new")
    digests.row_digests(old, ["doc_id"]).write.parquet(f"{folder}/digests")
    changes = digests.snapshot_changes(
        old, spark.read.parquet(f"{folder}/new"), ["doc_id"], old_digests=spark.read.parquet(f"{folder}/digests")
    )
    return changes.select(
        "doc_id", "outcome", F.md5("old.text").alias("old_md5"), F.md5("new.text").alias("new_md5"),
        F.col("new.n_chars").alias("new_chars"),
    )


def all_columns_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _next_customers(spark, sf_dir)
    return diff.all_columns_diff(old, new)


# Loads ------------------------------------------------------------------------


def slice_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = scratch(spark, "slice_load")
    name = layouts.create_table(spark, configured(ORDERS, hive_db=database), "slice", f"{folder}/t")
    orders = table(spark, sf_dir, "orders")
    for day in ("20240101", "20240102", "20240101"):
        loads.load_slice(orders, name, day)
    return spark.table(name)


def increment_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's events in one job, then one day once more from its own rows."""
    database, folder = scratch(spark, "increment_load")
    name = layouts.create_table(spark, configured(EVENTS, hive_db=database), "append", f"{folder}/t")
    events = table(spark, sf_dir, "events")
    loads.load_increments(events.withColumn("etl_dt", scalars.day_text(F.col("ts"))), name)
    loads.load_increment(events.where(scalars.day_bounds(events, "ts", "20240110")), name, "20240110")
    return spark.table(name)


def full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = scratch(spark, "full_replace")
    cfg = configured(
        ORDERS, hive_db=database, columns=(Column(0, "etl_dt", "string"), *ORDERS.columns)
    )
    name = layouts.create_table(spark, cfg, "replace", f"{folder}/t")
    orders = table(spark, sf_dir, "orders")
    for day in ("20240101", "20240102"):
        loads.load_replace(orders, name, day)
    return spark.table(name)


def archive_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice rebuilt from its archived copy after its partition was dropped."""
    database, folder = scratch(spark, "archive_reload")
    name = layouts.create_table(spark, configured(ORDERS, hive_db=database), "slice", f"{folder}/t")
    rows = cleaning.stamp(table(spark, sf_dir, "orders"), "20240101")
    loads.archive(rows, f"{folder}/archive/20240101")
    loads.load_slice(rows, name, "20240101")
    partitions.drop_partitions(spark, name, lambda s: s["data_dt"] == "20240101")
    loads.reload_partition(spark, f"{folder}/archive/20240101", name, "20240101")
    return spark.table(name)


def layout_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each layout's table filled with all customers: its columns, key and row count."""
    database, folder = scratch(spark, "layout_tables")
    cfg = configured(CUSTOMER, hive_db=database)
    customer = table(spark, sf_dir, "customer").select(
        "*",
        *[
            F.lit(v).alias(c)
            for c, v in {
                "etl_dt": "20240101", "data_dt": "20240101", "biz_end_date": "20240101",
                "start_dt": "19000101", "end_dt": "30001231", "s_dt": "19000000", "e_dt": "30001231",
            }.items()
        ],
    )
    reports = []
    for layout, chosen in layouts.LAYOUTS.items():
        name = layouts.create_table(
            spark, cfg, layout, f"{folder}/{layout}", table=f"{database}.{layout}"
        )
        if chosen.partition:
            loads.load_increments(customer, name, chosen.partition)
        else:
            loads.load_replace(customer, name)
        filled = spark.table(name)
        reports.append(
            filled.agg(F.count("*").alias("n_rows")).select(
                F.lit(layout).alias("layout"),
                F.lit(",".join(filled.columns)).alias("columns"),
                F.lit(chosen.partition or "").alias("partition"),
                "n_rows",
            )
        )
    result = reports[0]
    for other in reports[1:]:
        result = result.unionByName(other)
    return result


def drop_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, those before the 16th dropped again; a second copy emptied altogether."""
    database, folder = scratch(spark, "drop_partitions")
    cfg = configured(EVENTS, hive_db=database)
    kept, emptied = (
        layouts.create_table(spark, cfg, "append", f"{folder}/{n}", table=f"{database}.{n}") for n in ("kept", "emptied")
    )
    events = table(spark, sf_dir, "events").withColumn("etl_dt", scalars.day_text(F.col("ts")))
    for name in (kept, emptied):
        loads.load_increments(events, name)
    partitions.drop_partitions(spark, kept, lambda s: s["etl_dt"] < "20240116")
    partitions.truncate_table(spark, emptied)
    return spark.table(kept).unionByName(spark.table(emptied))


def read_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run folder read under the declared schema of its table."""
    folder = f"{fresh_dir(spark, 'read_run')}/20240131/202401312359"
    table(spark, sf_dir, "events").write.parquet(folder)
    declared, _ = layouts.layout_schema(EVENTS, "replace")
    return files.read_run(spark, declared, folder)


def copy_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions of one table copied into another: the first by itself, the others in one job."""
    database, folder = scratch(spark, "copy_partition")
    cfg = configured(EVENTS, hive_db=database)
    source, target = (
        layouts.create_table(spark, cfg, "append", f"{folder}/{n}", table=f"{database}.{n}")
        for n in ("source", "target")
    )
    events = table(spark, sf_dir, "events")
    loads.load_increments(events.withColumn("etl_dt", scalars.day_text(F.col("ts"))), source)
    first, *others = partitions.partition_values(spark, source)
    files.copy_partition(spark, source, target, "etl_dt", first)
    files.copy_partitions(spark, source, target, "etl_dt", others)
    return spark.table(target)


# Runs ---------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "*",
        scalars.day_text(F.col("ts")).alias("biz_end_date"),
        F.date_format("ts", "yyyyMMddHH'00'").alias("run"),
    )


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_run(_runs(spark, sf_dir), "run")


def latest_run_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_run_per_date(_runs(spark, sf_dir), "biz_end_date", ["run"])


def newest_run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.newest_run_names(_runs(spark, sf_dir), "biz_end_date", "run")


def resolve_chain_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs named by hour and event id, resolved on a run day and on a later day."""
    named = _runs(spark, sf_dir).select(
        F.col("biz_end_date").alias("date"),
        F.concat("run", F.lit("00")).alias("ts"),
        F.col("event_id").alias("id"),
    )
    lines = named.select(F.concat("ts", F.lit("_"), F.col("id").cast("string")).alias("value"))
    status = runs.parse_status(lines)
    (last,) = last_days(table(spark, sf_dir, "events"), 1)
    same_day, later = (
        runs.resolve_chain_runs(status, named, today).withColumn("resolved", F.lit(when))
        for today, when in ((last, "run day"), ("20991231", "later"))
    )
    return same_day.unionByName(later)


def _stage_halves(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Events staged as two runs a day, each in its own folder."""
    morning = F.when(F.hour("ts") < 12, "0000").otherwise("1200")
    events = table(spark, sf_dir, "events").select(
        "*",
        scalars.day_text(F.col("ts")).alias("date"),
        F.concat(scalars.day_text(F.col("ts")), morning).alias("run"),
    )
    events.hint("rebalance", F.col("date"), F.col("run")).write.partitionBy("date", "run").parquet(folder)


def mount_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose partitions are each date's newest run folder."""
    database, folder = scratch(spark, "mount_runs")
    _stage_halves(spark, sf_dir, f"{folder}/staged")
    name = layouts.create_table(spark, configured(EVENTS, hive_db=database), "base", f"{folder}/t")
    newest = latest.latest_per_key(runs.list_runs(spark, f"{folder}/staged"), ["date"], ["run"])
    runs.mount_runs(spark, name, newest.withColumnRenamed("date", "partition"), "biz_end_date")
    return spark.table(name)


def intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged runs taken in by a stream; the second start finds nothing new."""
    folder = fresh_dir(spark, "intake_stream")
    _stage_halves(spark, sf_dir, f"{folder}/staged")
    shape = table(spark, sf_dir, "events").schema
    for _ in range(2):
        intake.intake(spark, f"{folder}/staged", f"{folder}/ods", shape, f"{folder}/checkpoint")
    return intake.read_taken(spark, f"{folder}/ods", shape)


def mount_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs mounted by date and run name."""
    database, folder = scratch(spark, "mount_newest")
    _stage_halves(spark, sf_dir, f"{folder}/staged")
    columns = ", ".join(f"{c} {t}" for c, t in schema.stored_columns(EVENTS))
    spark.sql(
        f"CREATE TABLE {database}.t ({columns}, biz_end_date STRING, process_start_datetime STRING) USING parquet"
        f" PARTITIONED BY (biz_end_date, process_start_datetime) LOCATION '{folder}/t'"
    )
    mounts.mount_newest(spark, f"{database}.t", f"{folder}/staged")
    return spark.table(f"{database}.t")


def chain_mount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain runs by date with a status file, mounted as history and current table.

    Each day has an early and a late run; the open partition holds all events.
    """
    database, folder = scratch(spark, "chain_mount")
    cfg = configured(EVENTS, hive_db=database, source_root=folder, category_output="out", hive_table="events")
    root = cfg.run_path(cfg.category_output)
    events = table(spark, sf_dir, "events")
    (last,) = last_days(events, 1)
    half = F.when(F.hour("ts") < 12, "060000_9").otherwise("060000_10")
    named = events.select(
        "*", scalars.day_text(F.col("ts")).alias("date"), F.concat(scalars.day_text(F.col("ts")), half).alias("run")
    )
    named.hint("rebalance", F.col("date"), F.col("run")).write.partitionBy("date", "run").parquet(f"{folder}/staged")
    for run in runs.list_runs(spark, f"{folder}/staged").collect():
        paths.rename(spark, run.path, f"{root}/{run.date}/{run.run}")
    events.write.parquet(f"{root}/20991231/{last}060000_11")
    declared = ", ".join(f'{{"name":"{c.name}","type":"{c.type}"}}' for c in cfg.columns)
    line = f'{last}060000_11\t{{"columns":[{declared}]}}'
    spark.range(1).select(F.lit(line)).write.text(f"{folder}/lines")
    for n, part in enumerate(paths.child_files(spark, f"{folder}/lines")):
        paths.rename(spark, f"{folder}/lines/{part}", f"{root}/success/{last}060000_{n}.txt")
    current, history = mounts.mount_chain(spark, cfg, "20991231", "2024-01-01 00:00:00", folder)
    return spark.table(history).unionByName(
        spark.table(current).withColumn("biz_end_date", F.lit("current"))
    )


def all_data_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events staged as two runs a day; each date's newest one becomes its partition."""
    database, folder = scratch(spark, "all_data")
    cfg = configured(
        EVENTS, hive_db=database, source_root=folder, category_input="stg", category_output="out", hive_table="events"
    )
    _stage_halves(spark, sf_dir, cfg.run_path("stg"))
    days = table(spark, sf_dir, "events").select(scalars.day_text(F.col("ts")).alias("day")).distinct()
    days = [row.day for row in days.collect()]
    current, history = mounts.refresh_all_data(spark, cfg, days, f"{folder}/checkpoint", folder)
    return spark.table(history).unionByName(
        spark.table(current).withColumn("biz_end_date", F.lit("current"))
    )


def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return runs.readiness(events, "2024-01-30 23:30:00", ["event_type"])


# Audit ----------------------------------------------------------------------------


def _per_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("data_date")).agg(
        F.count("*").alias("n_rows")
    )


def _log_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit("shop").alias("db_name"),
        F.lit("orders").alias("table_name"),
        "data_date",
        scalars.parse_run_time(F.lit("20240101 06:00:00")).alias("run_time"),
        "n_rows",
    )


def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted by month from the footers of their partitions."""
    database, folder = scratch(spark, "counts")
    name = layouts.create_table(spark, configured(ORDERS, hive_db=database), "append", f"{folder}/t")
    month = F.date_format("o_orderdate", "yyyyMM")
    loads.load_increments(table(spark, sf_dir, "orders").withColumn("etl_dt", month), name)
    years = sorted({v[:4] for v in partitions.partition_values(spark, name)})
    found = [(y, counts.stored_count(spark, name, lambda s, y=y: s["etl_dt"].startswith(y))) for y in years]
    found.append(("all", counts.source_count(spark, configured(ORDERS, url=f"parquet:{sf_dir}"))))
    return spark.createDataFrame(found, "year string, n_rows long")


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return audit.row_count(events, "event_type = 'click'")


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day against those not pending, and those that remain later."""
    orders = table(spark, sf_dir, "orders").withColumn("data_dt", scalars.day_text(F.col("o_orderdate")))
    target = orders.where(F.col("o_orderstatus") != "P")
    after = orders.where(F.col("o_totalprice") > 100000)
    return audit.reconcile(orders, target, after, ["data_dt"])


def etl_log_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full log, then a new first count on some days and later rounds on others."""
    orders = table(spark, sf_dir, "orders")
    start = _log_rows(_per_day(orders))
    log = start.select(
        *audit.LOG_KEYS, *[(F.col("n_rows") + i).alias(c) for i, c in enumerate(audit.LOG_COUNTS)]
    )
    rerun = _log_rows(_per_day(orders.where(F.col("o_orderstatus") == "P")))
    loaded = _log_rows(_per_day(orders.where(F.col("o_orderpriority") == "1-URGENT")))
    again = _log_rows(_per_day(orders.where(F.col("o_totalprice") > 400000)))
    log = audit.write_log(log, rerun, "source_before")
    log = audit.write_log(log, loaded, "target")
    return audit.write_log(log, again, "source_after")


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as completion reports: a day's later ones replace what the log has of the morning."""
    reports = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("sys"),
        F.col("user_id").alias("step"),
        scalars.day_text(F.col("ts")).alias("data_dt"),
        F.col("ts").alias("complete_time"),
    )
    morning = F.hour("complete_time") < 12
    log = audit.batch_complete(reports.where(F.lit(False)), reports.where(morning))
    return audit.batch_complete(log, reports.where(~morning))


def stored_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log of all days' orders, written in rounds, some again, and compacted on the way."""
    root = fresh_dir(spark, "load_log")
    orders = table(spark, sf_dir, "orders")
    pending, urgent = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT"
    for n, (round_name, where) in enumerate(
        (
            ("source_before", F.lit(True)), ("target", ~pending), ("source_after", F.lit(True)), ("source_before", pending),
            ("target", urgent), ("source_after", F.col("o_totalprice") > 400000),
        )
    ):
        log_store.write_round(_log_rows(_per_day(orders.where(where))), root, round_name)
        if n in (1, 4):
            log_store.compact(spark, root, log_store.LOADS)
    return log_store.read_loads(spark, root)


def stored_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as completion reports, each user's last one of a half day per write, read back after a compaction."""
    root = fresh_dir(spark, "batch_log")
    reports = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("sys"),
        F.col("user_id").cast("string").alias("step"),
        scalars.day_text(F.col("ts")).alias("data_dt"),
        F.col("ts").alias("complete_time"),
    )
    late = F.hour("complete_time") >= 12
    for part in (~late, late):
        log_store.append(audit.batch_complete(reports.where(F.lit(False)), reports.where(part)), root, log_store.BATCHES)
        log_store.compact(spark, root, log_store.BATCHES)
    return log_store.read_batches(spark, root)


def audited_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = scratch(spark, "audited_load")
    name = layouts.create_table(spark, configured(ORDERS, hive_db=database), "slice", f"{folder}/t")
    orders = table(spark, sf_dir, "orders")
    return audit.audited(
        spark, "shop", "orders", "20240101",
        source=lambda: orders,
        load=lambda: loads.load_slice(orders, name, "20240101"),
        target=lambda: spark.table(name).where(audit.slice_condition("20240101")),
        run_time="20240101 06:00:00",
    )


def _earlier_orders(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """A source as it was before 2001-01-01's changes: urgent orders since then are
    not there yet, and high ones have another status."""
    late = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders").where(~(late & (F.col("o_orderpriority") == "1-URGENT")))
    moved = late & (F.col("o_orderpriority") == "2-HIGH")
    earlier = orders.withColumn("o_orderstatus", F.when(moved, "X").otherwise(F.col("o_orderstatus")))
    earlier.write.parquet(f"{folder}/before/orders.parquet")
    return f"parquet:{folder}/before"


_RECENT, _MOMENT = "o_orderdate >= to_timestamp_ntz('%s', 'yyyyMMdd')", "20240101 06:00:00"


def _chain_runs(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, list[DataFrame]]:
    """A chain made from the earlier source, then the day's run on the present one."""
    database, folder = scratch(spark, name)
    cfg = configured(
        ORDERS, hive_db=database, hive_table="chain_h", path_table="chain", url=f"parquet:{sf_dir}",
        source_root=folder, category_input="stg",
    )
    chain_name = layouts.create_table(spark, cfg, "chain", f"{folder}/chain")
    layouts.create_table(spark, cfg, "staging", f"{folder}/staging")
    before = configured(cfg, url=_earlier_orders(spark, sf_dir, folder))
    first = daily.run_chain_init(spark, before, "20001231", _MOMENT)
    return chain_name, [first, daily.run_chain(spark, cfg, _RECENT, "20010101", _MOMENT)]


def daily_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain after a day's run that finds new, changed and unchanged orders."""
    name, _ = _chain_runs(spark, sf_dir, "daily_chain")
    return spark.table(name).drop("etl_dt")


def staged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of runs that load what an import kept before, and of an append table's first full load."""
    database, folder = scratch(spark, "staged_runs")
    cfg = configured(ORDERS, hive_db=database, url=f"parquet:{sf_dir}", source_root=folder, category_input="stg")
    result = None
    for layout, imported, run in (
        ("append", _RECENT, lambda c: daily.run_increment(spark, c, _RECENT, "19980101", _MOMENT, staged=True)),
        ("staging", _RECENT, lambda c: daily.run_staging(spark, c, _RECENT, "19980101", _MOMENT, staged=True)),
        ("replace", None, lambda c: daily.run_replace(spark, c, "19980101", _MOMENT, staged=True)),
        ("base", None, lambda c: daily.run_slice(spark, c, "19980101", _MOMENT, staged=True, layout="base")),
        ("append_init", None, lambda c: daily.run_increment_init(spark, c, "19980101", _MOMENT)),
    ):
        own = configured(cfg, hive_table=f"{layout}_h", path_table=layout)
        kind = layout.removesuffix("_init")
        name = layouts.create_table(spark, own, kind, f"{folder}/{layout}")
        if layout != "append_init":
            daily.import_day(spark, own, kind, "19980101", imported)
        log = run(own).select(F.lit(layout).alias("layout"), *audit.LOG_COUNTS)
        total = spark.table(name).agg(F.sum("o_orderkey").alias("keys"))
        log = log.withColumn("keys", total.scalar())
        result = log if result is None else result.unionByName(log)
    return result


def daily_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's run over a change log of customers: events as changes, and customers who have money as the base."""
    database, folder = scratch(spark, "daily_cdc")
    table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0).write.parquet(f"{folder}/src/customer.parquet")
    table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("key_c_custkey"), F.col("event_type").alias("cdc_type"),
        F.col("ts").alias("cdc_ts"),
    ).write.parquet(f"{folder}/src/customer_cdc.parquet")
    cfg = configured(CUSTOMER, hive_db=database, url=f"parquet:{folder}/src", use_chain=False)
    name = layouts.create_table(spark, cfg, "append", f"{folder}/t")
    log = daily.run_cdc(spark, cfg, "20240110", _MOMENT).first()
    counted = [F.lit(log[c]).cast("long").alias(c) for c in audit.LOG_COUNTS]
    return spark.table(name).select("*", *counted)


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-log rows of each strategy's run over all orders, end to end."""
    database, folder = scratch(spark, "daily_runs")
    cfg = configured(ORDERS, hive_db=database, url=f"parquet:{sf_dir}", source_root=folder, category_input="stg")
    result = None
    for layout, run in (
        ("slice", lambda c: [daily.run_slice(spark, c, "20240101", _MOMENT)]),
        ("append", lambda c: [daily.run_increment(spark, c, _RECENT, "19980101", _MOMENT)]),
        ("replace", lambda c: [daily.run_replace(spark, c, "20240101", _MOMENT)]),
        ("chain", lambda _: _chain_runs(spark, sf_dir, "daily_runs_chain")[1]),
    ):
        own = configured(cfg, hive_table=f"{layout}_h", path_table=layout)
        if layout != "chain":
            layouts.create_table(spark, own, layout, f"{folder}/{layout}")
        for log in run(own):
            log = log.withColumn("layout", F.lit(layout))
            result = log if result is None else result.unionByName(log)
    return result.drop("db_name")


# Columns and schemas -----------------------------------------------------------------


def _converted(**types: str) -> TableConfig:
    return configured(
        ORDERS,
        columns=tuple(
            Column(c.columnid, c.name, types.get(c.name, c.type), c.primary_key) for c in ORDERS.columns
        ),
    )


def convert_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = configured(_converted(o_orderpriority="clob", o_custkey="tinyint"), url="jdbc:mysql://db:3306/shop")
    return schema.convert_columns(table(spark, sf_dir, "orders"), cfg)


def convert_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = configured(_converted(o_orderkey="rowid", o_orderpriority="raw"), url="jdbc:oracle://db:1521/shop")
    return schema.convert_columns(table(spark, sf_dir, "orders"), cfg)


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arriving as text, put into declared order and types."""
    text = table(spark, sf_dir, "orders").select(
        F.lit("u").alias("cdc_type"), *[F.col(c.name).cast("string").alias(c.name) for c in ORDERS.columns]
    )
    cfg = configured(
        ORDERS, use_chain=False, overrides={"o_totalprice": "DECIMAL(18,2)", "o_orderdate": "DATE"}
    )
    return schema.conform(text, cfg)


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdbms.read_table(spark, configured(_converted(o_orderpriority="blob"), url=f"parquet:{sf_dir}"))


def read_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = configured(ORDERS, url=f"parquet:{sf_dir}")
    return rdbms.read_increment(spark, cfg, "o_orderdate >= timestamp_ntz'%s'", "1998-01-01 00:00:00")


def drop_delims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_delims(table(spark, sf_dir, "documents"))


def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON fingerprints, with a null where the priority is low."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    cols = ["o_orderkey", "o_custkey", "priority", "price"]
    joined = cleaning.joined_md5([F.col("o_orderkey"), F.col("o_custkey"), F.col("price")])
    return rows.select("o_orderkey", cleaning.row_md5(cols).alias("json_md5"), joined.alias("joined_md5"))


def base64_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "documents").select(
        "doc_id", "text", scalars.b64_encode(F.col("text")).alias("encoded")
    )
    return text.select("doc_id", "encoded", scalars.b64_decode(F.col("encoded")).alias("decoded"))


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_type")
    run_name = F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("_"), F.col("event_id").cast("string"))
    run_ts, run_id = scalars.run_parts(F.concat(F.lit("/ods/t/"), run_name, F.lit(".ok")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.zero_if_null(F.when(kind != "error", F.col("user_id"))).alias("zeroed"),
        scalars.shop_flag(F.col("user_id")).alias("shop"),
        scalars.platform_class(F.col("user_id")).alias("platform"),
        scalars.day_text(ts).alias("day"),
        scalars.second_text(ts).alias("second"),
        scalars.parse_day(scalars.day_text(ts)).alias("parsed_day"),
        scalars.parse_run(F.when(kind == "view", "x").otherwise(F.date_format(ts, "yyyyMMddHHmm"))).alias("run"),
        run_ts.alias("run_ts"),
        run_id.alias("run_id"),
        scalars.path_tail(F.concat(F.lit("/a/"), kind, F.lit("/")), 1).alias("tail"),
    )


def conform_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text under a wrong declaration: which columns would lose how many values?"""
    text = table(spark, sf_dir, "orders").select(*[F.col(c.name).cast("string").alias(c.name) for c in ORDERS.columns])
    return schema.conform_losses(text, _converted(o_orderpriority="int", o_orderkey="int", o_orderstatus="date"))


def lost_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as delimited lines whose texts still hold line breaks: fields that are missing or do not parse."""
    folder = fresh_dir(spark, "lost_fields")
    docs = table(spark, sf_dir, "documents")
    delimited.to_lines(docs.select("doc_id", "lang", "n_chars", F.translate("text", "\r\u0001", "").alias("text"), "source")).write.text(folder)
    lines = spark.read.option("lineSep", "\n").text(folder)
    shape = docs.select("doc_id", "lang", "n_chars", "text", "source").schema
    return delimited.lost_fields(lines, shape)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly runs record the event types they saw; which declared ones lack or differ?"""
    seen = _runs(spark, sf_dir).groupBy("run").agg(F.sort_array(F.collect_set("event_type")).alias("kinds"))
    fields = F.transform(
        "kinds", lambda k: F.struct(k.alias("name"), F.lit("double").alias("type"))
    )
    status = seen.select("run", F.to_json(F.struct(fields.alias("columns"))).alias("schema_json"))
    expected = [("click", "double"), ("error", "double"), ("purchase", "int"), ("signup", "double"), ("view", "double")]
    return schema.schema_drift(status, expected)


# Text edges ---------------------------------------------------------------------------


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "delimited")
    clean = cleaning.drop_delims(table(spark, sf_dir, "documents")).withColumn(
        "lang", F.when(F.col("lang") != "en", F.col("lang"))
    )
    delimited.write_delimited(clean, folder)
    return delimited.read_delimited(spark, folder, clean.schema)


def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported by a query of a date, read back once every part has its checksum."""
    folder = fresh_dir(spark, "export")
    table(spark, sf_dir, "orders").createOrReplaceTempView("export_orders")
    data, sums = files.export_query(
        spark,
        "SELECT * FROM export_orders WHERE o_orderdate < to_timestamp_ntz(:date, 'yyyyMMdd')",
        folder, "20020101", "shop", "orders", part_bytes=2**20,
    )
    if not files.verify_export(spark, data, sums).where(~F.col("intact")).isEmpty():
        raise ValueError("a part lost its checksum")
    return delimited.read_delimited(spark, data, spark.table("export_orders").schema)


# SQL jobs -------------------------------------------------------------------------------


def sql_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three named steps, each stored once and read by the next."""
    table(spark, sf_dir, "events").createOrReplaceTempView("step_events")
    steps = [
        ("step_user_day", "SELECT user_id, date_format(ts, 'yyyyMMdd') AS day, count(*) AS n FROM step_events"
                          " WHERE event_type <> :skip GROUP BY user_id, date_format(ts, 'yyyyMMdd')"),
        ("step_user", "SELECT user_id, count(*) AS days, sum(n) AS events FROM step_user_day GROUP BY user_id"),
        ("step_days", "SELECT days, count(*) AS users, sum(events) AS events FROM step_user GROUP BY days"),
    ]
    done = sql_jobs.run_steps(spark, steps, {"skip": "error"}, fresh_dir(spark, "steps"))
    return done["step_days"]


def sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL file with comments, several statements and three kinds of variables."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("file_orders")
    text = (
        "-- orders per status; from a given day\n"
        "CREATE OR REPLACE TEMPORARY VIEW file_recent AS\n"
        "SELECT * FROM file_orders WHERE o_orderdate >= timestamp_ntz'${hiveconf:first_day}';\n"
        "/* ';' inside text does not end a statement */\n"
        "SELECT o_orderstatus, ';' AS mark, count(*) AS n FROM IDENTIFIER(:source)\n"
        "WHERE o_orderpriority <> :skip GROUP BY o_orderstatus;\n"
    )
    folder = fresh_dir(spark, "sql_file")
    spark.range(1).select(F.lit(text)).write.text(folder)
    return sql_jobs.run_sql_file(
        spark, folder, {"first_day": "1996-01-01", "source": "file_recent", "skip": "5-LOW"}
    )


# Repurchase ------------------------------------------------------------------------------


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return skew.split_join(line, table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.col("o_orderkey").alias("parent_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("l_returnflag").alias("cust_type"),
        F.col("l_linestatus").alias("order_type"),
        F.when(F.col("l_quantity") < 50, F.col("l_quantity").cast("int")).alias("allot_quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("bargin_price"),
        F.lit(1).alias("receiver_country_id"),
        F.col("l_linenumber").alias("receiver_province_id"),
        F.col("l_partkey").alias("receiver_city_id"),
        F.when(F.col("l_suppkey") % 3 > 0, F.col("l_suppkey")).alias("shop_id"),
        F.col("o_orderpriority").alias("order_source"),
        (F.col("l_suppkey") * 2).alias("from_platform"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_creation_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("send_date"),
        F.col("o_orderdate").alias("data_date"),
    )


def _products_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"))


def _product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat("p_type", F.lit("/"), "p_brand").alias("category_path"),
        F.col("p_type").alias("category_path2"),
        F.col("p_type").alias("path2_name"),
        F.col("p_brand").alias("category_path3"),
        F.col("p_name").alias("path3_name"),
        F.when(F.col("p_size") < 40, F.col("p_size")).alias("bd_id"),
    )


def clean_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _products_of_lines(spark, sf_dir)
    return repurchase.clean_detail(_detail(spark, sf_dir), _product(spark, sf_dir), *DETAIL_RANGE, sampled=products)


def _repurchase(start: str, end: str, bds) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return repurchase.repurchase(
            _detail(spark, sf_dir), _product(spark, sf_dir), DETAIL_RANGE, (start, end), bds, _products_of_lines(spark, sf_dir)
        )

    return run


def repurchase_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both windows as stored steps out of one clean detail."""
    windows = {name: REPURCHASE[name][:2] for name in ("repurchase_60", "repurchase_90")}
    steps = repurchase.repurchase_job(
        _detail(spark, sf_dir), _product(spark, sf_dir), DETAIL_RANGE, windows, REPURCHASE["repurchase_60"][2],
        fresh_dir(spark, "repurchase"), _products_of_lines(spark, sf_dir),
    )
    first, second = (steps[n].withColumn("window", F.lit(n)) for n in windows)
    return first.unionByName(second)


REPURCHASE = {
    "repurchase_60": ("2001-05-01", "2001-07-01", (1, 16, 4, 9)),
    "repurchase_90": ("2001-04-01", "2001-07-01", (1, 16, 4, 9)),
    "repurchase_full": ("1995-01-01", "2002-01-01", tuple(range(1, 40))),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scd2_history, scd2_merge, scd2_daily, scd2_replay, scd2_stream, scd2_as_of, scd2_as_of_epochs, scd2_current, scd2_init,
        scd2_init_old_layout, scd2_init_stored, scd2_bucketed, cdc_latest, latest_event,
        latest_document, snapshot_diff, snapshot_changes, all_columns_diff, slice_load, increment_load, full_replace, archive_reload,
        layout_tables, drop_partitions, read_run, copy_partition, latest_run, latest_run_per_date, newest_run_names,
        resolve_chain_runs, mount_runs, mount_newest, chain_mount, intake_stream, all_data_refresh, readiness, row_counts, stored_counts,
        reconcile_counts, etl_log_upsert, batch_log,
        stored_load_log, stored_batch_log, audited_load, daily_runs, daily_chain,
        staged_runs, daily_cdc, convert_mysql,
        convert_oracle, conform_schema, read_table, read_increment, drop_delims,
        row_fingerprint, base64_text, scalar_functions, schema_drift, conform_losses, lost_fields, delimited_roundtrip,
        export_manifest, sql_steps, sql_file, clean_detail, repurchase_job,
    )
}
QUERIES.update({name: _repurchase(*args) for name, args in REPURCHASE.items()})
