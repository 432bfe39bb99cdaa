"""Refresh a table's current and historical views from its runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from odsflow.config import TableConfig
from odsflow.functions.scalars import parse_run
from odsflow.operators import loads, runs
from odsflow.operators.latest import latest_per_key
from odsflow.operators.schema import schema_drift, stored_columns
from odsflow.sources import partitions, paths
from odsflow.streaming.intake import intake, read_taken

DATE_COLUMN = "biz_end_date"


class NotReady(RuntimeError):
    """The newest run is not yet past the cutoff."""


class SchemaChanged(RuntimeError):
    """The newest run lacks declared columns or has them with other types."""


def mount_tables(spark: SparkSession, cfg: TableConfig, history_suffix: str, location: str | None = None) -> tuple[str, str]:
    """The current and the historical table of a configuration, made where absent."""
    columns = ", ".join(f"`{c}` {t}" for c, t in stored_columns(cfg))
    names = []
    for suffix, more, part in (
        ("_curr", "", ""),
        (history_suffix, f", {DATE_COLUMN} STRING", f" PARTITIONED BY ({DATE_COLUMN})"),
    ):
        name = f"{cfg.hive_db}.{cfg.hive_table}{suffix}"
        where = f" LOCATION '{location}/{cfg.hive_table}{suffix}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}{more}) USING parquet{part}{where}")
        names.append(name)
    return names[0], names[1]


def refresh_all_data(
    spark: SparkSession, cfg: TableConfig, day: str | Sequence[str], checkpoint: str, location: str | None = None
) -> tuple[str, str]:
    """Take in staged runs; the newest of each day in ``day`` becomes that day's
    partition of the history, and that of the last day the current table. Other
    days stay.

    The intake writes each row once; both tables are pointed at the folders of
    the taken runs. Only a folder that also holds files of a failed attempt is
    copied, all such days in one job.
    """
    days = [day] if isinstance(day, str) else sorted(set(day))
    current, history = mount_tables(spark, cfg, "_all", location)
    ods = cfg.run_path(cfg.category_output)
    ddl = ", ".join(f"`{c}` {t}" for c, t in stored_columns(cfg))
    shape = T.StructType.fromDDL(ddl)
    intake(spark, cfg.run_path(cfg.category_input), ods, shape, checkpoint)
    if not days or not paths.exists(spark, ods):
        raise FileNotFoundError(f"no run of {days} has been taken")
    taken = read_taken(spark, ods, shape).where(F.col("date").isin(days) & parse_run(F.col("run")).isNotNull())
    # The sink's log, not the folders, says which files belong to a run; no column is read.
    files = taken.groupBy("date", "run").agg(F.count_distinct("_metadata.file_path").alias("n"))
    newest = {r["date"]: r for r in latest_per_key(files, ["date"], ["run"]).collect()}
    if missing := set(days) - set(newest):
        raise FileNotFoundError(f"no run of {sorted(missing)} has been taken")
    folders = {d: f"{ods}/date={d}/run={r['run']}" for d, r in newest.items()}
    mixed = [d for d, r in newest.items() if len(paths.child_files(spark, folders[d])) != r["n"]]
    whole = {((DATE_COLUMN, d),): p for d, p in folders.items() if d not in mixed}
    partitions.attach_partitions(spark, history, whole)
    if mixed:
        rows = taken.where(F.concat_ws("/", "date", "run").isin([f"{d}/{newest[d]['run']}" for d in mixed]))
        loads.load_increments(rows.drop("run").withColumnRenamed("date", DATE_COLUMN), history, DATE_COLUMN)
    last = partitions.table_details(spark, history, ((DATE_COLUMN, days[-1]),))["Location"]
    partitions.point_table(spark, current, last)
    return current, history


def check_status(status: DataFrame, cfg: TableConfig, cutoff: str) -> None:
    """Raise unless the newest run is past ``cutoff`` and holds the declared columns."""
    gate = runs.readiness(status.select(parse_run(F.col("ts")).alias("ts")), cutoff).first()
    if not gate["ready"]:
        raise NotReady(f"newest run {gate['newest']} is not after {cutoff}")
    last = latest_per_key(status.withColumn("_all", F.lit(1)), ["_all"], ["ts", "id"])
    declared = [(c.name, c.type) for c in cfg.ordered]
    wrong = schema_drift(last, declared, carry=("ts", "id")).collect()
    if wrong:
        raise SchemaChanged(", ".join(f"{r['column']}: {r['expected']} / {r['actual']}" for r in wrong))


def mount_chain(
    spark: SparkSession, cfg: TableConfig, today: str, cutoff: str, location: str | None = None
) -> tuple[str, str]:
    """Point the historical table's dates, and the current table, at their chain runs.

    Runs lie at ``<root>/<date>/<ts>_<id>``, status files in ``<root>/success``.
    """
    current, history = mount_tables(spark, cfg, "", location)
    root = cfg.run_path(cfg.category_output)
    status = runs.chain_status(spark, f"{root}/success")
    check_status(status, cfg, cutoff)
    ts, run_id = runs.run_parts(F.col("run"))
    listing = runs.list_runs(spark, root).select("date", ts.alias("ts"), run_id.alias("id"))
    mapping = runs.resolve_chain_runs(status, listing, today).withColumn(
        "path", F.concat_ws("/", F.lit(root), "partition", "run")
    )
    runs.mount_runs(spark, history, mapping, DATE_COLUMN)
    spec = ((DATE_COLUMN, runs.OPEN_PARTITION),)
    partitions.point_table(spark, current, partitions.table_details(spark, history, spec)["Location"])
    return current, history


def mount_newest(
    spark: SparkSession,
    table: str,
    root: str,
    columns: tuple[str, str] = (DATE_COLUMN, "process_start_datetime"),
) -> None:
    """Make each date's newest run folder, names compared as text, the table's only partitions.

    The table is partitioned by date and run.
    """
    newest = latest_per_key(runs.list_runs(spark, root), ["date"], ["run"]).collect()
    by_date, by_run = columns
    mapping = {((by_date, r["date"]), (by_run, r["run"])): r["path"] for r in newest}
    partitions.mount_partitions(spark, table, mapping)
