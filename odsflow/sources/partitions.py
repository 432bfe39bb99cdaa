"""Partitions of catalog tables: list, attach, drop, empty.

A load writes its rows into a fresh run folder and then points the partition
at that folder. Readers see the old rows or the new ones, a failed load leaves
the table as it was, and nothing is copied a second time.

A run belongs to the table that it lies beside, and other tables may read it too.
Beside the runs is a list of those, ``<home>_runs/_readers/<run>/<table>``: a
table's name is put there before the table is pointed at another one's run, and a
run is deleted only when its own table has left it and its list is empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.sources import paths

_ADD_AT_ONCE = 1000

Spec = tuple[tuple[str, str], ...]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clause(spec: Spec) -> str:
    return "PARTITION (" + ", ".join(f"`{c}` = {_literal(v)}" for c, v in spec) + ")"


def partition_specs(spark: SparkSession, table: str) -> list[Spec]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [
        tuple((part.split("=", 1)[0], unquote(part.split("=", 1)[1])) for part in r.partition.split("/"))
        for r in rows
    ]


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """Values of the first partition column."""
    return sorted({spec[0][1] for spec in partition_specs(spark, table)})


def table_details(spark: SparkSession, table: str, spec: Spec | None = None) -> dict[str, str]:
    """Properties of a table, or of one of its partitions."""
    clause = " " + _clause(spec) if spec else ""
    found: dict[str, str] = {}
    detailed = False
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}{clause}").collect():
        detailed = detailed or row["col_name"].startswith("# Detailed")
        if detailed:
            # A partition's own entries stand before those of its table.
            found.setdefault(row["col_name"], row["data_type"])
    return found


def table_location(spark: SparkSession, table: str) -> str:
    return table_details(spark, table)["Location"].rstrip("/")


_RUNS = "_runs/"
# Properties of a table that reads another one's runs: its own home, and where it has read.
_HOME, _ABROAD = "odsflow.home", "odsflow.abroad"


def run_of(path: str) -> tuple[str, str] | None:
    """(home, run) of a folder inside a run; None for a folder that is no load's."""
    home, found, rest = path.rstrip("/").partition(_RUNS)
    return (home, rest.split("/")[0]) if found else None


def _full_name(spark: SparkSession, table: str) -> str:
    known = spark.catalog.getTable(table)
    return ".".join([*known.namespace, known.name]).lower()


def run_readers(spark: SparkSession, home: str, run: str) -> list[str]:
    """Names of the other tables that the run's list holds."""
    return paths.child_files(spark, f"{home}{_RUNS}_readers/{run}")


def _homes(spark: SparkSession, table: str) -> list[str]:
    """The table's own home, and those of other tables where it has read."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    own = kept.get(_HOME) or table_location(spark, table).split(_RUNS)[0]
    return [own, *filter(None, kept.get(_ABROAD, "").split("\n"))]


def table_home(spark: SparkSession, table: str) -> str:
    """Where the table's own runs lie, also while it reads those of another table."""
    return _homes(spark, table)[0]


def _note_reader(spark: SparkSession, table: str, places: Collection[str]) -> None:
    """Put the table on the lists of other tables' runs that it is about to read."""
    found = {run_of(p) for p in places} - {None}
    homes = _homes(spark, table) if found else []
    abroad = {(home, run) for home, run in found if home != homes[0]}
    if new := sorted({home for home, _ in abroad} - set(homes)):
        kept = {_HOME: homes[0], _ABROAD: "\n".join([*homes[1:], *new])}
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in kept.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    for home, run in abroad:
        paths.touch(spark, f"{home}{_RUNS}_readers/{run}/{_full_name(spark, table)}")


def attach_partitions(spark: SparkSession, table: str, mapping: Mapping[Spec, str], own: bool = False) -> None:
    """Point each partition at its folder, adding those the table lacks; ``own`` says all are the table's own runs."""
    if not own:
        _note_reader(spark, table, mapping.values())
    present = set(partition_specs(spark, table))
    added = [(s, p) for s, p in mapping.items() if s not in present]
    for spec, path in mapping.items():
        if spec in present:
            spark.sql(f"ALTER TABLE {table} {_clause(spec)} SET LOCATION {_literal(path)}")
    for i in range(0, len(added), _ADD_AT_ONCE):
        clauses = " ".join(f"{_clause(s)} LOCATION {_literal(p)}" for s, p in added[i : i + _ADD_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")


def drop_partitions(
    spark: SparkSession, table: str, which: Callable[[dict[str, str]], bool] = lambda _: True
) -> list[Spec]:
    """Drop the partitions ``which`` accepts, all of them by default."""
    gone = [s for s in partition_specs(spark, table) if which(dict(s))]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(_clause(s) for s in gone))
    return gone


def mount_partitions(spark: SparkSession, table: str, mapping: Mapping[Spec, str]) -> None:
    """Make ``mapping`` the table's only partitions."""
    attach_partitions(spark, table, mapping)
    drop_partitions(spark, table, lambda spec: tuple(spec.items()) not in mapping)


def truncate_table(spark: SparkSession, table: str) -> None:
    """Empty a table; an unpartitioned one is pointed at a folder without rows."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        drop_partitions(spark, table)
    else:
        swap_table(spark, table, spark.table(table).where(F.lit(False)))


def run_folder(spark: SparkSession, table: str, name: str) -> str:
    """A new folder beside the table for the rows of one run."""
    return new_run(table_home(spark, table), name)


def new_run(location: str, name: str) -> str:
    return f"{location.rstrip('/').split(_RUNS)[0]}{_RUNS}{name}-{uuid.uuid4().hex}"


def as_stored(
    df: DataFrame, table: str, without: Collection[str] = (), given: Collection[str] = ()
) -> DataFrame:
    """``df`` in the table's column order and types; a missing column is an error.

    Columns in ``given`` stay beside them as ``_given_<name>``, whatever the table has.
    """
    fields = df.sparkSession.table(table).schema.fields
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields if f.name not in without],
        *[F.col(f"`{c}`").alias(f"_given_{c}") for c in given],
    )


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Let an unpartitioned table read the folder ``path``, its own run or another table's."""
    _note_reader(spark, table, [path])
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(path)}")


def swap_table(spark: SparkSession, table: str, df: DataFrame) -> str:
    """Replace the content of an unpartitioned table in one catalog change."""
    folder = run_folder(spark, table, "all")
    as_stored(df, table).write.parquet(folder)
    point_table(spark, table, folder)
    return folder


def swap_partition(spark: SparkSession, table: str, df: DataFrame, spec: Spec) -> str:
    """Replace one partition; an empty ``df`` leaves it present and empty."""
    folder = run_folder(spark, table, "-".join(v for _, v in spec))
    as_stored(df, table, dict(spec)).write.parquet(folder)
    attach_partitions(spark, table, {spec: folder}, own=True)
    return folder


def swap_partitions(spark: SparkSession, table: str, df: DataFrame, column: str) -> list[str]:
    """Replace every partition that ``df`` has rows for, in one job.

    Rows are packed into files of even size, so a day with many rows becomes
    many files and a thin day one.
    """
    folder = run_folder(spark, table, "many")
    rows = as_stored(df, table).hint("rebalance", F.col(column))
    rows.write.partitionBy(column).parquet(folder)
    names = paths.child_dirs(spark, folder)
    attach_partitions(
        spark,
        table,
        {((column, unquote(n.split("=", 1)[1])),): f"{folder}/{n}" for n in names},
        own=True,
    )
    return names


def read_runs(spark: SparkSession, table: str) -> set[tuple[str, str]]:
    """(home, run) of all runs that the table or one of its partitions reads."""
    places = [table_location(spark, table)]
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        places += [table_details(spark, table, spec)["Location"] for spec in partition_specs(spark, table)]
    return {run_of(p) for p in places} - {None}


def discard_runs(spark: SparkSession, table: str) -> list[str]:
    """Delete the table's run folders that no table reads any more.

    A run with another table on its list stays; a name that stands for no table
    counts for nothing. The table's own name goes from the lists of other tables' runs
    that it has left, which their own tables may then delete. Replaced folders
    are kept until then, for readers that still use them; call this while no load
    of the table is under way.
    """
    used, (home, *abroad) = read_runs(spark, table), _homes(spark, table)
    name = _full_name(spark, table) if abroad else ""
    for place in abroad:
        for run in paths.child_dirs(spark, f"{place}{_RUNS}_readers"):
            if (place, run) not in used and name in run_readers(spark, place, run):
                paths.delete(spark, f"{place}{_RUNS}_readers/{run}/{name}")
    gone = []
    for run in paths.child_dirs(spark, f"{home}{_RUNS}".rstrip("/")):
        others = [] if (home, run) in used else run_readers(spark, home, run)
        if (home, run) in used or any(spark.catalog.tableExists(r) for r in others):
            continue
        paths.delete(spark, f"{home}{_RUNS}{run}")
        if others:
            paths.delete(spark, f"{home}{_RUNS}_readers/{run}")
        gone.append(run)
    return gone
