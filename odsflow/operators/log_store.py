"""The load log and the completion log as stored tables.

A log is a folder. ``events`` holds a folder for each write, complete once it has
its mark, and never changed after. ``state`` holds what compaction made of the
events up to some moment: the last event of each key and round, beside the names
of the event folders that went into it. The newest complete state and the events
that it does not name are the log.

Writers only add folders, so two runs may write at once. Compaction adds a state
under a higher number; of two made at once the greater name counts, and it names
its own events, so the other's stay pending. Event folders are deleted one
compaction after they went into a state, and states one compaction after they
were replaced, so a reader that is under way keeps what it found.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from odsflow.operators.audit import BATCH_KEYS, LOG_COUNTS, LOG_KEYS, ROUNDS
from odsflow.operators.latest import latest_per_key
from odsflow.sources import paths

_DONE = "_DONE"
_RANK = ("_at", "_event")
_MARKS = "_at long, _event string"


@dataclass(frozen=True)
class Log:
    """A kind of log: what an event holds, and what names the events that replace each other."""

    name: str
    event: str
    replaces: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.event}, {_MARKS}")


LOADS = Log(
    "load",
    "db_name string, table_name string, data_date date, run_time timestamp_ntz, round string, n_rows long",
    (*LOG_KEYS, "round"),
)
BATCHES = Log("batch", "sys string, step string, data_dt string, complete_time timestamp_ntz", BATCH_KEYS)


def _complete(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in paths.child_dirs(spark, folder) if paths.exists(spark, f"{folder}/{n}/{_DONE}")]


def append(rows: DataFrame, root: str, log: Log, at: int | None = None) -> str:
    """Add events; returns the name of their folder.

    All rows of a call are of one moment (``at``, by default now, in nanoseconds),
    so two of one key, and of one round, are refused. Events of one moment from
    different calls are told apart by their calls' names.
    """
    spark = rows.sparkSession
    at = time.time_ns() if at is None else at
    name = f"{at:020d}-{uuid.uuid4().hex}"
    fields = [f for f in log.schema.fields if f.name not in _RANK]
    chosen = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    folder = f"{root}/{log.name}/events/{name}"
    chosen.select("*", F.lit(at).cast("long").alias("_at"), F.lit(name).alias("_event")).write.parquet(folder)
    written = spark.read.schema(log.schema).parquet(folder)
    twice = written.groupBy(*log.replaces).count().where("count > 1").first()
    if twice:
        paths.delete(spark, folder)
        raise ValueError(f"events of one moment and key: {twice.asDict()}")
    paths.touch(spark, f"{folder}/{_DONE}")
    return name


def _newest_state(spark: SparkSession, root: str, log: Log) -> str | None:
    found = _complete(spark, f"{root}/{log.name}/state")
    return f"{root}/{log.name}/state/{found[-1]}" if found else None


def _folded(spark: SparkSession, state: str | None) -> set[str]:
    """Names of the event folders in a state."""
    return {r["value"] for r in spark.read.text(f"{state}/names").collect()} if state else set()


def _events(spark: SparkSession, root: str, log: Log) -> tuple[DataFrame, set[str]]:
    """All events that may still count, and the names of the folders they came in."""
    state = _newest_state(spark, root, log)
    folded, home = _folded(spark, state), f"{root}/{log.name}/events"
    pending = [n for n in _complete(spark, home) if n not in folded]
    places = ([f"{state}/rows"] if state else []) + [f"{home}/{n}" for n in pending]
    rows = spark.read.schema(log.schema).parquet(*places) if places else spark.createDataFrame([], log.schema)
    return rows, folded | set(pending)


def compact(spark: SparkSession, root: str, log: Log) -> str:
    """Fold all events into a new state and delete what the last compaction left over."""
    home = f"{root}/{log.name}"
    before = _newest_state(spark, root, log)
    rows, names = _events(spark, root, log)
    number = int(before.rsplit("/", 1)[1].split("-")[0]) if before else 0
    state = f"{home}/state/{number + 1:08d}-{uuid.uuid4().hex}"
    kept = names & set(paths.child_dirs(spark, f"{home}/events"))
    latest_per_key(rows, log.replaces, _RANK).write.parquet(f"{state}/rows")
    listed = spark.createDataFrame([(n,) for n in sorted(kept)], "value string")
    listed.coalesce(1).write.text(f"{state}/names")
    paths.touch(spark, f"{state}/{_DONE}")
    for name in _folded(spark, before):
        paths.delete(spark, f"{home}/events/{name}")
    for name in paths.child_dirs(spark, f"{home}/state"):
        if int(name.split("-")[0]) < number:
            paths.delete(spark, f"{home}/state/{name}")
    return state


def read_loads(spark: SparkSession, root: str) -> DataFrame:
    """The load log: one row per run, with the counts that its last start has.

    A first source count starts a run's row over: later rounds written before it
    no longer count. One aggregate, reduced before its shuffle.
    """
    rows, _ = _events(spark, root, LOADS)
    rank = F.struct(*_RANK)

    def last(round_name: str) -> Column:
        return F.max(F.when(F.col("round") == round_name, F.struct(*_RANK, "n_rows"))).alias(round_name)

    first = next(r for r, (_, cleared) in ROUNDS.items() if cleared)
    found = rows.groupBy(*LOG_KEYS).agg(*[last(r) for r in ROUNDS], F.max(rank).alias("_rank"))
    counts = {}
    for round_name, (column, _) in ROUNDS.items():
        own = F.col(round_name)
        later = F.col(first).isNull() | (F.struct(*[own[c] for c in _RANK]) > F.struct(*[F.col(first)[c] for c in _RANK]))
        counts[column] = own["n_rows"] if round_name == first else F.when(later, own["n_rows"])
    return found.select(*LOG_KEYS, *[counts[c].alias(c) for c in LOG_COUNTS])


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """The completion log: the last write per system, step and day."""
    rows, _ = _events(spark, root, BATCHES)
    return latest_per_key(rows, BATCH_KEYS, _RANK).drop(*_RANK)


def write_round(rows: DataFrame, root: str, round_name: str, at: int | None = None) -> str:
    """One round of counts; ``rows`` has the load log's keys and ``n_rows``."""
    if round_name not in ROUNDS:
        raise ValueError(f"no round {round_name!r}; there are {sorted(ROUNDS)}")
    return append(rows.withColumn("round", F.lit(round_name)), root, LOADS, at)


def complete(spark: SparkSession, root: str, system: str, steps: Sequence[str], day: str, moment: Column | None = None) -> str:
    """Record that ``steps`` of a system are done for a day."""
    when = F.current_timestamp().cast("timestamp_ntz") if moment is None else moment
    rows = spark.createDataFrame([(system, s, day) for s in steps], "sys string, step string, data_dt string")
    return append(rows.withColumn("complete_time", when), root, BATCHES)
