"""Stored logs: reruns, compaction, two writers at once, ties."""

import pytest
from pyspark.sql import functions as F

from odsflow.config import Column, TableConfig
from odsflow.operators import audit, layouts, log_store
from odsflow.plans import daily
from odsflow.sources import paths

KEYS = "db_name string, table_name string, data_date date, run_time timestamp_ntz"


def counts(spark, *rows):
    """(table, n) pairs of one run."""
    found = spark.createDataFrame(list(rows), "table_name string, n_rows long")
    return found.select(
        F.lit("db").alias("db_name"),
        "table_name",
        F.lit("2024-01-01").cast("date").alias("data_date"),
        F.lit("2024-01-01 06:00:00").cast("timestamp_ntz").alias("run_time"),
        "n_rows",
    )


def loads(spark, root):
    rows = log_store.read_loads(spark, root).select("table_name", *audit.LOG_COUNTS).collect()
    return sorted(map(tuple, rows))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "logs")


def test_rounds_reruns_and_compaction(spark, root):
    assert loads(spark, root) == []
    assert log_store.read_loads(spark, root).columns == [*audit.LOG_KEYS, *audit.LOG_COUNTS]
    log_store.write_round(counts(spark, ("a", 1), ("b", 2)), root, "source_before")
    log_store.write_round(counts(spark, ("a", 1)), root, "target")
    log_store.write_round(counts(spark, ("a", 3)), root, "source_after")
    wanted = [("a", 1, 3, 1), ("b", 2, None, None)]
    assert loads(spark, root) == wanted
    log_store.compact(spark, root, log_store.LOADS)
    assert loads(spark, root) == wanted
    log_store.write_round(counts(spark, ("a", 5)), root, "source_before")
    assert loads(spark, root) == [("a", 5, None, None), wanted[1]]
    for _ in range(3):
        log_store.compact(spark, root, log_store.LOADS)
        assert loads(spark, root) == [("a", 5, None, None), wanted[1]]
    assert len(paths.child_dirs(spark, f"{root}/load/state")) == 2
    assert paths.child_dirs(spark, f"{root}/load/events") == []
    log_store.write_round(counts(spark, ("c", 7)), root, "target")
    assert loads(spark, root) == [("a", 5, None, None), wanted[1], ("c", None, None, 7)]


def test_two_compactions_at_once_lose_nothing(spark, root, monkeypatch):
    log_store.write_round(counts(spark, ("a", 1)), root, "source_before")
    log_store.compact(spark, root, log_store.LOADS)
    log_store.write_round(counts(spark, ("b", 2)), root, "source_before")
    fold, again = log_store.latest_per_key, []

    def other_runs_first(*args):
        if not again:
            again.append(1)
            log_store.write_round(counts(spark, ("c", 3)), root, "source_before")
            log_store.compact(spark, root, log_store.LOADS)
            log_store.write_round(counts(spark, ("d", 4)), root, "source_before")
        return fold(*args)

    monkeypatch.setattr(log_store, "latest_per_key", other_runs_first)
    log_store.compact(spark, root, log_store.LOADS)
    wanted = [(t, n, None, None) for t, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4))]
    assert loads(spark, root) == wanted
    for _ in range(2):
        log_store.compact(spark, root, log_store.LOADS)
        assert loads(spark, root) == wanted


def test_a_write_that_did_not_end_is_not_read(spark, root):
    log_store.write_round(counts(spark, ("a", 1)), root, "source_before")
    broken = counts(spark, ("b", 2)).withColumn("n_rows", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        log_store.write_round(broken, root, "source_before")
    assert loads(spark, root) == [("a", 1, None, None)]
    with pytest.raises(ValueError, match="no round"):
        log_store.write_round(counts(spark), root, "sideways")


def test_events_of_equal_rank_are_refused(spark, root):
    with pytest.raises(ValueError, match="one moment"):
        log_store.write_round(counts(spark, ("a", 1), ("a", 2)), root, "source_before")
    assert loads(spark, root) == [] and paths.child_dirs(spark, f"{root}/load/events") == []
    # Calls of one moment are told apart by their names, alike for every reader.
    for n in (1, 2):
        log_store.write_round(counts(spark, ("a", n)), root, "source_before", at=5)
    first = loads(spark, root)
    log_store.compact(spark, root, log_store.LOADS)
    assert loads(spark, root) == first


def test_upsert_refuses_unlike_rows_of_equal_rank(spark):
    log = spark.createDataFrame([("a", 1, "x")], "k string, n int, v string")
    alike = spark.createDataFrame([("a", 2, "y"), ("a", 2, "y"), ("b", 1, None)], log.schema)
    merged = audit.upsert(log, alike, ["k"], ["n", "v"], order=["n"])
    assert sorted(map(tuple, merged.collect())) == [("a", 2, "y"), ("b", 1, None)]
    for order in (["n"], []):
        unlike = spark.createDataFrame([("a", 2, "y"), ("a", 2, "z")], log.schema)
        with pytest.raises(Exception, match="rows of equal rank differ"):
            audit.upsert(log, unlike, ["k"], ["n", "v"], order=order).collect()
    lower = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), ("a", 3, "r")], log.schema)
    assert audit.upsert(log, lower, ["k"], ["n", "v"], order=["n"]).first()["v"] == "r"


def test_every_daily_run_leaves_its_rows(spark, database, tmp_path, root):
    source = f"{tmp_path}/src/thing.parquet"
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(source)
    cfg = TableConfig(
        columns=(Column(1, "k", "long", True), Column(2, "v", "string")), keys=("k",), hive_db=database,
        hive_table="thing_h", url=f"parquet:{tmp_path}/src", table="thing",
    )
    layouts.create_table(spark, cfg, "slice")
    for moment in ("20240101 06:00:00", "20240101 07:00:00", "20240101 06:00:00"):
        daily.run_slice(spark, cfg, "20240101", moment, root)
    stored = log_store.read_loads(spark, root).select("run_time", *audit.LOG_COUNTS).collect()
    assert sorted((str(r[0])[11:13], *r[1:]) for r in stored) == [("06", 2, 2, 2), ("07", 2, 2, 2)]
    done = log_store.read_batches(spark, root).collect()
    assert [(r["sys"], r["step"], r["data_dt"]) for r in done] == [("src", "slice:thing", "20240101")]


def test_a_failed_load_leaves_its_first_count(spark, database, root):
    rows = spark.range(3)

    def load():
        raise RuntimeError("no load")

    with pytest.raises(RuntimeError):
        audit.audited(
            spark, "db", "t", "20240101", lambda: rows, load, lambda: rows, "20240101 06:00:00",
            lambda name, row: log_store.write_round(row, root, name),
        )
    assert loads(spark, root) == [("t", 3, None, None)]
