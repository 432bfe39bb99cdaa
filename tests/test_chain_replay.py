"""Checked keys on every path, replays of ranges of days, and the chain as a stream."""

import pytest
from pyspark.sql import functions as F

from odsflow.operators import chain, chain_table
from odsflow.sources import partitions, paths
from odsflow.streaming import chain_stream
from tests.test_chain import DELTA, HISTORY, KEYS, OPEN, START, make_chain, plan_of, random_days, replayed, rows

DATED = f"{DELTA}, etl_dt string"
WRONG = {
    "repeated, known": [(1, "a", "p"), (1, "a", "q")],
    "repeated, equal": [(1, "a", "p"), (1, "a", "p")],
    "repeated, unknown": [(7, "z", "p"), (7, "z", "q")],
    "null": [(None, "a", "p")],
    "partly null": [(1, None, "p"), (1, "a", "p")],
}


def dated(spark, days):
    return spark.createDataFrame([(*c, day) for day, changes in days for c in changes], DATED)


# Keys --------------------------------------------------------------------------


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("history", ["empty", "filtered", "filled"])
@pytest.mark.parametrize("wrong", sorted(WRONG))
def test_wrong_keys_fail_a_merge(spark, wrong, history, small):
    old = spark.createDataFrame([] if history == "empty" else START, HISTORY)
    if history == "filtered":
        old = old.where("k < 0")
    delta = spark.createDataFrame(WRONG[wrong], DELTA)
    with pytest.raises(Exception, match="key repeated in delta, or null"):
        chain.chain_merge(old, delta, KEYS, "20240105", small_delta=small).collect()
    with pytest.raises(Exception, match="key and day repeated, key null"):
        changes = delta.withColumn("day", F.lit("20240105"))
        chain.chain_replay(old, changes, KEYS, "day", "20240105", small_changes=small).collect()


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("wrong", sorted(WRONG))
def test_wrong_keys_leave_a_stored_chain_as_it_was(spark, database, tmp_path, wrong, limit):
    table = make_chain(spark, database, tmp_path)
    delta = spark.createDataFrame(WRONG[wrong], DELTA)
    with pytest.raises(Exception, match="key repeated in delta, or null"):
        chain_table.load_chain_day(spark, table, delta, KEYS, "20240105", broadcast_limit=limit)
    with pytest.raises(Exception, match="key and day repeated, key null"):
        changes = delta.withColumn("etl_dt", F.lit("20240105"))
        chain_table.load_chain_range(spark, table, changes, KEYS, "20240105", broadcast_limit=limit)
    assert rows(spark.table(table)) == sorted(START, key=str)


@pytest.mark.parametrize("wrong", sorted(WRONG))
def test_wrong_keys_fail_a_first_load(spark, database, tmp_path, wrong):
    source = spark.createDataFrame(WRONG[wrong], DELTA)
    with pytest.raises(Exception, match="key repeated in delta, or null"):
        chain.chain_init(source, "20240101", keys=KEYS).collect()
    table = make_chain(spark, database, tmp_path)
    with pytest.raises(Exception, match="key repeated in delta, or null"):
        chain_table.load_chain_init(source, table, "20240101", keys=KEYS)
    assert rows(spark.table(table)) == sorted(START, key=str)


# Replays -----------------------------------------------------------------------


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", [11, 12, 13])
def test_replay_equals_repeated_merges(spark, seed, small):
    days = random_days(seed, 6, 8)
    state = spark.createDataFrame(replayed(days[:4], START), HISTORY)
    for first in (0, 2, 4):
        changed = [(d, [(k, g, f"{v}{seed}" if k % 2 else v) for k, g, v in cs]) for d, cs in days[first:]]
        after = chain.chain_replay(state, dated(spark, changed), KEYS, "etl_dt", days[first][0], small_changes=small)
        assert after.columns == state.columns
        assert rows(after) == replayed(days[: min(first, 4)] + changed, START)


def test_replay_in_the_old_layout(spark):
    old = chain.chain_init(spark.createDataFrame([(1, "a", "x"), (2, "a", None)], DELTA), "20240101", chain.OLD_CHAIN)
    changes = dated(spark, [("20240105", [(1, "a", "y"), (2, "a", None)]), ("20240107", [(1, "a", "x"), (3, "b", "n")])])
    after = chain.chain_replay(old, changes, KEYS, "etl_dt", "20240105", chain.OLD_CHAIN)
    assert rows(after) == sorted(
        [
            (1, "a", "x", "19000000", "20240105"),
            (1, "a", "y", "20240105", "20240107"),
            (1, "a", "x", "20240107", OPEN),
            (2, "a", None, "19000000", OPEN),
            (3, "b", "n", "20240107", OPEN),
        ],
        key=str,
    )


def test_changes_before_the_replay_fail(spark):
    old = spark.createDataFrame(START, HISTORY)
    early = dated(spark, [("20240104", [(1, "a", "y")])])
    with pytest.raises(Exception, match="day too early"):
        chain.chain_replay(old, early, KEYS, "etl_dt", "20240105").collect()


def test_replay_shuffles_the_open_rows_once(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    changes = dated(spark, random_days(3))
    live = chain.live_before(spark.table(table), "20240105")
    wide = plan_of(chain.replay_days(live, changes, KEYS, "etl_dt", "20240105"))
    assert wide.count("Exchange hashpartitioning") == 1
    small = plan_of(chain.replay_days(live, changes, KEYS, "etl_dt", "20240105", small_changes=True))
    assert "SortMergeJoin" not in small and "BroadcastHashJoin" in small


@pytest.mark.parametrize("buckets, limit", [(None, None), (None, 0), (3, 0)])
def test_stored_replay_writes_two_partitions_a_day(spark, database, tmp_path, buckets, limit):
    table = make_chain(spark, database, tmp_path, buckets)
    days = random_days(21, 5, 7)
    run = chain_table.load_chain_range(spark, table, dated(spark, days), KEYS, days[0][0], broadcast_limit=limit)
    assert run.broadcast == (limit is None)
    assert rows(spark.table(table)) == replayed(days, START)
    untouched = partitions.table_details(spark, table, (("end_dt", "20240102"),))["Location"]
    later = [(d, [(k, g, "late") for k, g, _ in cs]) for d, cs in days[2:]]
    run = chain_table.load_chain_range(spark, table, dated(spark, days[:2] + later), KEYS, days[2][0], broadcast_limit=limit)
    assert rows(spark.table(table)) == replayed(days[:2] + later, START)
    assert partitions.table_details(spark, table, (("end_dt", "20240102"),))["Location"] == untouched
    ends = {r[5] for r in replayed(days[:2] + later, START)}
    assert set(partitions.partition_values(spark, table)) == ends
    partitions.discard_runs(spark, table)
    assert rows(spark.table(table)) == replayed(days[:2] + later, START)
    none = chain_table.load_chain_range(spark, table, dated(spark, []), KEYS, "20240103", broadcast_limit=limit)
    assert rows(spark.table(table)) == sorted(START, key=str) and none.dropped
    # A single day's replay is the day's merge.
    day, changes = days[0]
    chain_table.load_chain_range(spark, table, dated(spark, [days[0]]), KEYS, day, broadcast_limit=limit)
    assert rows(spark.table(table)) == replayed([(day, changes)], START)


def test_replay_cut_off_before_its_last_switch(spark, database, tmp_path, monkeypatch):
    table = make_chain(spark, database, tmp_path)
    days = [("20240105", [(1, "a", "n"), (3, "a", None), (8, "a", "new")]), ("20240106", [(1, "a", "m")])]
    attach = partitions.attach_partitions

    def stop_at_open(session, name, mapping, **more):
        if ((("end_dt", OPEN),)) in mapping:
            raise RuntimeError("lost")
        attach(session, name, mapping, **more)

    monkeypatch.setattr(partitions, "attach_partitions", stop_at_open)
    with pytest.raises(RuntimeError):
        chain_table.load_chain_range(spark, table, dated(spark, days), KEYS, "20240105")
    monkeypatch.undo()
    chain_table.load_chain_range(spark, table, dated(spark, days), KEYS, "20240105")
    assert rows(spark.table(table)) == replayed(days, START)


# The stream --------------------------------------------------------------------

STAGED = f"{DELTA}, n long, etl_dt string"


def stage(spark, folder, name, days, n=1):
    """Every change twice, the older one first."""
    found = [row for day, cs in days for k, g, v in cs for row in ((k, g, "older", n - 1, day), (k, g, v, n, day))]
    spark.createDataFrame(found, STAGED).write.parquet(f"{folder}/{name}")


def run_stream(spark, table, tmp_path, max_files=None):
    schema = spark.createDataFrame([], STAGED).schema
    return chain_stream.merge_stream(
        spark, str(tmp_path / "staged"), schema, table, KEYS, ["n"], str(tmp_path / "checkpoint"), max_files=max_files
    )


def test_stream_takes_late_and_corrected_days(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    days = random_days(31, 5, 7)
    staged = str(tmp_path / "staged")
    stage(spark, staged, "1", [days[0], days[3]])
    run_stream(spark, table, tmp_path)
    assert rows(spark.table(table)) == replayed([days[0], days[3]], START)
    stage(spark, staged, "2", [days[1], days[4]])
    corrected = (days[3][0], [(k, g, "corrected") for k, g, _ in days[3][1]][:2])
    stage(spark, staged, "3", [corrected], n=5)
    run_stream(spark, table, tmp_path, max_files=1)
    right = (days[3][0], corrected[1] + days[3][1][2:])
    wanted = replayed([days[0], days[1], right, days[4]], START)
    assert rows(spark.table(table)) == wanted
    run_stream(spark, table, tmp_path)
    assert rows(spark.table(table)) == wanted


def test_stream_cut_off_and_started_again(spark, database, tmp_path, monkeypatch):
    table = make_chain(spark, database, tmp_path)
    days = random_days(32, 4, 7)
    stage(spark, str(tmp_path / "staged"), "1", days)
    load = chain_stream.load_chain_range

    def lost(*args, **kwargs):
        load(*args, **kwargs)
        raise RuntimeError("lost after the merge")

    monkeypatch.setattr(chain_stream, "load_chain_range", lost)
    with pytest.raises(Exception, match="lost after the merge"):
        run_stream(spark, table, tmp_path)
    monkeypatch.undo()
    run_stream(spark, table, tmp_path)
    assert rows(spark.table(table)) == replayed(days, START)


def test_a_repeated_batch_changes_nothing(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    days = random_days(33, 3, 7)
    changes = dated(spark, days).withColumn("n", F.lit(1))
    assert chain_stream.merge_batch(changes, 0, table, KEYS, ["n"], "s") is not None
    place = partitions.table_details(spark, table, (("end_dt", OPEN),))["Location"]
    assert chain_stream.merge_batch(changes, 0, table, KEYS, ["n"], "s") is None
    assert partitions.table_details(spark, table, (("end_dt", OPEN),))["Location"] == place
    # The same number of another stream is another batch.
    assert chain_stream.merge_batch(changes, 0, table, KEYS, ["n"], "t") is not None
    assert rows(spark.table(table)) == replayed(days, START)
    assert chain_stream.merge_batch(changes.where("false"), 1, table, KEYS, ["n"], "s") is None
    with pytest.raises(ValueError, match="without etl_dt"):
        chain_stream.merge_batch(changes.withColumn("etl_dt", F.lit(None).cast("string")), 2, table, KEYS, ["n"], "s")
    assert paths.exists(spark, f"{chain_stream.changes_home(spark, table)}/done/s-1")
