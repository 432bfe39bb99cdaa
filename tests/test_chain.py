import random

import pytest
from pyspark.sql import functions as F

from odsflow.config import Column, TableConfig
from odsflow.operators import chain, chain_table, layouts
from odsflow.sources import partitions

OPEN = chain.CHAIN.open_end
HISTORY = "etl_dt string, start_dt string, k int, g string, v string, end_dt string"
DELTA = "k int, g string, v string"
KEYS = ["k", "g"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def replayed(days, start=()):
    """Brute force: apply each day's changes to a dict of open versions."""
    versions = [list(r) for r in start]
    for day, changes in days:
        versions = [v for v in versions if v[1] < day]
        for v in versions:
            if v[5] >= day:
                v[5] = OPEN
        live = {(v[2], v[3]): v for v in versions if v[5] == OPEN}
        for k, g, value in changes:
            old = live.get((k, g))
            if old is not None and old[4] == value:
                continue
            if old is not None:
                old[5] = day
            versions.append([day, day, k, g, value, OPEN])
    return sorted(map(tuple, versions), key=str)


START = [
    ("20240101", "19000101", 1, "a", "x", "20240102"),
    ("20240102", "20240102", 1, "a", "y", OPEN),
    ("20240101", "19000101", 2, "a", None, OPEN),
    ("20240101", "19000101", 2, "b", "z", OPEN),
    ("20240101", "19000101", 3, "a", "w", OPEN),
]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize(
    "changes",
    [
        [],
        [(1, "a", "y")],
        [(1, "a", "n"), (9, "a", "new")],
        [(2, "a", "now"), (2, "b", None)],
        [(2, "a", None), (9, "z", None)],
        [(1, "a", "x"), (2, "a", "q"), (2, "b", "q"), (3, "a", "q")],
    ],
)
def test_merge_of_one_day(spark, changes, small):
    history = spark.createDataFrame(START, HISTORY)
    delta = spark.createDataFrame(changes, DELTA)
    merged = chain.chain_merge(history, delta, KEYS, "20240105", small_delta=small)
    assert merged.columns == history.columns
    assert rows(merged) == replayed([("20240105", changes)], START)


@pytest.mark.parametrize("small", [False, True])
def test_same_day_again_and_revert(spark, small):
    history = spark.createDataFrame(START, HISTORY)
    first = spark.createDataFrame([(1, "a", "n"), (9, "a", "new")], DELTA)
    once = chain.chain_merge(history, first, KEYS, "20240105", small_delta=small)
    twice = chain.chain_merge(once, first, KEYS, "20240105", small_delta=small)
    assert rows(once) == rows(twice)
    back = spark.createDataFrame([(1, "a", "y")], DELTA)
    reverted = chain.chain_merge(once, back, KEYS, "20240105", small_delta=small)
    assert rows(reverted) == sorted(START, key=str)
    vanished = chain.chain_merge(once, back.where("false"), KEYS, "20240105", small_delta=small)
    assert rows(vanished) == sorted(START, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_repeated_delta_key_fails(spark, small):
    history = spark.createDataFrame(START, HISTORY)
    delta = spark.createDataFrame([(1, "a", "p"), (1, "a", "q")], DELTA)
    with pytest.raises(Exception, match="key repeated in delta"):
        chain.chain_merge(history, delta, KEYS, "20240105", small_delta=small).collect()


def random_days(seed, n_days=5, n_keys=6):
    rnd = random.Random(seed)
    return [
        (
            f"202402{d:02d}",
            [
                (k, "g", rnd.choice(["a", "b", None]))
                for k in range(n_keys)
                if rnd.random() < 0.5
            ],
        )
        for d in range(1, n_days + 1)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_days_match_brute_force(spark, seed):
    days = random_days(seed)
    state = spark.createDataFrame([], HISTORY)
    rnd = random.Random(seed)
    fed = []
    order = list(range(len(days))) + [2, 3, 4] + [4]
    for i in order:
        day, changes = days[i]
        merged = chain.chain_merge(
            state, spark.createDataFrame(changes, DELTA), KEYS, day, small_delta=rnd.random() < 0.5
        )
        state = spark.createDataFrame(merged.collect(), HISTORY)
        fed.append((day, changes))
    result = rows(state)
    assert result == replayed(fed)
    assert result == replayed(days)

    by_key = {}
    for r in result:
        by_key.setdefault((r[2], r[3]), []).append((r[1], r[5]))
    for spans in by_key.values():
        spans.sort()
        assert [e for _, e in spans].count(OPEN) == 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for upto, (day, _) in enumerate(days, 1):
        last = {(k, g): v for _, changes in days[:upto] for k, g, v in changes}
        valid = chain.chain_as_of(state, day).select("k", "g", "v")
        assert {(r[0], r[1]): r[2] for r in valid.collect()} == last


@pytest.mark.parametrize("seed", [4, 5])
def test_bulk_build_equals_daily_merges(spark, seed):
    days = random_days(seed, 8, 10)
    changes = [(*c, day) for day, cs in days for c in cs]
    built = chain.chain_build(spark.createDataFrame(changes, f"{DELTA}, day string"), KEYS, "day")
    assert rows(built) == replayed(days)


def test_init_and_old_layout(spark):
    source = spark.createDataFrame([(1, "a", "x")], DELTA)
    assert rows(chain.chain_init(source, "20240101")) == [("20240101", "19000101", 1, "a", "x", OPEN)]
    old = chain.chain_init(source, "20240101", chain.OLD_CHAIN)
    assert old.columns == ["k", "g", "v", "s_dt", "e_dt"]
    delta = spark.createDataFrame([(1, "a", "y"), (2, "a", "n")], DELTA)
    merged = chain.chain_merge(old, delta, KEYS, "20240105", chain.OLD_CHAIN)
    assert rows(merged) == [
        (1, "a", "x", "19000000", "20240105"),
        (1, "a", "y", "20240105", OPEN),
        (2, "a", "n", "20240105", OPEN),
    ]
    assert chain.chain_current(merged, chain.OLD_CHAIN).count() == 2


CONFIG = TableConfig(
    columns=(Column(1, "k", "int", True), Column(2, "g", "string", True), Column(3, "v", "string")),
    keys=("K", "G"),
    hive_table="thing_h",
)


def make_chain(spark, database, tmp_path, buckets=None):
    cfg = TableConfig(**{**CONFIG.__dict__, "hive_db": database})
    table, _ = layouts.create_chain_tables(spark, cfg, str(tmp_path / "chain"), buckets=buckets)
    chain_table.load_chain(spark, table, spark.createDataFrame(START, HISTORY))
    return table


@pytest.mark.parametrize("buckets, limit", [(None, None), (None, 0), (3, 0)])
def test_stored_chain_days_and_replay(spark, database, tmp_path, buckets, limit):
    table = make_chain(spark, database, tmp_path, buckets)
    days = random_days(7, 3, 5)
    days.insert(1, ("2024020101", []))
    fed = []
    for i in (0, 1, 2, 2, 1, 2, 3):
        day, changes = days[i]
        delta = spark.createDataFrame(changes, DELTA)
        run = chain_table.load_chain_day(spark, table, delta, KEYS, day, broadcast_limit=limit)
        assert run.broadcast == (limit is None)
        fed.append((day, changes))
        assert rows(spark.table(table)) == replayed(fed, START)
    assert len(run.replaced) == 1 and f"end_dt={OPEN}" in run.replaced[0] and f"_runs/{days[2][0]}" in run.replaced[0]
    assert len(partitions.discard_runs(spark, table)) >= 5
    assert rows(spark.table(table)) == replayed(fed, START)
    later = chain_table.load_chain_day(
        spark, table, spark.createDataFrame([], DELTA), KEYS, "20240103", broadcast_limit=limit
    )
    assert rows(spark.table(table)) == sorted(START, key=str)
    assert partitions.partition_values(spark, table) == ["20240102", OPEN]
    assert later.dropped


def test_days_outside_the_chain_are_refused(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    for day in ("19000101", OPEN):
        with pytest.raises(ValueError):
            chain_table.load_chain_day(spark, table, spark.createDataFrame([], DELTA), KEYS, day)


def test_driver_lost_between_the_two_switches(spark, database, tmp_path, monkeypatch):
    table = make_chain(spark, database, tmp_path)
    delta = spark.createDataFrame([(1, "a", "n"), (3, "a", None), (8, "a", "new")], DELTA)
    attach = partitions.attach_partitions

    def stop_at_open(session, name, mapping, **more):
        if ((("end_dt", OPEN),)) in mapping:
            raise RuntimeError("lost")
        attach(session, name, mapping, **more)

    monkeypatch.setattr(partitions, "attach_partitions", stop_at_open)
    with pytest.raises(RuntimeError):
        chain_table.load_chain_day(spark, table, delta, KEYS, "20240105")
    monkeypatch.undo()
    chain_table.load_chain_day(spark, table, delta, KEYS, "20240105")
    expected = replayed([("20240105", [(1, "a", "n"), (3, "a", None), (8, "a", "new")])], START)
    assert rows(spark.table(table)) == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_only_open_rows_and_shuffles_once(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    delta = spark.createDataFrame([(1, "a", "n")], DELTA)
    live = chain.live_before(spark.table(table), "20240105")
    wide = plan_of(chain.chain_day(live, delta, KEYS, "20240105"))
    assert wide.count("Exchange hashpartitioning") == 2
    assert "PartitionFilters: [isnotnull(end_dt" in wide
    small = plan_of(chain.chain_day(live, delta, KEYS, "20240105", small_delta=True))
    assert "SortMergeJoin" not in small
    # Only the delta is moved, to see that its keys are unique: for the old keys and for the new ones.
    assert small.count("Exchange hashpartitioning") == 2
    # The stored rows go from their scan into the join without one.
    for scan in [part for part in small.split("\n") if "FileScan parquet" in part]:
        below = small.split("\n").index(scan)
        assert all("Exchange" not in line for line in small.split("\n")[below - 3 : below])


def test_bucketed_chain_does_not_shuffle_its_open_rows(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path, buckets=6)
    delta = spark.createDataFrame([(1, "a", "n")], DELTA).repartition(6, *KEYS)
    live = chain.live_before(spark.table(table), "20240105")
    plan = plan_of(chain.chain_day(live, delta, KEYS, "20240105"))
    assert plan.count("Exchange") == 1
    assert "Bucketed: true" in plan


@pytest.mark.parametrize("rows", [[(1, "20240101", "a"), (1, "20240101", "b")], [(None, "20240101", "a")]])
def test_repeated_or_null_keys_fail(spark, rows):
    changes = spark.createDataFrame(rows, "k long, day string, v string")
    with pytest.raises(Exception, match="null"):
        chain.chain_build(changes, ["k"], "day").collect()
    history = chain.chain_init(changes.drop("day").where("false"), "20231231")
    with pytest.raises(Exception, match="null"):
        chain.chain_merge(history, changes.drop("day"), ["k"], "20240101").collect()
