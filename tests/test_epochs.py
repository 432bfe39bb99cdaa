"""Days read out of epochs equal days read out of the chain."""

import pytest
from pyspark.sql import functions as F

from odsflow.operators import chain, chain_epochs, chain_table
from odsflow.sources import partitions
from tests.test_chain import HISTORY, KEYS, OPEN, START, make_chain, random_days, replayed, rows
from tests.test_chain_replay import dated

DAYS = [f"202402{d:02d}" for d in range(1, 9)]
STARTS = ["20240101", "20240202", "20240203", "20240206"]


def as_of(history, day):
    return rows(chain.chain_as_of(history, day).drop("end_dt"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_day_of_every_epoch(spark, seed):
    history = spark.createDataFrame(replayed(random_days(seed, 8, 8), START), HISTORY)
    epochs = chain_epochs.by_epoch(history, STARTS).cache()
    assert epochs.columns == [*history.columns, "epoch"]
    for day in ["20240101", "20240102", "20240131", *DAYS, "20250101"]:
        assert rows(chain_epochs.epoch_as_of(epochs, STARTS, day)) == as_of(history, day)
    # Once in each epoch, and with no end that a later day may change.
    assert epochs.groupBy("epoch", "k", "g", "start_dt").count().where("count > 1").isEmpty()
    for start, following in zip(STARTS, STARTS[1:]):
        ends = {r["end_dt"] for r in epochs.where(F.col("epoch") == start).collect()}
        assert all(start < e < following or e == OPEN for e in ends)
    late = chain_epochs.by_epoch(history, STARTS, "20240203")
    assert rows(late) == rows(epochs.where("epoch >= '20240203'"))


def test_refresh_after_merges_and_replays(spark, database, tmp_path):
    table = make_chain(spark, database, tmp_path)
    days = random_days(41, 8, 8)
    epochs = f"{database}.epochs"
    chain_epochs.create_epoch_table(spark, table, epochs, str(tmp_path / "epochs"))
    for day, changes in days[:3]:
        delta = dated(spark, [(day, changes)]).drop("etl_dt")
        chain_table.load_chain_day(spark, table, delta, KEYS, day)
    chain_epochs.refresh_epochs(spark, table, epochs, STARTS)
    first = partitions.table_details(spark, epochs, (("epoch", STARTS[0]),))["Location"]
    chain_table.load_chain_range(spark, table, dated(spark, days), KEYS, days[3][0])
    assert chain_epochs.refresh_epochs(spark, table, epochs, STARTS, days[3][0]) == STARTS[2:]
    for day in ["20240101", *DAYS]:
        assert rows(chain_epochs.epoch_as_of(spark.table(epochs), STARTS, day)) == as_of(spark.table(table), day)
    # What lies before the epoch of the replay is not written again.
    assert partitions.table_details(spark, epochs, (("epoch", STARTS[0]),))["Location"] == first
    plan = chain_epochs.epoch_as_of(spark.table(epochs), STARTS, "20240204")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan and "(epoch#" in plan and "= 20240203)" in plan


def test_wrong_epochs_are_refused(spark):
    history = spark.createDataFrame(START, HISTORY)
    for starts in ([], ["20240102", "20240101"], ["20240101", "20240101"]):
        with pytest.raises(ValueError):
            chain_epochs.by_epoch(history, starts)
    with pytest.raises(ValueError, match="before the first epoch"):
        chain_epochs.epoch_of(STARTS, "20231231")
    assert chain_epochs.by_epoch(history.where("false"), STARTS).collect() == []
