import pytest
from pyspark.sql import functions as F

from odsflow.config import Column, TableConfig
from odsflow.plans import mounts
from odsflow.sources import partitions

COLUMNS = '{"columns":[{"name":"k","type":"long"},{"name":"v","type":"%s"},{"name":"more","type":"int"}]}'


@pytest.fixture
def cfg(database, tmp_path):
    return TableConfig(
        columns=(Column(1, "k", "long", True), Column(2, "v", "string")),
        keys=("k",), hive_db=database, hive_table="thing", source_root=str(tmp_path),
        category_input="stg", category_output="out", path_db="db", path_table="thing", schema_version="1",
    )


def put(spark, path, *pairs):
    spark.createDataFrame(list(pairs), "k long, v string").write.parquet(path)


def status(cfg, tmp_path, name, *lines):
    folder = tmp_path / "out" / "db" / "thing" / "1" / "success"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_chain_is_mounted_when_ready_and_unchanged(spark, cfg, tmp_path):
    root = cfg.run_path("out")
    put(spark, f"{root}/20240101/20240102010000_9", (1, "old"))
    put(spark, f"{root}/20240101/20240102010000_10", (1, "closed"))
    put(spark, f"{root}/20991231/20240103010000_2", (1, "open"), (2, "open"))
    line = "20240103010000_2\t" + COLUMNS % "string"
    status(cfg, tmp_path, "20240102010000_9.txt", "20240102010000_9")
    status(cfg, tmp_path, "20240102010000_10.txt", "20240102010000_9\tx", line)
    with pytest.raises(mounts.NotReady):
        mounts.mount_chain(spark, cfg, "20240104", "2024-01-03 01:00:00")
    current, history = mounts.mount_chain(spark, cfg, "20240104", "2024-01-03 00:59:59")
    assert rows(spark.table(current)) == [(1, "open"), (2, "open")]
    assert rows(spark.table(history)) == [
        (1, "closed", "20240101"), (1, "open", "20991231"), (2, "open", "20991231"),
    ]
    status(cfg, tmp_path, "20240104010000_1.txt", "20240104010000_1\t" + COLUMNS % "int")
    with pytest.raises(mounts.SchemaChanged, match="v: string / int"):
        mounts.mount_chain(spark, cfg, "20240104", "2024-01-03 00:59:59")


def test_all_data_keeps_other_days(spark, cfg, tmp_path):
    staged, marks = cfg.run_path("stg"), f"{tmp_path}/marks"
    with pytest.raises(FileNotFoundError):
        mounts.refresh_all_data(spark, cfg, "20240101", marks)
    put(spark, f"{staged}/20240101/202401010600", (1, "a"))
    put(spark, f"{staged}/20240101/202401011200", (1, "b"))
    current, history = mounts.refresh_all_data(spark, cfg, "20240101", marks)
    assert rows(spark.table(current)) == [(1, "b")]
    put(spark, f"{staged}/20240102/202401020600", (2, "c"))
    mounts.refresh_all_data(spark, cfg, "20240102", marks)
    assert rows(spark.table(current)) == [(2, "c")]
    put(spark, f"{staged}/20240101/202401011800", (1, "late"))
    mounts.refresh_all_data(spark, cfg, "20240101", marks)
    assert rows(spark.table(history)) == [(1, "late", "20240101"), (2, "c", "20240102")]
    with pytest.raises(FileNotFoundError):
        mounts.refresh_all_data(spark, cfg, "20240109", marks)
    assert spark.table(history).where(F.col("biz_end_date") == "20240109").isEmpty()


def test_a_refresh_writes_no_row_twice(spark, cfg, tmp_path):
    staged, marks, ods = cfg.run_path("stg"), f"{tmp_path}/marks", cfg.run_path("out")
    for day in ("20240101", "20240102"):
        for hour, value in (("0600", "early"), ("1200", "late")):
            put(spark, f"{staged}/{day}/{day}{hour}", (1, f"{value} {day}"))
    current, history = mounts.refresh_all_data(spark, cfg, ["20240101", "20240102"], marks, str(tmp_path / "t"))
    assert rows(spark.table(history)) == [(1, "late 20240101", "20240101"), (1, "late 20240102", "20240102")]
    place = f"{ods}/date=20240102/run=202401021200"
    assert partitions.table_location(spark, current).endswith(place)
    assert partitions.table_details(spark, history, ((mounts.DATE_COLUMN, "20240102"),))["Location"].endswith(place)
    assert not list((tmp_path / "t").rglob("*.parquet"))


def test_files_of_a_failed_attempt_are_left_out(spark, cfg, tmp_path):
    staged, marks, ods = cfg.run_path("stg"), f"{tmp_path}/marks", cfg.run_path("out")
    for day in ("20240101", "20240102"):
        put(spark, f"{staged}/{day}/{day}0600", (1, day))
    mounts.refresh_all_data(spark, cfg, ["20240101", "20240102"], marks, str(tmp_path / "t"))
    spark.createDataFrame([(9, "lost")], "k long, v string").coalesce(1).write.parquet(f"{tmp_path}/lost")
    (lost,) = (tmp_path / "lost").glob("*.parquet")
    lost.rename(f"{ods}/date=20240101/run=202401010600/part-lost.parquet")
    current, history = mounts.refresh_all_data(spark, cfg, ["20240101", "20240102"], marks, str(tmp_path / "t"))
    assert rows(spark.table(history)) == [(1, "20240101", "20240101"), (1, "20240102", "20240102")]
    _, history = mounts.refresh_all_data(spark, cfg, "20240101", marks, str(tmp_path / "t"))
    assert rows(spark.table(current)) == [(1, "20240101")]
    assert partitions.discard_runs(spark, current) == []
    assert len(partitions.discard_runs(spark, history)) == 1
    assert rows(spark.table(current)) == [(1, "20240101")]
