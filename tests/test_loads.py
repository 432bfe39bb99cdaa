import pytest
from pyspark.sql import functions as F

from odsflow.config import Column, TableConfig
from odsflow.operators import audit, layouts, loads, runs
from odsflow.plans import daily
from odsflow.sources import files, partitions

CONFIG = TableConfig(
    columns=(Column(2, "v", "string"), Column(1, "k", "long", True)),
    keys=("K",),
    hive_table="thing_h",
)


def config(database, **changes):
    return TableConfig(**{**CONFIG.__dict__, "hive_db": database, **changes})


def data(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_slice_replaces_only_its_day(spark, database):
    table = layouts.create_table(spark, config(database), "slice")
    loads.load_slice(data(spark, (1, "a"), (2, None)), table, "20240101")
    loads.load_slice(data(spark, (3, "c")), table, "20240102")
    loads.load_slice(data(spark, (1, "z")), table, "20240101")
    assert rows(spark.table(table)) == [
        ("20240101", 1, "z", "20240101"), ("20240102", 3, "c", "20240102"),
    ]
    loads.load_slice(data(spark, (1, "z")).where("false"), table, "20240101")
    assert rows(spark.table(table)) == [("20240102", 3, "c", "20240102")]
    assert partitions.partition_values(spark, table) == ["20240101", "20240102"]


def test_failed_load_leaves_the_partition_as_it_was(spark, database):
    table = layouts.create_table(spark, config(database), "slice")
    loads.load_slice(data(spark, (1, "a")), table, "20240101")
    broken = data(spark, (2, "b")).withColumn("v", F.raise_error("source gone").cast("string"))
    with pytest.raises(Exception, match="source gone"):
        loads.load_slice(broken, table, "20240101")
    assert rows(spark.table(table)) == [("20240101", 1, "a", "20240101")]


def test_a_missing_column_is_refused(spark, database):
    table = layouts.create_table(spark, config(database), "append")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        loads.load_increment(data(spark, (1, "a")).drop("v"), table, "20240101")


def test_a_load_may_read_its_own_table(spark, database):
    table = layouts.create_table(spark, config(database), "replace")
    loads.load_replace(data(spark, (1, "a"), (2, "b")), table)
    loads.load_replace(spark.table(table).where("k = 2"), table)
    assert rows(spark.table(table)) == [(2, "b")]


def test_many_days_at_once_and_one_again(spark, database):
    table = layouts.create_table(spark, config(database), "append")
    many = spark.createDataFrame([(1, "a", "20240101"), (2, "b", "20240102")], "k int, v string, etl_dt string")
    loads.load_increments(many, table)
    loads.load_increment(data(spark, (5, "e")), table, "20240102")
    assert rows(spark.table(table)) == [(1, "a", "20240101"), (5, "e", "20240102")]


def test_hot_day_is_split_over_files(spark, database, monkeypatch):
    table = layouts.create_table(spark, config(database), "append")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        many = spark.range(60000).select(
            F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"),
            F.when(F.col("id") % 100 == 0, "20240102").otherwise("20240101").alias("etl_dt"),
        )
        loads.load_increments(many, table)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    used = spark.table(table).where("etl_dt = '20240101'").select(F.input_file_name()).distinct().count()
    assert used > 1
    assert spark.table(table).count() == 60000


def test_archive_and_reload(spark, database, tmp_path):
    table = layouts.create_table(spark, config(database), "append")
    loads.archive(data(spark, (1, "a")), f"{tmp_path}/stg/20240101")
    loads.reload_partition(spark, f"{tmp_path}/stg/20240101", table, "20240101", "etl_dt")
    assert rows(spark.table(table)) == [(1, "a", "20240101")]
    with pytest.raises(FileNotFoundError):
        loads.reload_partition(spark, f"{tmp_path}/stg/none", table, "20240101", "etl_dt")


def test_archives_are_never_overwritten(spark, database, tmp_path):
    path, table = f"{tmp_path}/stg/20240101", layouts.create_table(spark, config(database), "append")
    first = loads.archive(data(spark, (1, "a")), path)
    broken = data(spark, (1, "a")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        loads.archive(broken, path)
    # A folder without its mark is a load that did not end, whatever files it holds.
    data(spark, (9, "half")).write.parquet(f"{path}/00000007-half")
    assert loads.newest_archive(spark, path) == first
    second = loads.archive(data(spark, (2, "b")), path)
    assert rows(spark.read.parquet(first)) == [(1, "a")]
    loads.reload_partition(spark, path, table, "20240101", "etl_dt")
    assert rows(spark.table(table)) == [(2, "b", "20240101")]
    assert len(loads.discard_archives(spark, path)) >= 2
    assert loads.newest_archive(spark, path) == second and rows(spark.read.parquet(second)) == [(2, "b")]


def test_a_run_that_another_table_reads_is_kept(spark, database):
    days = layouts.create_table(spark, config(database), "append")
    spark.sql(f"CREATE TABLE {database}.curr (k BIGINT, v STRING) USING parquet")
    curr = f"{database}.curr"
    loads.load_replace(data(spark, (0, "own")), curr)
    loads.load_increment(data(spark, (1, "a")), days, "20240101")
    spec = (("etl_dt", "20240101"),)
    shared = partitions.table_details(spark, days, spec)["Location"]
    partitions.point_table(spark, curr, shared)
    home, run = partitions.run_of(shared)
    assert partitions.run_readers(spark, home, run) == [curr]
    loads.load_increment(data(spark, (2, "b")), days, "20240101")
    loads.load_increment(data(spark, (3, "c")), days, "20240102")
    assert partitions.discard_runs(spark, days) == []
    assert rows(spark.table(curr)) == [(1, "a")]
    # The current table drops its own earlier run, and none of the other table's.
    assert [n[:3] for n in partitions.discard_runs(spark, curr)] == ["all"]
    assert rows(spark.table(days)) == [(2, "b", "20240101"), (3, "c", "20240102")]
    # Its own loads go to its own home again; then nobody reads the shared run.
    loads.load_replace(data(spark, (4, "d")), curr)
    assert "curr_runs/" in partitions.table_location(spark, curr)
    assert partitions.discard_runs(spark, days) == []
    assert partitions.discard_runs(spark, curr) == [] and partitions.run_readers(spark, home, run) == []
    assert partitions.discard_runs(spark, days) == [run]
    assert rows(spark.table(days)) == [(2, "b", "20240101"), (3, "c", "20240102")]
    assert rows(spark.table(curr)) == [(4, "d")]


def test_a_dropped_table_keeps_no_run(spark, database):
    days = layouts.create_table(spark, config(database), "append")
    spark.sql(f"CREATE TABLE {database}.gone (k BIGINT, v STRING) USING parquet LOCATION '/tmp/none-{database}'")
    loads.load_increment(data(spark, (1, "a")), days, "20240101")
    shared = partitions.table_details(spark, days, (("etl_dt", "20240101"),))["Location"]
    partitions.point_table(spark, f"{database}.gone", shared)
    loads.load_increment(data(spark, (2, "b")), days, "20240101")
    assert partitions.discard_runs(spark, days) == []
    spark.sql(f"DROP TABLE {database}.gone")
    assert partitions.discard_runs(spark, days) == [partitions.run_of(shared)[1]]


def test_drop_truncate_and_copy(spark, database):
    table = layouts.create_table(spark, config(database), "append")
    other = layouts.create_table(spark, config(database), "append", table=f"{database}.other")
    for day in ("20240101", "20240102"):
        loads.load_increment(data(spark, (1, day)), table, day)
    files.copy_partition(spark, table, other, "etl_dt", "20240102")
    assert rows(spark.table(other)) == [(1, "20240102", "20240102")]
    partitions.drop_partitions(spark, table, lambda s: s["etl_dt"] < "20240102")
    assert partitions.partition_values(spark, table) == ["20240102"]
    partitions.truncate_table(spark, table)
    assert spark.table(table).count() == 0 and partitions.partition_values(spark, table) == []
    whole = layouts.create_table(spark, config(database), "replace", table=f"{database}.whole")
    loads.load_replace(data(spark, (1, "a")), whole)
    partitions.truncate_table(spark, whole)
    assert spark.table(whole).count() == 0


def test_two_partition_keys(spark, database, tmp_path):
    table = f"{database}.two"
    spark.sql(
        f"CREATE TABLE {table} (k bigint, biz_end_date string, process_start_datetime string)"
        " USING parquet PARTITIONED BY (biz_end_date, process_start_datetime)"
    )
    spark.range(3).withColumnRenamed("id", "k").write.parquet(f"{tmp_path}/20240101/a'b")
    spec = (("biz_end_date", "20240101"), ("process_start_datetime", "a'b"))
    partitions.mount_partitions(spark, table, {spec: f"{tmp_path}/20240101/a'b"})
    assert partitions.partition_specs(spark, table) == [spec]
    assert spark.table(table).count() == 3
    partitions.mount_partitions(spark, table, {})
    assert partitions.partition_specs(spark, table) == []


def test_current_and_history_mounts(spark, database, tmp_path):
    for name, k in (("202401010600", 1), ("202401011200", 2), ("202401011300ed", 3)):
        data(spark, (k, name)).withColumn("k", F.col("k").cast("long")).write.parquet(f"{tmp_path}/ods/20240101/{name}")
    listing = runs.list_runs(spark, f"{tmp_path}/ods")
    current = layouts.create_table(spark, config(database), "replace", table=f"{database}.thing_curr")
    path = runs.mount_current(spark, current, listing, "20240101")
    assert rows(spark.table(current)) == [(2, "202401011200")]
    every = layouts.create_table(spark, config(database), "base", table=f"{database}.thing_all")
    runs.mount_date(spark, every, "biz_end_date", "20240101", path)
    runs.mount_date(spark, every, "biz_end_date", "20240102", path)
    runs.mount_date(spark, every, "biz_end_date", "20240101", path.replace("1200", "0600"))
    assert rows(spark.table(every)) == [(1, "202401010600", "20240101"), (2, "202401011200", "20240102")]
    with pytest.raises(FileNotFoundError):
        runs.mount_current(spark, current, listing, "20240109")


def test_layout_columns_and_names(spark):
    cfg = config("ods", overrides={"v": "DECIMAL(10,2)"})
    assert layouts.layout_columns(cfg, "chain") == [
        ("etl_dt", "STRING"), ("start_dt", "STRING"), ("k", "BIGINT"), ("v", "DECIMAL(10,2)"), ("end_dt", "STRING"),
    ]
    assert layouts.table_name(cfg, "staging") == "ods.thing_m"
    shape, parts = layouts.layout_schema(cfg, "append")
    assert shape.simpleString() == "struct<k:bigint,v:decimal(10,2),etl_dt:string>" and parts == ["etl_dt"]
    assert layouts.table_name(cfg, "base") == "ods.thing_h_s"
    blob = config("ods", columns=(Column(1, "b", "blob"),))
    assert dict(layouts.layout_columns(blob, "slice"))["b"] == "BINARY"
    assert dict(layouts.layout_columns(blob, "append"))["b"] == "STRING"


def test_only_unused_run_folders_are_discarded(spark, database):
    table = layouts.create_table(spark, config(database), "append")
    for value in ("a", "b"):
        loads.load_increment(data(spark, (1, value)), table, "20240101")
    loads.load_increment(data(spark, (2, "c")), table, "20240102")
    assert [n[:8] for n in partitions.discard_runs(spark, table)] == ["20240101"]
    assert rows(spark.table(table)) == [(1, "b", "20240101"), (2, "c", "20240102")]
    assert partitions.discard_runs(spark, table) == []


def test_daily_runs_keep_a_copy_and_rebuild_from_it(spark, database, tmp_path):
    data(spark, (1, "a\nb"), (2, None)).write.parquet(f"{tmp_path}/src/thing.parquet")
    cfg = config(
        database, url=f"parquet:{tmp_path}/src", table="thing", source_root=f"{tmp_path}/ods",
        category_input="stg", path_db="shop", path_table="thing", schema_version="1",
    )
    table = layouts.create_table(spark, cfg, "slice")
    log = daily.run_slice(spark, cfg, "20240101").first()
    assert (log.db_name, log.source_count_1, log.target_count) == ("src", 2, 2)
    loaded = [("20240101", 1, "ab", "20240101"), ("20240101", 2, None, "20240101")]
    assert rows(spark.table(table)) == loaded
    kept = daily.archive_path(cfg, "20240101", "slice")
    assert spark.read.parquet(loads.newest_archive(spark, kept)).count() == 2
    partitions.drop_partitions(spark, table)
    daily.reload_slice(spark, cfg, "20240101")
    assert rows(spark.table(table)) == loaded


def test_chain_runs_close_and_open(spark, database, tmp_path):
    source = f"{tmp_path}/src/thing.parquet"
    data(spark, (1, "a"), (2, "b")).write.parquet(source)
    cfg = config(database, url=f"parquet:{tmp_path}/src", table="thing")
    chain, _ = layouts.create_chain_tables(spark, cfg, f"{tmp_path}/t")
    daily.run_chain_init(spark, cfg, "20240101")
    data(spark, (1, "a"), (2, "B"), (3, "c")).write.mode("overwrite").parquet(source)
    log = daily.run_chain(spark, cfg, "k > 1 and '%s' > ''", "20240102").first()
    assert (log.source_count_1, log.source_count_2, log.target_count) == (3, 3, 3)
    assert rows(spark.table(chain)) == sorted(
        [
            ("20240101", "19000101", 1, "a", "30001231"), ("20240101", "19000101", 2, "b", "20240102"),
            ("20240102", "20240102", 2, "B", "30001231"), ("20240102", "20240102", 3, "c", "30001231"),
        ]
    )


def test_audited_load_meets_in_one_row(spark, database):
    table = layouts.create_table(spark, config(database), "slice")
    source = data(spark, (1, "a"), (2, "b"))
    row = audit.audited(
        spark, "shop", "thing", "20240101",
        source=lambda: source,
        load=lambda: loads.load_slice(source, table, "20240101"),
        target=lambda: spark.table(table).where(audit.slice_condition("20240101")),
        run_time="20240101 01:02:03",
    ).first()
    assert (row.source_count_1, row.source_count_2, row.target_count) == (2, 2, 2)
    assert str(row.run_time) == "2024-01-01 01:02:03"
