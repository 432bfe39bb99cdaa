import pytest
from pyspark.sql import functions as F

from odsflow import sizing
from odsflow.functions.scalars import day_bounds
from odsflow.operators import audit, cdc, diff, latest, runs, skew
from odsflow.plans import repurchase, sql_jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_and_newest(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 9, "b"), (2, 1, None)], "k int, n int, v string"
    ).select("v", "k", "n")
    assert rows(latest.latest_per_key(df, ["k"], ["n"])) == [("a", 1, 10), (None, 2, 1)]
    assert rows(latest.newest(df, ["k"], ["n"])) == [(1, 10), (2, 1)]


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max(") > plan.index("Exchange")


def test_cdc_keeps_deleted_keys_and_composite_keys(spark):
    log = spark.createDataFrame(
        [
            (1, 1, "a", "i", "2024-01-01 10:00:00"), (2, 1, "a", "u", "2024-01-01 11:00:00"),
            (3, 2, "a", "d", "2024-01-01 12:00:00"), (4, 1, "a", "d", "2024-01-02 00:00:00"),
            (5, 1, "b", "u", "2024-01-01 23:59:59"),
        ],
        "id int, key_k int, key_g string, cdc_type string, ts string",
    ).withColumn("cdc_ts", F.to_timestamp_ntz("ts"))
    base = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (7, "a", "z")], "k int, g string, v string")
    assert rows(cdc.cdc_latest(log, base, ["k", "g"], "20240101")) == [
        (1, "a", "x", "u"), (1, "b", "y", "u"), (2, "a", None, "d"),
    ]


def test_split_join_equals_a_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 900).alias("k"), "id"
    )
    right = spark.range(0, 1000, 2).selectExpr("id as k", "id * 2 as v").unionAll(
        spark.sql("select 7L k, 1L v union all select 7L, 2L union all select null, 3L")
    )
    assert rows(skew.hot_keys(left, "k", rows=300, fraction=1)) == [(7, 4)]
    assert rows(skew.hot_keys(left.where("false"), "k", rows=300, fraction=1)) == []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = rows(left.join(right, "k"))
    try:
        for limit, salted in ((before, False), ("4000", True), ("-1", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            joined = skew.split_join(left, right, "k", rows=300, fraction=1)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert ("_slice" in plan) == salted
            assert plan.count("Range (0, 3000") == 1
            assert rows(joined) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_products_are_not_gathered_for_the_distinct(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    monkeypatch.setattr(skew, "FRACTION", 1)
    names = (
        "parent_id order_id cust_id cust_type order_type allot_quantity bargin_price receiver_country_id"
        " receiver_province_id receiver_city_id shop_id order_source from_platform order_status"
        " order_creation_date send_date"
    ).split()
    detail = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 97).alias("product_id"),
        F.lit("2024-01-01").alias("data_date"),
        # Lines that differ stay apart in the distinct before the join.
        *[(F.col("id") % (4000 if n == "parent_id" else 50)).cast("int").alias(n) for n in names],
    )
    product = spark.range(97).select(
        F.col("id").alias("product_id"), (F.col("id") % 5).cast("int").alias("bd_id"),
        *[F.lit(n).alias(n) for n in ("category_path", "category_path2", "path2_name", "category_path3", "path3_name")],
    )
    small = repurchase.clean_detail(detail, product, "2024-01-01", "2024-02-01")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
        split = repurchase.clean_detail(detail, product, "2024-01-01", "2024-02-01")
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "_slice" in plan and plan.count("Range (0, 4000") == 1
        assert rows(split) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tasks_of_a_join_hold_a_bounded_number_of_rows(spark, monkeypatch):
    left = spark.range(12_000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        expected = rows(left.join(right, "k"))
        monkeypatch.setattr(sizing, "PART_ROWS", 500)
        # Without hot keys, and with every key of four rows dealt to slices; then keys of two types.
        for hot in (None, 3):
            joined = skew.split_join(left, right, "k", rows=hot, fraction=1)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("hashpartitioning(k") == 2 and plan.count(", 24), REPARTITION_BY_NUM") == 2
            assert rows(joined) == expected
            tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert len(tasks) >= 20 and max(tasks) < 500
        # A key with more rows than a partition is hot then.
        monkeypatch.setattr(skew, "PART_ROWS", 500)
        heavy = left.withColumn("k", F.when(F.col("v") % 3 == 0, 8).otherwise(F.col("k")))
        joined = skew.split_join(heavy, right, "k", fraction=1)
        assert max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()) < 1500
        assert rows(joined) == rows(heavy.join(right, "k"))
        narrow = right.withColumn("k", F.col("k").cast("int"))
        mixed = skew.split_join(left, narrow, "k", fraction=1)
        assert rows(mixed) == expected and "REPARTITION_BY_NUM" not in mixed._jdf.queryExecution().executedPlan().toString()
        assert rows(skew.split_join(left.where("false"), right, "k", fraction=1)) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tasks_of_the_distribution_hold_a_bounded_number_of_rows(spark, monkeypatch):
    info = spark.range(9000).select(
        (F.col("id") % 3000).alias("cust_id"), (F.col("id") % 4).cast("int").alias("bd_id"),
        (F.col("id") % 2).cast("int").alias("shop_id"), (F.col("id") % 5).alias("ck_parent_id"), F.col("id").alias("ck_amt"),
    )
    plain = repurchase.distribution(info)
    monkeypatch.setattr(sizing, "PART_ROWS", 500)
    parts = sizing.task_parts(spark, info.count())
    dealt = repurchase.distribution(info, parts=parts)
    assert parts == 18 and "18), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert rows(dealt) == rows(plain) != []
    assert sizing.task_parts(spark, 2000) is None


def test_day_bounds_reach_the_scan(spark, tmp_path):
    spark.sql("select timestamp_ntz'2024-01-01 10:00:00' ts, 1 k").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    plan = df.where(day_bounds(df, "ts", "20240101"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts,2024-01-02T00:00)" in plan


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, None), (5, "e")], "k int, v string")
    out = diff.snapshot_diff(old, new, ["k"]).select("k", "outcome")
    assert rows(out) == [(1, "same"), (2, "same"), (3, "changed"), (4, "deleted"), (5, "inserted")]
    with pytest.raises(Exception, match="key repeated in new snapshot"):
        diff.snapshot_diff(old, new.unionAll(new), ["k"]).collect()
    every = diff.all_columns_diff(old.unionAll(old), new)
    assert rows(every) == sorted(
        [
            (1, "a", 2, 1, "same"), (2, None, 2, 1, "same"), (3, "c", 2, 0, "deleted"),
            (4, None, 2, 0, "deleted"), (3, None, 0, 1, "inserted"), (5, "e", 0, 1, "inserted"),
        ],
        key=str,
    )


def test_newest_runs(spark):
    df = spark.createDataFrame(
        [("d1", "202401010600", 1), ("d1", "202401011200", 2), ("d2", "202401010700", 3), ("d2", "bad", 4)],
        "date string, run string, n int",
    )
    assert [r.n for r in runs.latest_run(df, "run").collect()] == [2]
    assert sorted(r.n for r in runs.latest_run_per_date(df, "date", ["run"]).collect()) == [2, 4]


def test_chain_runs_compare_ids_as_numbers(spark):
    status = runs.parse_status(
        spark.createDataFrame([("20240103060000_9\t{}",), ("20240103060000_10",), ("",)], "value string")
    )
    assert rows(status) == [("20240103060000", 10, None), ("20240103060000", 9, "{}")]
    listing = spark.createDataFrame(
        [
            ("20240101", "20240101060000", 9), ("20240101", "20240101060000", 10),
            ("20240102", "20240102060000", 1), ("success", "20240109060000", 1), ("20991231", "20240109060000", 1),
        ],
        "date string, ts string, id long",
    )
    assert rows(runs.resolve_chain_runs(status, listing, "20240104")) == [
        ("20240101", "20240101060000_10"), ("20240102", "20240102060000_1"), ("20991231", "20240103060000_10"),
    ]
    assert {r.run for r in runs.resolve_chain_runs(status, listing, "20240103").collect()} == {"20240103060000_10"}
    nothing = runs.resolve_chain_runs(status, listing.where("false"), "20240103")
    assert rows(nothing) == [("20991231", "20240103060000_10")]


def test_readiness_is_strict(spark):
    df = spark.createDataFrame([("a", "2024-01-01 06:00:00"), ("b", "2024-01-01 06:00:01")], "t string, s string")
    df = df.select("t", F.to_timestamp_ntz("s").alias("ts"))
    out = runs.readiness(df, "2024-01-01 06:00:00", ["t"])
    assert {r.t: r.ready for r in out.collect()} == {"a": False, "b": True}


LOG = "db_name string, table_name string, data_date date, run_time timestamp_ntz, " + ", ".join(
    f"{c} long" for c in audit.LOG_COUNTS
)


def test_log_rounds(spark):
    def counted(day, n):
        return audit.log_row(spark, "s", "t", day, "20240101 06:00:00", {}).select(
            *audit.LOG_KEYS, F.lit(n).cast("long").alias("n_rows")
        )

    log = spark.createDataFrame([], LOG)
    for day, n, turn in (
        ("20240101", 5, "source_before"), ("20240101", 6, "target"), ("20240101", 7, "source_after"),
        ("20240102", 8, "target"), ("20240102", 9, "source_after"),
    ):
        log = audit.write_log(log, counted(day, n), turn)
    shown = log.select("data_date", *audit.LOG_COUNTS)
    assert [tuple(r)[1:] for r in shown.orderBy("data_date").collect()] == [(5, 7, 6), (None, 9, 8)]
    again = audit.write_log(log, counted("20240101", 1), "source_before")
    first = again.orderBy("data_date").first()
    assert tuple(first[c] for c in audit.LOG_COUNTS) == (1, None, None)


def test_batch_log_replaces_whole_rows(spark):
    shape = "sys string, step int, data_dt string, complete_time string, note string"
    log = spark.createDataFrame([("a", 1, "d", "t1", "keep?")], shape)
    new = spark.createDataFrame([("a", 1, "d", "t2", None), ("a", 1, "d", "t3", None), ("b", 1, "d", "t0", "n")], shape)
    assert rows(audit.batch_complete(log, new)) == [("a", 1, "d", "t3", None), ("b", 1, "d", "t0", "n")]


def test_reconcile(spark):
    def days(*n):
        return spark.createDataFrame([(d,) for d in n], "d int")

    out = audit.reconcile(days(1, 1, 2, 3), days(1, 1, 2, 2), days(1, 1, 2, 3, 3), ["d"])
    assert rows(out) == [(1, 2, 2, 2, "ok"), (2, 1, 1, 2, "differs"), (3, 1, 2, 0, "moving")]


def test_repurchase_regroups_counts_per_customer(spark):
    info = spark.createDataFrame(
        [(1, 4, 0, 2, 10), (1, 4, 1, 1, 5), (2, 4, 0, 2, 1), (2, 9, 0, 2, 3)],
        "cust_id int, bd_id int, shop_id int, ck_parent_id long, ck_amt long",
    )
    out = {(r.bd_id, r.shop_id, r.ck_parent_id): (r.ck_custnum, r.ck_amt) for r in repurchase.distribution(info).collect()}
    assert out[("4", "0", 2)] == (2, 11)
    assert out[("4", "zy+pt", 2)] == (2, 11) and out[("4", "zy+pt", 1)] == (1, 5)
    assert out[("rbz", "0", 2)] == (2, 14) and out[("rbz", "zy+pt", 2)] == (2, 14)
    plan = repurchase.distribution(info)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_steps_as_tables(spark, database):
    steps = [("first", "select :n as n"), ("second", f"select n + 1 as n from {database}.first")]
    for n in (1, 5):
        done = sql_jobs.run_steps(spark, steps, {"n": n}, database=database)
        assert done["second"].first().n == n + 1
    assert spark.catalog.tableExists(f"{database}.second")


def test_sql_text(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("sql_numbers")
    out = sql_jobs.run_sql(
        spark,
        "-- first; second\ncreate or replace temporary view sql_big as"
        " select id, ';' as m from sql_numbers where id > ${hiveconf:low};\nselect * from identifier(:src) where m = :mark",
        {"low": 2, "src": "sql_big", "mark": ";"},
    )
    assert [r.id for r in out.collect()] == [3, 4]
    assert spark.conf.get("low", None) is None
    assert "LocalTableScan" not in out._jdf.queryExecution().executedPlan().toString()
    assert sql_jobs.statements("a ';' b; -- c;\n/* ; */ d;;") == ["a ';' b", "d"]
    for name in ("one", "two"):
        spark.range(1).select(F.lit("select 1")).coalesce(1).write.mode("append").text(f"{tmp_path}/sql")
    with pytest.raises(ValueError):
        sql_jobs.run_sql_file(spark, f"{tmp_path}/sql")
    with pytest.raises(Exception):
        sql_jobs.run_steps(spark, [("sql_one", "select 1 a"), ("sql_two", "select nope from sql_one"), ("sql_three", "select 1")])
    assert spark.catalog.tableExists("sql_one") and not spark.catalog.tableExists("sql_three")
