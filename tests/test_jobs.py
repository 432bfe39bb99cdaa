"""SQL scripts, stored steps, staged and change-log runs, reports of lost values, the analysis' plan."""

import pytest
from pyspark.sql import functions as F

from odsflow.config import Column, TableConfig
from odsflow.operators import layouts, schema
from odsflow.plans import daily, repurchase, sql_jobs
from odsflow.sources import delimited, paths, rdbms


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# SQL scripts -------------------------------------------------------------------


def test_hints_stay_and_comments_go(spark):
    text = "select /*+ BROADCAST(b) */ a.id from a /* ; no /*+ hint */ join b on a.id = b.id -- ; end\n; select 2"
    assert [" ".join(s.split()) for s in sql_jobs.statements(text)] == [
        "select /*+ BROADCAST(b) */ a.id from a join b on a.id = b.id", "select 2",
    ]
    spark.range(10).createOrReplaceTempView("hint_a")
    spark.range(5).createOrReplaceTempView("hint_b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = sql_jobs.run_sql(spark, "select /*+ BROADCAST(b) */ * from hint_a a join hint_b b on a.id = b.id;")
        assert "BroadcastHashJoin" in plan_of(hinted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


COMPOUND = """
BEGIN
  DECLARE total INT DEFAULT 0;
  DECLARE i INT DEFAULT 0;
  WHILE i < 4 DO
    SET i = i + 1;
    IF i % 2 = 0 THEN
      BEGIN
        SET total = total + CASE WHEN i > 2 THEN 10 ELSE 1 END;
      END;
    END IF;
  END WHILE;
  SELECT total AS n, 'a;b' AS t;
END;
"""


def test_compound_statements_are_handed_over_whole(spark):
    assert len(sql_jobs.statements(COMPOUND)) == 1
    assert [s.split()[0] for s in sql_jobs.statements("select 1 begin;" + COMPOUND + "select case when true then 1 end; select 3")] == [
        "select", "BEGIN", "select", "select",
    ]
    assert rows(sql_jobs.run_sql(spark, COMPOUND)) == [(11, "a;b")]


def test_a_failed_step_leaves_the_last_table_whole(spark, database, tmp_path):
    def step(sql):
        return sql_jobs.run_steps(spark, [("kept", sql)], database=database)

    step("select 1 as n")
    with pytest.raises(Exception, match="lost"):
        step("select cast(raise_error('lost') as int) as n, 2 as m")
    assert rows(spark.table(f"{database}.kept")) == [(1,)]
    step("select 'other' as n, 2 as m")
    assert rows(spark.table(f"{database}.kept")) == [("other", 2)]
    # A step may read the table it replaces.
    step(f"select n, m + 1 as m from {database}.kept")
    assert rows(spark.table(f"{database}.kept")) == [("other", 3)]
    for n in (1, 2):
        done = sql_jobs.run_steps(spark, [("s", f"select {n} as n")], root=str(tmp_path))
        assert rows(done["s"]) == [(n,)]


# Runs --------------------------------------------------------------------------


def config(hive_db, tmp_path, **more):
    values = dict(
        columns=(Column(1, "k", "long", True), Column(2, "v", "string")), keys=("k",), hive_db=hive_db,
        hive_table="thing_h", url=f"parquet:{tmp_path}/src", table="thing", source_root=f"{tmp_path}/ods",
        category_input="stg", path_db="db", path_table="thing", schema_version="1",
    )
    return TableConfig(**{**values, **more})


def source(spark, tmp_path, *pairs, name="thing", ddl="k long, v string"):
    spark.createDataFrame(list(pairs), ddl).write.mode("overwrite").parquet(f"{tmp_path}/src/{name}.parquet")


def test_staged_runs_load_what_was_kept(spark, database, tmp_path):
    cfg = config(database, tmp_path)
    source(spark, tmp_path, (1, "a"), (2, "b"), (3, "c\n"))
    for layout in ("append", "staging", "base"):
        layouts.create_table(spark, cfg, layout)
    with pytest.raises(FileNotFoundError):
        daily.run_slice(spark, cfg, "20240101", staged=True, layout="base")
    daily.import_day(spark, cfg, "append", "20240101", "k > 1 and '%s' like '2024%'")
    daily.import_day(spark, cfg, "staging", "20240101", "k > 2")
    daily.import_day(spark, cfg, "base", "20240101")
    source(spark, tmp_path, (9, "changed since"))
    log = daily.run_increment(spark, cfg, "k > 1", "20240101", staged=True).first()
    assert (log["source_count_1"], log["target_count"]) == (1, 2)  # the source has changed: the log shows it
    assert rows(spark.table(f"{database}.thing_h").where("etl_dt = '20240101'")) == [(2, "b", "20240101"), (3, "c", "20240101")]
    daily.run_staging(spark, cfg, "k > 2", "20240101", staged=True)
    assert rows(spark.table(f"{database}.thing_m")) == [(3, "c", "20240101")]
    daily.run_slice(spark, cfg, "20240101", staged=True, layout="base")
    assert rows(spark.table(f"{database}.thing_h_s")) == [(1, "a", "20240101"), (2, "b", "20240101"), (3, "c", "20240101")]


def test_first_full_load_of_an_append_table(spark, database, tmp_path):
    cfg = config(database, tmp_path)
    source(spark, tmp_path, (1, "a"), (2, "b"))
    table = layouts.create_table(spark, cfg, "append")
    assert daily.run_increment_init(spark, cfg, "20240101").first()["target_count"] == 2
    source(spark, tmp_path, (2, "b"), (3, "c"))
    daily.run_increment(spark, cfg, "k > 2", "20240102")
    assert rows(spark.table(table)) == [(1, "a", "20240101"), (2, "b", "20240101"), (3, "c", "20240102")]


def test_change_log_runs(spark, database, tmp_path):
    cfg = config(database, tmp_path, use_chain=False)
    source(spark, tmp_path, (1, "one"), (2, "two"), (4, "quiet"))
    changes = [(10, 1, "i", "2024-01-02 08:00:00"), (11, 1, "u", "2024-01-02 09:00:00"), (12, 3, "d", "2024-01-02 10:00:00"), (13, 2, "u", "2024-01-03 00:00:00")]
    spark.createDataFrame(changes, "id long, key_k long, cdc_type string, t string").withColumn(
        "cdc_ts", F.to_timestamp_ntz("t")
    ).drop("t").write.parquet(f"{tmp_path}/src/thing_cdc.parquet")
    table = layouts.create_table(spark, cfg, "append")
    log = daily.run_cdc(spark, cfg, "20240102").first()
    assert (log["source_count_1"], log["target_count"]) == (2, 2)
    assert rows(spark.table(table)) == [(1, "one", "u", "20240102"), (3, None, "d", "20240102")]
    oracle = config(database, tmp_path, url="jdbc:oracle:x", database="S", table="T", use_chain=False)
    assert rdbms.cdc_query(oracle, "20240102") == (
        "select c.key_k k, b.v, c.cdc_type from (select key_k, cdc_type, row_number() over (partition by key_k order by id desc) nth"
        " from S.T_cdc where to_char(cdc_ts, 'YYYYMMDD') = '20240102') c left join S.T b on b.k = c.key_k where c.nth = 1"
    )
    mysql = config(database, tmp_path, url="jdbc:mysql://h/d", database="S", table="T")
    assert "date_format(cdc_ts, '%Y%m%d') = '20240102'" in rdbms.cdc_query(mysql, "20240102")


# Lost values -------------------------------------------------------------------


def test_lost_values_are_counted(spark):
    cfg = TableConfig(columns=(Column(1, "a", "int"), Column(2, "b", "date"), Column(3, "c", "string")))
    df = spark.createDataFrame([("1", "2024-01-01", "x"), ("one", "soon", None), (None, None, "y"), ("9" * 20, "", "z")], "a string, b string, c string")
    assert rows(schema.conform_losses(df, cfg)) == [("a", 2, "9" * 20), ("b", 2, "")]
    assert rows(schema.conform_losses(df.where("c = 'x'"), cfg)) == []
    assert rows(schema.conform_losses(df.where("false"), cfg)) == []


def test_lost_fields_are_counted(spark):
    shape = spark.sql("select 1 a, 's' b, cast(null as binary) c").schema
    lines = spark.createDataFrame([("1\x01x\x01AAE=",), ("one\x01\\N\x01\\N",), ("\\N\x01y",), ("",), ("2\x01z\x01?",)], "value string")
    assert rows(delimited.lost_fields(lines, shape)) == [
        ("a", 0, 2, ""), ("b", 1, 0, None), ("c", 2, 1, "?"),
    ]
    back = {str(tuple(r)) for r in delimited.from_lines(lines, shape).collect()}
    assert "(2, 'z', None)" in back and "(None, 'y', None)" in back


# The analysis ------------------------------------------------------------------


@pytest.fixture
def sales(spark, tmp_path):
    ints = "parent_id order_id cust_id cust_type order_type allot_quantity bargin_price receiver_country_id".split()
    ints += "receiver_province_id receiver_city_id shop_id order_source from_platform product_id order_status".split()
    detail = spark.range(600).select(
        *[((F.col("id") * (i + 3)) % 7).cast("int").alias(n) for i, n in enumerate(ints)],
        F.lit("2024-01-01").alias("order_creation_date"), F.lit("2024-01-15").alias("send_date"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 40_000).cast("timestamp_ntz").alias("data_date"),
    )
    detail.write.parquet(f"{tmp_path}/detail")
    product = spark.range(7).select(
        F.col("id").cast("int").alias("product_id"), F.when(F.col("id") > 1, F.col("id").cast("int")).alias("bd_id"),
        *[F.lit(f"text {n}").alias(n) for n in repurchase.PRODUCT_COLUMNS],
    )
    product.unionAll(product).write.parquet(f"{tmp_path}/product")
    return spark.read.parquet(f"{tmp_path}/detail"), spark.read.parquet(f"{tmp_path}/product")


def test_dates_reach_the_scan_and_texts_stay_out_of_the_distinct(spark, sales):
    detail, product = sales
    clean = repurchase.clean_detail(detail, product, "2024-01-03", "2024-02-01", sampled=detail.select("product_id"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(clean)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(data_date,2024-01-03T00:00)" in plan and "LessThan(data_date,2024-02-01T00:00)" in plan
    assert clean.columns == [*repurchase.LINE_COLUMNS, *repurchase.PRODUCT_COLUMNS, *repurchase.LAST_COLUMNS]
    assert clean.count() == clean.distinct().count() > 0
    text = spark._jvm.PythonSQLUtils.explainString(clean._jdf.queryExecution(), "formatted")
    lines = [part for part in text.split("\n\n") if "Exchange\n" in part and "parent_id" in part]
    assert lines and not any("category_path" in part for part in lines)


def test_the_job_stores_its_steps_once(spark, sales, tmp_path):
    detail, product = sales
    ranges = ("2024-01-01", "2025-01-01")
    windows = {"first": ("2024-01-01", "2024-02-01"), "none": ("2023-01-01", "2023-02-01")}
    steps = repurchase.repurchase_job(detail, product, ranges, windows, (2, 3), str(tmp_path / "job"))
    assert list(steps) == ["clean", "first_info", "first", "none_info", "none"]
    alone = repurchase.repurchase(detail, product, ranges, windows["first"], (2, 3))
    assert rows(steps["first"]) == rows(alone) != []
    assert rows(steps["none"]) == []
    assert all(len(paths.child_dirs(spark, f"{tmp_path}/job/{n}")) == 1 for n in steps)
