import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from odsflow.config import Column, TableConfig, parse_overrides
from odsflow.functions import cleaning, scalars
from odsflow.operators import layouts, loads, schema
from odsflow.settings import broadcast_limit
from odsflow.sizing import broadcast_if_small, is_small, measured_bytes
from odsflow.sources import counts, delimited, files, partitions, rdbms
from odsflow.streaming import intake

CONFIG_TEXT = """
{"usechain": "false", "db.url": "jdbc:oracle://db.example:1521/shop", "db.username": "u", "db.password": "p",
 "db.database": "SHOP", "db.table_name": "ITEM", "db.table_keys": " id , Sub", "hive_db": "ods", "hive_table": "item_h",
 "hdfs.root": "/ods", "hdfs.category.input": "stg", "hdfs.category.output": "out", "hdfs.db_name": "shop",
 "hdfs.table_name": "item", "hdfs.schema_version": "1", "sqoop.import-type": "inc", "sqoop.split-by": "id",
 "sqoop.map-column-hive": "price=DECIMAL(10,2),id=BIGINT",
 "columns": [{"columnid": 3, "name": "price", "type": "double", "primary_key": "false"},
             {"columnid": 1, "name": "id", "type": "tinyint", "primary_key": "true"},
             {"columnid": 2, "name": "SUB", "type": "string", "primary_key": "true"},
             {"columnid": 4, "name": "note", "type": "clob", "primary_key": "false"},
             {"columnid": 5, "name": "rid", "type": "rowid", "primary_key": "false"}]}
"""


def test_config_from_json():
    cfg = TableConfig.from_json(CONFIG_TEXT)
    assert [c.name for c in cfg.ordered] == ["id", "SUB", "price", "note", "rid"]
    assert cfg.key_names == ["id", "SUB"]
    assert cfg.dialect == "oracle" and not cfg.use_chain
    assert cfg.sql_type(cfg.ordered[2]) == "DECIMAL(10,2)"
    assert cfg.run_path(cfg.category_input, "20240101") == "/ods/stg/shop/item/1/20240101"
    with pytest.raises(ValueError, match="no SQL type"):
        cfg.sql_type(cfg.ordered[4])
    with pytest.raises(ValueError, match="no columns"):
        TableConfig(columns=()).ordered
    assert parse_overrides("") == {}
    assert "password" not in repr(cfg)


def test_jdbc_options():
    cfg = TableConfig.from_json(CONFIG_TEXT)
    options = rdbms.jdbc_options(cfg)
    assert options["dbtable"] == "SHOP.ITEM" and options["url"] == cfg.url and options["fetchsize"] == "10000"
    assert rdbms.quantile_query(cfg, 4, "x > 1") == (
        "select max(v) b from (select id v, ntile(4) over (order by id) g from SHOP.ITEM where x > 1) t group by g order by b"
    )
    assert rdbms.day_predicate("d = '%s' and n like '5%'", "20240101") == "d = '20240101' and n like '5%'"
    assert rdbms.export_options("jdbc:x:y", "t", "u")["user"] == "u"


def changed(cfg, **values):
    return TableConfig(**{**cfg.__dict__, **values})


def test_readers_get_conditions_by_quantile_or_hash():
    cfg = TableConfig.from_json(CONFIG_TEXT)
    asked = []

    def quantiles(query):
        asked.append(query)
        return [10, 20, 20, 99]

    found = rdbms.read_predicates(cfg, 4, quantiles, "d = 1")
    assert found == [f"({p}) and (d = 1)" for p in ("id <= 10 or id is null", "id > 10 and id <= 20", "id > 20")]
    assert "ntile(4)" in asked[0] and "where d = 1" in asked[0]
    assert rdbms.read_predicates(cfg, 1, quantiles) == ["1 = 1"]
    keyed = changed(cfg, split_by="")
    assert rdbms.read_predicates(keyed, 2, quantiles) == ["ora_hash(id, 1) = 0", "ora_hash(id, 1) = 1"]
    mysql = changed(keyed, url="jdbc:mysql://h:1/d")
    assert rdbms.read_predicates(mysql, 2, quantiles, "d = 1")[1] == "(mod(crc32(coalesce(id, '')), 2) = 1) and (d = 1)"
    assert len(asked) == 1
    with pytest.raises(ValueError, match="no hash"):
        rdbms.read_predicates(changed(keyed, url="jdbc:other:x"), 2, quantiles)
    assert rdbms.range_predicates("t", [dt.date(2024, 1, 2), None, "o'clock"])[1:] == [
        "t > date '2024-01-02' and t <= 'o''clock'", "t > 'o''clock'",
    ]
    assert rdbms.range_predicates("t", []) == ["1 = 1"]


@pytest.mark.parametrize("column", ["n", "s", "t", "m"])
@pytest.mark.parametrize("readers", [1, 2, 5])
def test_conditions_cover_every_row_once_and_evenly(spark, tmp_path, column, readers):
    skewed = F.when(F.col("id") % 3 == 0, None).otherwise(F.pow(F.col("id") % 50, 3).cast("long"))
    spark.range(3000).select(
        "id", skewed.alias("n"), F.concat(F.lit("it's "), skewed.cast("string")).alias("s"),
        F.timestamp_seconds(skewed).cast("timestamp_ntz").alias("t"), (skewed / 7).cast("decimal(12,3)").alias("m"),
    ).write.parquet(f"{tmp_path}/thing.parquet")
    rows = spark.read.parquet(f"{tmp_path}/thing.parquet")
    cuts = rows.select(column, F.ntile(readers).over(Window.orderBy(column)).alias("g")).groupBy("g").agg(F.max(column).alias("b"))
    bounds = [r["b"] for r in cuts.orderBy("b").collect()][:-1]
    ranges = rdbms.range_predicates(column, bounds)
    for parts in (ranges, rdbms.hash_predicates(column, readers)):
        hit = rows.select("id", *[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(parts)])
        total = sum((F.col(f"p{i}") for i in range(len(parts))), F.lit(0))
        assert hit.where(total != 1).isEmpty()
    sizes = [rows.where(p).count() for p in ranges]
    assert sum(sizes) == 3000 and max(sizes) <= 1000 + 3000 / readers + 50


def test_counts_come_from_footers(spark, database, tmp_path):
    cfg = TableConfig(columns=(Column(1, "k", "long", True), Column(2, "v", "string")), hive_db=database, hive_table="t_h")
    table = layouts.create_table(spark, cfg, "append")
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for day, n in (("20240101", 100), ("20240102", 7), ("20240103", 0)):
        loads.load_increment(rows.where(F.col("k") < n), table, day)
    assert counts.stored_count(spark, table) == 107
    assert counts.stored_count(spark, table, lambda s: s["etl_dt"] == "20240102") == 7
    assert counts.stored_count(spark, table, lambda s: s["etl_dt"] == "20240103") == 0
    assert counts.stored_count(spark, table, lambda s: False) == 0
    place = partitions.table_details(spark, table, (("etl_dt", "20240101"),))["Location"]
    plan = counts.footer_counts(spark, [place])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    plain = layouts.create_table(spark, cfg, "replace", table=f"{database}.plain")
    assert counts.stored_count(spark, plain) == 0
    loads.load_replace(rows, plain)
    assert counts.stored_count(spark, plain) == 100
    # The session's own readers stay as they were.
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_source_counts(spark, tmp_path):
    cfg = TableConfig.from_json(CONFIG_TEXT)
    options = counts.count_options(cfg, "d = '20240101'")
    assert options["query"] == "select count(*) n_rows from SHOP.ITEM where d = '20240101'"
    assert options["url"] == cfg.url and "dbtable" not in options
    spark.range(30).write.parquet(f"{tmp_path}/ITEM.parquet")
    folder = changed(cfg, url=f"parquet:{tmp_path}")
    assert (counts.source_count(spark, folder), counts.source_count(spark, folder, "id < 4")) == (30, 4)


def test_conversions_by_dialect(spark):
    df = spark.sql(
        "select cast(1 as tinyint) id, 's' SUB, 1.5D price, 'long' note, 'AAB' rid"
    )
    cfg = TableConfig.from_json(CONFIG_TEXT)
    oracle = schema.convert_columns(df, cfg)
    assert oracle.columns == ["id", "SUB", "price", "note", "g_rid"]
    assert oracle.first().note is None
    mysql = schema.convert_columns(df, cfg, "mysql")
    assert mysql.schema["id"].dataType.simpleString() == "int" and "rid" in mysql.columns
    assert "note" not in str(oracle._jdf.queryExecution().optimizedPlan().toString().split("OneRow")[-1])


def test_conform_orders_casts_and_adds_change_type(spark):
    cfg = TableConfig.from_json(CONFIG_TEXT.replace('"rowid"', '"string"'))
    df = spark.createDataFrame(
        [("u", "r", "n", "3.456", "s", "7"), ("d", None, None, "oops", "s", "x")],
        "cdc_type string, rid string, note string, price string, SUB string, id string",
    )
    out = schema.conform(df, cfg)
    assert out.columns == ["id", "SUB", "price", "note", "rid", "cdc_type"]
    assert [tuple(r)[:3] for r in out.collect()] == [(7, "s", Decimal("3.46")), (None, "s", None)]


def test_drift_is_one_way(spark):
    status = spark.createDataFrame(
        [
            ("r1", '{"columns":[{"name":"a","type":"int"},{"name":"b","type":"string"},{"name":"c","type":"x"}]}'),
            ("r2", '{"columns":[{"name":"a","type":"long"}]}'),
            ("r3", ""),
        ],
        "run string, schema_json string",
    )
    drift = schema.schema_drift(status, [("a", "int"), ("b", "string")])
    assert sorted(map(tuple, drift.collect()), key=str) == [
        ("r2", "a", "int", "long"), ("r2", "b", "string", None),
        ("r3", "a", "int", None), ("r3", "b", "string", None),
    ]


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (1, "  padded ", 1.5e20, Decimal("1.20"), dt.date(2024, 1, 2), True, bytearray(b"\x01\n")),
            (2, "", None, None, None, None, None),
            (3, None, -0.1, Decimal("-7.00"), dt.date(1900, 1, 1), False, bytearray()),
            (4, 'quote " comma , back\\slash \x00 nul', 3.0, None, None, None, None),
        ],
        "k long, s string, d double, m decimal(10,2), t date, f boolean, b binary",
    )
    df = df.withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-02 03:04:05.678901"))).select("*")
    delimited.write_delimited(df, f"{tmp_path}/x")
    back = delimited.read_delimited(spark, f"{tmp_path}/x", df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    one = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    delimited.write_delimited(one, f"{tmp_path}/y")
    assert sorted(map(tuple, delimited.read_delimited(spark, f"{tmp_path}/y", one.schema).collect()), key=str) == sorted(
        [("",), (None,), ("a",)], key=str
    )


def test_drop_delims_and_fingerprints(spark):
    df = spark.createDataFrame([("a\nb\rc\u0001d", 1)], "s string, k int")
    assert cleaning.drop_delims(df).first().s == "abcd"
    pair = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "x string, y string, z string")
    assert pair.select(cleaning.row_md5(["x", "y", "z"])).distinct().count() == 3
    assert cleaning.stamp(df, "20240101").columns == ["etl_dt", "s", "k"]


@pytest.mark.parametrize("size", [0, 1, 57, 58, 300])
def test_base64_lines(spark, size):
    import base64

    text = "x" * size
    got = spark.range(1).select(scalars.b64_encode(F.lit(text)).alias("e")).select("e", scalars.b64_decode(F.col("e"))).first()
    assert tuple(got) == (base64.encodebytes(text.encode()).decode(), text)


def test_run_names(spark):
    names = spark.createDataFrame(
        [("202401020304",), ("20240102030405",), ("2024",), ("20241301000000",), ("x" * 14,)], "n string"
    )
    parsed = [r[0] and str(r[0]) for r in names.select(scalars.parse_run(F.col("n"))).collect()]
    assert parsed == ["2024-01-02 03:04:00", "2024-01-02 03:04:05", None, None, None]


def test_export_in_parts(spark, tmp_path):
    df = spark.range(1000).select("id", F.lit("v").alias("v"))
    data, sums = files.export_file(df, str(tmp_path), "20240101", "shop", "t", rows_per_file=100)
    checked = files.verify_export(spark, data, sums).collect()
    assert len(checked) >= 10 and all(r.intact for r in checked)
    assert spark.read.text(data).count() == 1000
    spark.range(1).select(F.lit("extra")).write.mode("append").text(data)
    assert sum(not r.intact for r in files.verify_export(spark, data, sums).collect()) == 1


def exported(spark, folder, part_bytes, df):
    names = files.write_parts(df, folder, part_bytes)
    assert [n for n in names if not n.startswith("part-")] == []
    sizes = {r["file"]: r["n_bytes"] for r in files.part_lengths(spark, folder).collect()}
    assert sorted(sizes) == names
    back = delimited.read_delimited(spark, folder, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    return [sizes[n] for n in names]


def test_parts_are_even_beside_a_wide_row(spark, tmp_path):
    row = F.when(F.col("id") == 777, F.repeat(F.lit("w"), 900)).otherwise(F.repeat(F.lit("v"), (F.col("id") % 7).cast("int")))
    for tasks in (1, 5):
        df = spark.range(3000).repartition(tasks).select("id", row.alias("v"))
        sizes = exported(spark, f"{tmp_path}/{tasks}", 1000, df)
        assert max(sizes) <= 1000
        # All but the last part, and the wide row's, are half the bound, give or take a line.
        normal = [n for n in sizes if n < 900]
        assert sum(n < 480 for n in normal) <= 1 and max(normal) < 520
        assert len(sizes) - len(normal) == 1


def test_parts_of_rows_above_the_bound_and_of_nothing(spark, tmp_path):
    wide = spark.range(6).select(F.repeat(F.col("id").cast("string"), 50).alias("v"))
    assert exported(spark, f"{tmp_path}/wide", 20, wide) == [51] * 6
    assert exported(spark, f"{tmp_path}/none", 20, wide.where("false")) == []
    assert spark.read.text(f"{tmp_path}/none").isEmpty()


def test_an_export_runs_its_query_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = spark.range(500).mapInArrow(counted, "id long")
    data, sums = files.export_file(df, str(tmp_path), "20240101", "shop", "t", part_bytes=600)
    assert runs.value == 500
    assert files.verify_export(spark, data, sums).where(~F.col("intact")).isEmpty()
    assert spark.read.text(data).count() == 500


def test_a_part_too_long_to_hash_is_refused(spark, tmp_path, monkeypatch):
    spark.range(100).select(F.lit("long line")).write.text(f"{tmp_path}/x")
    monkeypatch.setattr(files, "HASHED_BYTES", 50)
    with pytest.raises(ValueError, match="at most 50"):
        files.manifest(spark, f"{tmp_path}/x")


def test_long_binary_values_stay_in_their_row(spark, tmp_path):
    df = spark.createDataFrame([(1, bytes(range(200))), (2, b"\n" * 300)], "id long, b binary")
    delimited.write_delimited(df, f"{tmp_path}/b")
    back = delimited.read_delimited(spark, f"{tmp_path}/b", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_staged_runs_are_taken_once(spark, tmp_path):
    staged, ods, marks = (f"{tmp_path}/{n}" for n in ("stg", "ods", "marks"))
    spark.range(5).write.parquet(f"{staged}/20240101/202401010600")
    shape = spark.range(1).schema

    def take():
        return sum(p["numInputRows"] for p in intake.intake(spark, staged, ods, shape, marks).recentProgress)

    assert (take(), take()) == (5, 0)
    spark.range(3).write.parquet(f"{staged}/20240102/202401020600")
    assert take() == 3
    taken = intake.read_taken(spark, ods, shape)
    assert {tuple(r) for r in taken.groupBy("date", "run").count().collect()} == {
        ("20240101", "202401010600", 5), ("20240102", "202401020600", 3),
    }


def test_an_intake_of_few_files(spark, tmp_path):
    staged, ods, marks = (f"{tmp_path}/{n}" for n in ("stg", "ods", "marks"))
    for run in ("202401010600", "202401011200"):
        spark.range(400).repartition(9).write.parquet(f"{staged}/20240101/{run}")
    shape = spark.range(1).schema
    intake.intake(spark, staged, ods, shape, marks, files_per_run=2)
    taken = intake.read_taken(spark, ods, shape)
    assert taken.count() == 800
    files_of = taken.groupBy("run").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()
    assert all(r["n"] <= 2 for r in files_of)


def test_only_measured_sides_are_broadcast(spark):
    df = spark.range(1000).select("id", F.lit("0123456789").alias("s"))
    assert 30_000 < measured_bytes(df) < 100_000
    assert is_small(df, 100_000) and not is_small(df, 1_000) and not is_small(df, 0)
    big = spark.range(10)
    hinted = big.join(broadcast_if_small(df, 100_000), "id")
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    plain = big.join(broadcast_if_small(df, 1_000), "id")
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for text, size in (("10mb", 10 * 2**20), ("-1", 0), ("512", 512), ("2g", 2**31)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert broadcast_limit(spark) == size
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
