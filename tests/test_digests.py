"""Digest-first comparison and late-fetched newest rows, against their plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from odsflow.operators import diff, digests, latest
from odsflow.sizing import settle

SCHEMA = "k int, g string, v double, text string, tags array<string>"


def shuffled_columns(df):
    """Names of all columns that go into a shuffle or broadcast of the plan."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    assert inputs
    return {re.sub(r"#\d+L?$", "", c.strip()) for line in inputs for c in line.split(",")}


def snapshot(seed, changed=0.2):
    rng = random.Random(0)
    rows = [(k, rng.choice("ab"), rng.choice([None, 0.5, 1.5]), rng.choice([None, "", "x" * 50]), rng.choice([None, [], ["a", None]])) for k in range(300)]
    if seed == 0:
        return rows
    rng = random.Random(seed)
    out = []
    for k, g, v, text, tags in rows:
        dice = rng.random()
        if dice < changed / 4:
            continue
        if dice < changed:
            v, text = rng.choice([(None, text), (v, None), (v, ""), (7.0, text)])
        out.append((k, g, v, text, tags))
    return out + [(1000 + i, "n", None, "new", None) for i in range(5)]


def plain(row):
    return tuple(plain(v) if isinstance(v, (tuple, list)) else v for v in row) if row is not None else None


def stored(spark, rows):
    return settle(spark.createDataFrame(rows, SCHEMA), "test-snapshot")


@pytest.mark.parametrize("ranges", [1, 16, 65_536])
@pytest.mark.parametrize("seed", [1, 2])
def test_changes_equal_a_whole_comparison(spark, seed, ranges):
    old, new = stored(spark, snapshot(0)), stored(spark, snapshot(seed)).select("text", "k", "tags", "v", "g")
    wanted = diff.snapshot_diff(old, new, ["k", "g"]).where("outcome <> 'same'")
    found = digests.snapshot_changes(old, new, ["k", "g"], ranges)
    assert found.columns == wanted.columns
    assert sorted(map(plain, found.collect()), key=str) == sorted(map(plain, wanted.collect()), key=str)
    known = settle(digests.row_digests(old, ["k", "g"], ranges), "test-digests")
    again = digests.snapshot_changes(old, new, ["k", "g"], ranges, known)
    assert sorted(map(plain, again.collect()), key=str) == sorted(map(plain, wanted.collect()), key=str)


def test_equal_and_empty_snapshots(spark):
    old, none = stored(spark, snapshot(0)), stored(spark, [])
    assert digests.snapshot_changes(old, old, ["k", "g"]).collect() == []
    assert digests.snapshot_changes(none, none, ["k", "g"]).collect() == []
    assert {r["outcome"] for r in digests.snapshot_changes(old, none, ["k", "g"]).collect()} == {"deleted"}
    assert {r["outcome"] for r in digests.snapshot_changes(none, old, ["k", "g"]).collect()} == {"inserted"}


def test_values_that_look_alike_differ(spark):
    base = spark.range(1).select(F.lit(1).alias("k"), F.lit(None).cast("string").alias("a"), F.lit("x").alias("b"))
    swapped = base.select("k", F.col("b").alias("a"), F.col("a").alias("b"))
    empty = base.withColumn("a", F.lit(""))
    for other in (swapped, empty):
        assert [r["outcome"] for r in digests.snapshot_changes(base, other, ["k"]).collect()] == ["changed"]


def test_wrong_keys_and_types_fail(spark):
    rows = snapshot(0)
    old = stored(spark, rows)
    with pytest.raises(Exception, match="null key in snapshot"):
        digests.snapshot_changes(old, stored(spark, [(None, *rows[0][1:]), *rows]), ["k", "g"]).collect()
    with pytest.raises(Exception, match="key repeated in new snapshot"):
        digests.snapshot_changes(old, stored(spark, [(*rows[0][:2], 9.0, None, None), *rows]), ["k", "g"]).collect()
    with pytest.raises(TypeError, match="no digest"):
        digests.row_digests(old.withColumn("m", F.create_map("g", "v")), ["k"])


def test_unchanged_ranges_move_no_wide_row(spark):
    old = stored(spark, snapshot(0))
    new = stored(spark, [(*r[:3], "changed" if r[0] == 7 else r[3], r[4]) for r in snapshot(0)])
    one, other = (digests.row_digests(df, ["k", "g"]) for df in (old, new))
    places = digests.unequal_ranges(one, other)
    assert places.count() == 1
    assert shuffled_columns(places) <= {"_range", "n", "count", "sum", "_o", "_n", *(f"s{i}" for i in range(4))} | {
        c for c in shuffled_columns(places) if c.startswith(("sum", "count"))
    }
    keys = digests.changed_keys(one, other, ["k", "g"])
    assert [tuple(r) for r in keys.collect()] == [(7, old.where("k = 7").first()["g"], "changed")]
    assert not shuffled_columns(keys) & {"v", "text", "tags"}
    assert keys.count() == 1


# Newest rows ---------------------------------------------------------------------


@pytest.mark.parametrize("limit", ["125000000", "-1"])
def test_fetched_rows_equal_the_aggregate(spark, tmp_path, limit, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(7).write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for keys, order in ((["lang"], ["doc_id"]), (["source", "lang"], ["n_chars", "doc_id"])):
            wanted = latest.latest_per_key(files, keys, order)
            found = latest.latest_stored(files, keys, order)
            assert found.columns == files.columns
            assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_equal_order_values_give_one_row_a_key(spark, tmp_path):
    rows = [(k, "same", f"text {i}") for i, k in enumerate([1, 1, 1, 2, None, None])]
    spark.createDataFrame(rows, "k int, o string, text string").repartition(3).write.parquet(str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t"))
    found = latest.latest_stored(files, ["k"], ["o"]).collect()
    assert sorted(map(str, (r["k"] for r in found))) == ["1", "2", "None"]
    assert {tuple(r) for r in found} <= set(rows)
    assert latest.latest_stored(files.where("k > 5"), ["k"], ["o"]).collect() == []


def test_no_text_goes_into_the_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    addresses = latest.newest_addresses(docs, ["lang", "source"], ["doc_id"])
    assert not shuffled_columns(addresses) & {"text", "n_chars"}
    fetched = latest.latest_stored(docs, ["lang", "source"], ["doc_id"])
    assert not shuffled_columns(fetched) & {"text"}
