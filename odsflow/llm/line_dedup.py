"""Lines that repeat across documents, kept in the first document only.

The seen lines are held as levelled sorted runs: tables of (128-bit hash, first
document) sorted by hash and bucketed by its leading bits. A new batch reduces
its own lines to one row per hash, merge-anti-joins every run, and adds what is
new as a run of level 0. Where a level holds ``fan_out`` runs they are merged
into one run of the next level, so a batch meets a logarithmic number of runs
and a row is rewritten once a level.

Batches come in the order of their documents: a hash's first document is the
least doc_id of the first batch that holds it. A line's key is the line without
white space at its ends, A-Z lower-cased; keys below ``least`` code points are
never dropped. All lines of a dropped key go, except in its first document,
where all of them stay.

Defined cases: a null or empty text is one empty line and becomes empty text;
rows that share a doc_id are one document for the choice of the first, and each
keeps its own text; a row without doc_id drops nothing and is no key's first
document; an empty table gives no rows; a column named like a result is
replaced, others pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.llm.store import carried, restored, settle
from odsflow.settings import fresh_dir

LEAST = 10
FAN_OUT = 3
BATCHES = 4

_ENDS = "\x20\x09\x0a\x0b\x0c\x0d"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(_ENDS)), _UPPER, _LOWER)


def hashes(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), F.reverse(key)).alias("h2")]


def lines_of(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, h1, h2) of every line whose key is long enough."""
    known = docs.where(F.col("doc_id").isNotNull())
    exploded = known.select("doc_id", F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    keyed = exploded.select("doc_id", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= least).select("doc_id", *hashes(F.col("key")))


class LineRuns:
    """Levelled sorted runs of line hashes: ``h1, h2, first``."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark = spark
        self.fan_out = fan_out
        self.levels: list[list[DataFrame]] = []

    def _store(self, run: DataFrame, presorted: bool = False) -> DataFrame:
        folder = fresh_dir(self.spark, "llm-run")
        if not presorted:
            run = run.repartitionByRange("h1").sortWithinPartitions(*HASH)
        run.write.parquet(folder)
        return self.spark.read.schema("h1 long, h2 long, first long").parquet(folder)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Add a later batch: ``lines`` has doc_id, h1, h2, a row for each line or fewer."""
        own = lines.groupBy(*HASH).agg(F.min("doc_id").alias("first"))
        for run in self.runs():
            own = own.join(run.hint("merge"), HASH, "left_anti")
        self._insert(self._store(own), 0)

    def _insert(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            merged = self._store(reduce(DataFrame.unionByName, self.levels[level]))
            self.levels[level] = []
            self._insert(merged, level + 1)

    def first_seen(self) -> DataFrame:
        """One row per hash: h1, h2, first. Runs never share a hash."""
        found = self.runs()
        if not found:
            return self.spark.createDataFrame([], "h1 long, h2 long, first long")
        return reduce(DataFrame.unionByName, found)


def dedup_lines(docs: DataFrame, least: int = LEAST, batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and n_lines, n_dropped.

    The table goes through the runs in ``batches`` ranges of doc_id.
    """
    spark = docs.sparkSession
    lines = settle(lines_of(docs, least).distinct(), "lines")
    low, high = lines.agg(F.min("doc_id"), F.max("doc_id")).first()
    runs = LineRuns(spark, fan_out)
    if low is not None:
        step = (high - low) // batches + 1
        for i in range(batches):
            start = low + i * step
            if start <= high:
                runs.add(lines.where((F.col("doc_id") >= start) & (F.col("doc_id") < start + step)))
    # A key of one document has no row but that of its first document, and drops nothing.
    dropped = lines.join(runs.first_seen(), HASH).where(F.col("doc_id") != F.col("first"))
    return without_lines(docs, dropped, least)


def without_lines(docs: DataFrame, dropped: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without the lines whose (doc_id, h1, h2) is in ``dropped``."""
    gone = dropped.groupBy(F.col("doc_id").alias("_gone_id")).agg(F.collect_set(F.struct(*HASH)).alias("_gone"))
    split = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    joined = carried(docs).join(gone, F.col("doc_id") == F.col("_gone_id"), "left")

    def stays(line: Column) -> Column:
        key = line_key(line)
        return (F.length(key) < least) | ~F.array_contains(F.col("_gone"), F.struct(*hashes(key)))

    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays))
    staged = joined.withColumn("_lines", split).withColumn("_kept", kept)
    n_lines = F.size("_lines").cast("long")
    staged = staged.withColumns({"n_lines": n_lines, "n_dropped": (n_lines - F.size("_kept")).cast("long")})
    staged = staged.withColumn("text", F.array_join("_kept", "\n"))
    return restored(staged, docs.columns, ["n_lines", "n_dropped"])
