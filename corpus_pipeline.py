"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), keeps the columns of documents (but the
last) and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odsflow.llm import decontaminate, line_dedup, near_dedup, packing, quality
from odsflow.llm.queries import vocabulary
from odsflow.llm.store import settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go."""
    return line_dedup.dedup_lines(docs).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.keep_one(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, placed in sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality", quality_rules),
    ("lines", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_items),
    ("packing", packing_into_sequences),
]

#: The fit of the quality rules, MinHash and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
