"""Intermediate tables of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.settings import fresh_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, cut off
    from its lineage, and there for every executor."""
    spark = df.sparkSession
    folder = fresh_dir(spark, f"llm-{name}")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one struct, where no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(True).alias("_carried")).alias("_rest"))


def restored(df: DataFrame, columns: list[str], added: list[str] = ()) -> DataFrame:
    """``carried`` undone: ``columns`` in their order, then ``added``, which replaces what has its name."""
    old = [
        F.col(f"`{c}`") if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c)
        for c in columns
        if c not in added
    ]
    return df.select(*old, *added)
