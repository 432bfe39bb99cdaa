"""Delimited text: one row per line, fields apart by one control character.

There is no quoting, so line breaks and the separator must be stripped from
text first, and a text equal to the null marker reads back as null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Fixed values of the exchange format.
FIELD_SEPARATOR = "\u0001"
NULL_MARKER = "\\N"


def _as_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    # base64 breaks its lines; a break inside a field would end the row.
    binary = isinstance(field.dataType, T.BinaryType)
    text = F.translate(F.base64(column), "\r\n", "") if binary else column.cast("string")
    return F.coalesce(text, F.lit(NULL_MARKER))


def to_lines(df: DataFrame, sep: str = FIELD_SEPARATOR) -> DataFrame:
    return df.select(F.concat_ws(sep, *[_as_text(f) for f in df.schema.fields]).alias("value"))


def _field(i: int, f: T.StructField, sep: str) -> tuple[Column, Column]:
    """A field's text, null where it is marked so or missing, and its value."""
    text = F.get(F.split(F.col("value"), re.escape(sep), -1), F.lit(i))
    text = F.when(text != NULL_MARKER, text)
    typed = F.try_to_binary(text, F.lit("base64")) if isinstance(f.dataType, T.BinaryType) else text.try_cast(f.dataType)
    return text, typed


def from_lines(lines: DataFrame, schema: T.StructType, sep: str = FIELD_SEPARATOR) -> DataFrame:
    """Typed columns; a field that is missing or does not parse becomes null (``lost_fields`` counts those)."""
    return lines.select(*[_field(i, f, sep)[1].alias(f.name) for i, f in enumerate(schema.fields)])


def lost_fields(lines: DataFrame, schema: T.StructType, sep: str = FIELD_SEPARATOR) -> DataFrame:
    """(column, n_missing, n_unparsed, example): fields that ``from_lines`` makes null though they are not marked so."""
    width = F.size(F.split(F.col("value"), re.escape(sep), -1))
    pairs = []
    for i, f in enumerate(schema.fields):
        text, typed = _field(i, f, sep)
        unparsed = text.isNotNull() & typed.isNull()
        pairs.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.count_if(width <= i).alias("n_missing"),
                F.count_if(unparsed).alias("n_unparsed"),
                F.min(F.when(unparsed, text)).alias("example"),
            )
        )
    found = lines.agg(F.array(*pairs).alias("_all")).select(F.inline("_all"))
    return found.where("n_missing > 0 or n_unparsed > 0")


def write_delimited(df: DataFrame, path: str, sep: str = FIELD_SEPARATOR, rows_per_file: int = 0) -> None:
    writer = to_lines(df, sep).write.option("lineSep", "\n")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = FIELD_SEPARATOR
) -> DataFrame:
    return from_lines(spark.read.option("lineSep", "\n").text(path), schema, sep)
