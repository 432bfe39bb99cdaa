"""Text cleaning, load-date stamps and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Characters the delimited layout cannot hold inside a field.
DELIMITERS = "\n\r\u0001"


def drop_delims(df: DataFrame) -> DataFrame:
    """Strip line breaks and the field separator from every string column."""

    def cleaned(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return column
        # One plain search per character leaves clean text untouched; translate rebuilds all of it.
        return reduce(lambda c, d: F.replace(c, F.lit(d), F.lit("")), DELIMITERS, column).alias(field.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def stamp(df: DataFrame, day: str, name: str = "etl_dt") -> DataFrame:
    """Put the load day in front of the columns, replacing one already there."""
    return df.select(F.lit(day).alias(name), *[F.col(f"`{c}`") for c in df.columns if c != name])


def row_md5(columns: Sequence[str]) -> Column:
    """MD5 over named columns; a null and an empty string hash differently."""
    return F.md5(F.to_json(F.struct(*columns)))


def joined_md5(columns: Sequence[Column], sep: str = "|") -> Column:
    """MD5 of the columns' text joined by ``sep``; nulls are skipped, so prefer
    :func:`row_md5` where columns can be null."""
    return F.md5(F.concat_ws(sep, *[c.cast("string") for c in columns]))
