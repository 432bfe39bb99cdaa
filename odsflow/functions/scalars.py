"""Scalar expressions: dates as text, run names, flags, Base64, JSON schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Platform ids of the second class, bounds excluded.
LOW_PLATFORMS = (0, 21)
HIGH_PLATFORM = 120

RECORDED_SCHEMA = T.StructType(
    [
        T.StructField(
            "columns",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]
                )
            ),
        )
    ]
)


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def shop_flag(column: Column) -> Column:
    """1 for an order placed in a third-party shop, else 0."""
    return F.when(zero_if_null(column) > 0, 1).otherwise(0)


def platform_class(column: Column) -> Column:
    """2 for platform ids between 0 and 21 and above 120, else 1."""
    p = zero_if_null(column)
    low = (p > LOW_PLATFORMS[0]) & (p < LOW_PLATFORMS[1])
    return F.when(low | (p > HIGH_PLATFORM), 2).otherwise(1)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, "yyyyMMdd")


def parse_run_time(text: Column) -> Column:
    """``yyyyMMdd HH:mm:ss`` as written into the load log."""
    return F.try_to_timestamp(text, F.lit("yyyyMMdd HH:mm:ss")).cast("timestamp_ntz")


def parse_run(text: Column) -> Column:
    """Run names ``yyyyMMddHHmm`` and ``yyyyMMddHHmmss``; null for anything else."""
    digits = F.rpad(text, 14, "0")
    valid = text.rlike(r"^([0-9]{12}|[0-9]{14})$")
    return F.when(valid, F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))).cast("timestamp_ntz")


def path_tail(path: Column, back: int = 1) -> Column:
    """Last path component, or the ``back``-th from the end."""
    return F.try_element_at(F.split(F.rtrim(path, F.lit("/")), "/"), F.lit(-back))


def path_value(path: Column, back: int = 1) -> Column:
    """A path component that is either ``<value>`` or ``<column>=<value>``."""
    return F.regexp_replace(path_tail(path, back), "^[^=]*=", "")


def run_parts(name: Column) -> tuple[Column, Column]:
    """``<ts>_<id>[.<ext>]`` -> (timestamp text, numeric id)."""
    stem = F.split(path_tail(name), r"\.").getItem(0)
    parts = F.split(stem, "_")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)).try_cast("long")


def schema_of(json_text: Column) -> Column:
    """Recorded schema text as ``struct<columns: array<struct<name, type>>>``."""
    return F.from_json(json_text, RECORDED_SCHEMA)


def b64_encode(column: Column) -> Column:
    """Base64 in 76-character lines, each ended by a newline.

    Spark wraps or not depending on a session setting, so its own line breaks
    are removed first and the lines are cut again.
    """
    flat = F.regexp_replace(F.base64(column.cast("binary")), r"[\r\n]", "")
    return F.regexp_replace(flat, r"(.{1,76})", "$1\n")


def b64_decode(column: Column) -> Column:
    return F.unbase64(F.regexp_replace(column, r"[\r\n]", "")).cast("string")


def day_bounds(df: DataFrame, column: str, first: str, last: str | None = None) -> Column:
    """``first <= column < day after last`` for ``yyyyMMdd`` days.

    Both bounds are literals of the column's own type, so the predicate is
    pushed to the scan and prunes files, which a formatted date would not.
    """
    start = dt.datetime.strptime(first, "%Y%m%d")
    stop = dt.datetime.strptime(last or first, "%Y%m%d") + dt.timedelta(days=1)
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return (F.col(column) >= start.strftime("%Y%m%d")) & (F.col(column) < stop.strftime("%Y%m%d"))
    low = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast(kind)
    high = F.lit(stop.strftime("%Y-%m-%d %H:%M:%S")).cast(kind)
    return (F.col(column) >= low) & (F.col(column) < high)


def day_range(column: Column, start: str | Column, end: str | Column) -> Column:
    """Half-open range, ``start <= column < end``."""
    return (column >= start) & (column < end)


def typed_range(df: DataFrame, column: str, start: str, end: str) -> Column:
    """``start <= column < end`` for ``yyyy-MM-dd`` days, in the column's own type, so that it reaches the scan."""
    kind = df.schema[column].dataType
    low, high = (F.lit(d) if isinstance(kind, T.StringType) else F.lit(d).cast(kind) for d in (start, end))
    return day_range(F.col(column), low, high)
