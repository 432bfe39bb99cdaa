"""Latest image per key out of a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from odsflow.functions.scalars import day_bounds
from odsflow.operators.latest import latest_per_key
from odsflow.sizing import broadcast_if_small, settle


def cdc_latest(
    cdc: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    day: str,
    last_day: str | None = None,
    id_col: str = "id",
    type_col: str = "cdc_type",
    ts_col: str = "cdc_ts",
    key_prefix: str = "key_",
) -> DataFrame:
    """The base row behind each key's last change of the day, with its type.

    The log holds the keys as ``key_<name>``; a deleted key keeps null
    attributes. The changes are settled once; the base is then reduced to their
    keys, which are measured: few are broadcast and the base is not shuffled,
    many place the base once for both joins.
    """
    wanted = cdc.where(day_bounds(cdc, ts_col, day, last_day)).select(
        *[F.col(f"{key_prefix}{k}").alias(k) for k in keys], type_col, id_col
    )
    changes = settle(latest_per_key(wanted, keys, [id_col]).select(*keys, type_col), "changes")
    touched = base.join(broadcast_if_small(changes.select(*keys)), list(keys), "left_semi")
    return changes.join(touched, list(keys), "left").select(*base.columns, type_col)
