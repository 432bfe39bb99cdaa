"""History chains: row versions valid on ``[start, end)``.

A chain holds one row per version. The open version of a key ends on a far
day; a closed one ends on the day its successor starts. Days are ``yyyyMMdd``
text and compare as text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


@dataclass(frozen=True)
class ChainLayout:
    """Names of the bookkeeping columns, and the fixed days that stand for always and never."""

    etl: str | None = "etl_dt"
    start: str = "start_dt"
    end: str = "end_dt"
    first: str = "19000101"
    open_end: str = "30001231"

    @property
    def marks(self) -> set[str]:
        return {c for c in (self.etl, self.start, self.end) if c}

    def data_columns(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.marks]

    def ordered(self, data: Sequence[str]) -> list[str]:
        """Stored order: bookkeeping, data; the partition column ends the row."""
        lead = ([self.etl] if self.etl else []) + [self.start]
        ahead = lead + list(data) if self.etl else list(data) + lead
        return ahead + [self.end]


CHAIN = ChainLayout()
# Earlier tables keep the start behind the data, have no load day and partition by e_dt.
OLD_CHAIN = ChainLayout(etl=None, start="s_dt", end="e_dt", first="19000000")


def _version(layout: ChainLayout, data: Sequence[str], values: Sequence[Column], etl, start, end) -> Column:
    by_name = dict(zip(data, values))
    by_name.update({layout.start: start, layout.end: end})
    if layout.etl:
        by_name[layout.etl] = etl
    return F.struct(*[by_name[c].alias(c) for c in layout.ordered(data)])


def chain_init(
    df: DataFrame, day: str, layout: ChainLayout = CHAIN, keys: Sequence[str] | None = None
) -> DataFrame:
    """Every source row as an open version, valid from the first day on.

    With ``keys``, a repeated or null key fails the job, as it does in a merge.
    """
    data = layout.data_columns(df)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in data]).alias("_new"))
    if keys:
        rows = _one_per_key(df, keys, data)
    row = _version(
        layout, data, [F.col(f"_new.`{c}`") for c in data],
        F.lit(day), F.lit(layout.first), F.lit(layout.open_end),
    )
    return rows.select(row.alias("_v")).select("_v.*")


def chain_as_of(history: DataFrame, day: str, layout: ChainLayout = CHAIN) -> DataFrame:
    """Versions valid on ``day``; a stored chain reads only ``end > day``."""
    return history.where((F.col(layout.start) <= day) & (F.col(layout.end) > day))


def chain_current(history: DataFrame, layout: ChainLayout = CHAIN) -> DataFrame:
    return history.where(F.col(layout.end) == layout.open_end)


def live_before(history: DataFrame, day: str, layout: ChainLayout = CHAIN) -> DataFrame:
    """The state as it stood before ``day``: one open version per key.

    Whatever was written on or after ``day`` is undone: later versions are
    left out and versions closed since then are open again. On a first run
    this is just the open partition.
    """
    valid = (F.col(layout.start) < day) & (F.col(layout.end) >= day)
    return history.where(valid).withColumn(layout.end, F.lit(layout.open_end))


def _known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _one_per_key(delta: DataFrame, keys: Sequence[str], data: Sequence[str]) -> DataFrame:
    """Delta rows packed beside their keys; a repeated or null key fails the job.

    The window sorts by the join keys, so the following join reuses both its
    shuffle and its sort.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    repeated = F.raise_error(
        F.concat(F.lit("key repeated in delta, or null: "), F.to_json(F.struct(*keys)))
    ).cast(T.StructType([delta.schema[c] for c in data]))
    ranked = delta.select(*keys, F.struct(*data).alias("_row"), rank.alias("_rank"))
    return ranked.select(*keys, F.when((F.col("_rank") == 1) & _known(keys), F.col("_row")).otherwise(repeated).alias("_new"))


def chain_day(
    live: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    day: str,
    layout: ChainLayout = CHAIN,
    small_delta: bool = False,
) -> DataFrame:
    """Versions after ``day``: live ones kept or closed, new ones opened.

    ``live`` holds one open version per key, ``delta`` one changed row per key;
    a key absent from ``delta`` is unchanged. Keys are never null. Rows differ
    when any column does, nulls compared as values.

    ``small_delta`` says the delta has been measured to fit a broadcast; then
    the live rows are not shuffled, and their keys are read a second time to
    tell which of the delta's keys they hold. Otherwise one full outer join on unique
    keys places both sides, which no key can skew.
    """
    data = layout.data_columns(live)
    keys = list(keys)
    start = F.col(f"_old.{layout.start}")
    old_row = F.struct(*[c for c in layout.ordered(data) if c != layout.end])
    old = live.select(*keys, old_row.alias("_old"))
    new = _one_per_key(delta, keys, data)

    old_data = [F.col(f"_old.`{c}`") for c in data]
    new_data = [F.col(f"_new.`{c}`") for c in data]
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.struct(*[c.alias(n) for c, n in zip(old_data, data)]).eqNullSafe(F.col("_new"))
    changed = has_old & has_new & ~same

    old_etl = F.col(f"_old.{layout.etl}") if layout.etl else None
    kept = _version(
        layout, data, old_data, old_etl, start,
        F.when(changed, F.lit(day)).otherwise(F.lit(layout.open_end)),
    )
    opened = _version(layout, data, new_data, F.lit(day), F.lit(day), F.lit(layout.open_end))

    def emit(joined: DataFrame) -> DataFrame:
        rows = F.array(F.when(has_old, kept), F.when(has_new & (~has_old | ~same), opened))
        return joined.select(F.inline(rows)).where(F.col(layout.start).isNotNull())

    if not small_delta:
        return emit(old.join(new, keys, "full_outer"))
    after = emit(old.join(F.broadcast(new), keys, "left"))
    known = live.select(*keys).join(F.broadcast(delta.select(*keys)), keys, "left_semi")
    # Out of the checked rows: here, and only here, null keys and keys without a version come out.
    unseen = new.join(known, keys, "left_anti").select("_new")
    return after.unionByName(unseen.select(opened.alias("_v")).select("_v.*"))


def chain_merge(
    history: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    day: str,
    layout: ChainLayout = CHAIN,
    small_delta: bool = False,
) -> DataFrame:
    """The whole chain after applying the changed rows of ``day``.

    Running a day again, or an earlier day, first takes the chain back to the
    state before it. Versions closed before ``day`` cannot change and pass by
    the join.
    """
    data = layout.data_columns(history)
    closed = history.where(F.col(layout.end) < day).select(*layout.ordered(data))
    live = live_before(history, day, layout)
    return closed.unionByName(chain_day(live, delta, keys, day, layout, small_delta))


def chain_replay(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    day_col: str,
    first: str,
    layout: ChainLayout = CHAIN,
    small_changes: bool = False,
) -> DataFrame:
    """The whole chain after ``changes`` have replaced everything from day ``first`` on.

    ``changes`` holds every change of ``first`` and later days, one row per key and
    day. The result is that of merging these days one after the other into the
    chain as it stood before ``first``; versions closed before it pass by.
    """
    data = layout.data_columns(history)
    closed = history.where(F.col(layout.end) < first).select(*layout.ordered(data))
    live = live_before(history, first, layout)
    return closed.unionByName(replay_days(live, changes, keys, day_col, first, layout, small_changes))


def replay_days(
    live: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    day_col: str,
    first: str,
    layout: ChainLayout = CHAIN,
    small_changes: bool = False,
) -> DataFrame:
    """Versions after all days of ``changes``: live ones kept or closed, new ones opened.

    The live version of a key lies under the key's changes, and one window over
    them finds what differs from the row before and when it ends: one shuffle for
    all days instead of a merge for each. A key's group is its changed days and one
    row more. A change before ``first``, a key and day given twice, or a null key
    fails the job.

    ``small_changes`` says the changes have been measured to fit a broadcast; then
    only the live rows of changed keys are shuffled.
    """
    keys, data = list(keys), layout.data_columns(live)
    etl = F.col(layout.etl) if layout.etl else F.lit(None).cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in data]).alias("_row")
    below = live.select(*keys, row, F.lit("").alias("_day"), etl.alias("_etl"), F.col(layout.start).alias("_start"))
    day = F.col(day_col).cast("string")
    above = changes.select(*keys, row, day.alias("_day"), day.alias("_etl"), day.alias("_start"))
    kept = None
    if small_changes:
        changed = F.broadcast(changes.select(*keys).distinct())
        kept = below.join(changed, keys, "left_anti").withColumn("_end", F.lit(layout.open_end))
        below = below.join(changed, keys, "left_semi")
    in_order = Window.partitionBy(*keys).orderBy("_day")
    before = F.lag(F.struct("_day", "_row")).over(in_order)
    early = F.coalesce((F.col("_day") < first) & (F.col("_day") != ""), F.lit(True))
    wrong = F.raise_error(
        F.concat(F.lit("key and day repeated, key null, or day too early: "), F.to_json(F.struct(*keys, F.col("_day"))))
    ).cast("boolean")
    same = F.when(early | ~_known(keys) | F.coalesce(F.col("_day") == before["_day"], F.lit(False)), wrong).otherwise(
        before.isNotNull() & F.col("_row").eqNullSafe(before["_row"])
    )
    stacked = below.unionByName(above).withColumn("_same", same).where(~F.col("_same"))
    ended = stacked.withColumn("_end", F.lead("_day", 1, layout.open_end).over(in_order)).drop("_same", "_day")
    if kept is not None:
        ended = ended.unionByName(kept.drop("_day"))
    version = _version(
        layout, data, [F.col(f"_row.`{c}`") for c in data], F.col("_etl"), F.col("_start"), F.col("_end")
    )
    return ended.select(version.alias("_v")).select("_v.*")


def chain_build(
    changes: DataFrame, keys: Sequence[str], day_col: str, layout: ChainLayout = CHAIN
) -> DataFrame:
    """The chain that results from merging every day of ``changes`` in order.

    ``changes`` holds at most one row per key and day, so a key's group is
    bounded by the number of days; a second one, or a null key, fails the job.
    One shuffle by key replaces one merge per
    day when a history is loaded in bulk.
    """
    data = [c for c in changes.columns if c != day_col]
    in_order = Window.partitionBy(*keys).orderBy(day_col)
    before = F.lag(F.struct(*data)).over(in_order)
    again = F.col(day_col).eqNullSafe(F.lag(day_col).over(in_order))
    wrong = F.raise_error(F.concat(F.lit("key and day repeated, or key null: "), F.to_json(F.struct(*keys, day_col))))
    same = F.when(again | ~_known(keys), wrong.cast("boolean")).otherwise(F.struct(*data).eqNullSafe(before))
    marked = changes.withColumn("_same", same)
    versions = marked.where(~F.col("_same")).withColumn(
        "_end", F.lead(day_col, 1, layout.open_end).over(in_order)
    )
    row = _version(
        layout, data, [F.col(f"`{c}`") for c in data],
        F.col(day_col), F.col(day_col), F.col("_end"),
    )
    return versions.select(row.alias("_v")).select("_v.*")
