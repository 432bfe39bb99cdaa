"""Shards of near equal bytes, by Karmarkar-Karp differencing.

Equal texts form one group that stays whole in one shard. The groups are dealt
to tasks at random; each task differences its own: every group starts as a
partial partition that holds it in one shard, and the two partial partitions of
the largest spread are combined oppositely ordered (the fullest shard of one
with the emptiest of the other) until one is left. What the tasks are left with, one load
for each shard, is combined in the same way in levels, ``FAN`` partial
partitions to a task, until one is left; that gives each task an order of its
shards, and no group ever leaves its task.

A group above a shard's fair share cannot stay whole in a balanced result. At
most ``shards`` groups can be so large; their rows are dealt one by one to parts
of about 1/8 of a share.

Defined cases: a null text has size 1 and belongs to the group of nulls; rows of
one doc_id and one text may sit in the same shard but have slots of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from odsflow.llm.store import settle
from odsflow.sizing import broadcast_if_small

SHARDS = 8
GROUPS_PER_TASK = 20_000
ROWS_PER_BUCKET = 50_000
PARTS_OF_SHARE = 8
#: Partial partitions that a task combines in a level.
FAN = 1000


def difference(parts: Iterable[tuple[int, ...]], shards: int) -> list[list[int]]:
    """The order of each partial partition's shards in the combined one.

    ``parts`` are loads by shard; the result says for part i and its shard j
    which shard of the whole it goes to.
    """
    # A node is (loads in falling order, the node's shard at each place, children).
    heap, order = [], 0
    for i, loads in enumerate(parts):
        at = sorted(range(shards), key=lambda j: -loads[j])
        falling = [loads[j] for j in at]
        heap.append((falling[-1] - falling[0], order, falling, ("leaf", i, at)))
        order += 1
    if not heap:
        return []
    leaves = order
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        joined = [x + y for x, y in zip(a, reversed(b))]
        at = sorted(range(shards), key=lambda j: -joined[j])
        falling = [joined[j] for j in at]
        heapq.heappush(heap, (falling[-1] - falling[0], order, falling, ("pair", left, right, at)))
        order += 1
    placed: list[list[int]] = [[0] * shards for _ in range(leaves)]
    # From the root down: a node's k-th fullest shard is shard ``goes[k]`` of the whole.
    waiting = [(heap[0][3], list(range(shards)))]
    while waiting:
        node, goes = waiting.pop()
        if node[0] == "leaf":
            _, i, at = node
            for k, j in enumerate(at):
                placed[i][j] = goes[k]
        else:
            _, left, right, at = node
            own = [0] * shards
            for k, j in enumerate(at):
                own[j] = goes[k]
            waiting.append((left, own))
            waiting.append((right, own[::-1]))
    return placed


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the 128-bit key of the text."""
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("")).alias("_key"),
    )


def _combined(local: DataFrame, tasks: int, shards: int, fan: int) -> DataFrame:
    """(_task, _local, shard): where each task's shards go when all partial partitions are differenced, in levels."""

    def join(part: pd.DataFrame) -> pd.DataFrame:
        loads: dict[int, list[int]] = {}
        for node, slot, size in zip(part["_node"].tolist(), part["_slot"].tolist(), part["bytes"].tolist()):
            loads.setdefault(node, [0] * shards)[slot] = size
        names = sorted(loads)
        orders = difference((tuple(loads[n]) for n in names), shards)
        found = [(n, j, n // fan, order[j]) for n, order in zip(names, orders) for j in range(shards)]
        return pd.DataFrame(found, columns=["_node", "_slot", "_above", "_goes"])

    loads = local.select(F.col("_task").cast("long").alias("_node"), F.col("_local").alias("_slot"), "bytes")
    goes = None
    while True:
        summed = loads.groupBy("_node", "_slot").agg(F.sum("bytes").alias("bytes"))
        grouped = summed.groupBy(F.expr(f"_node div {fan}"))
        up = settle(grouped.applyInPandas(join, "_node long, _slot int, _above long, _goes int"), "level")
        if goes is None:
            goes = up.select(F.col("_node").cast("int").alias("_task"), F.col("_slot").alias("_local"), F.col("_above").alias("_node"), F.col("_goes").alias("_slot"))
        else:
            goes = goes.join(up, ["_node", "_slot"]).select("_task", "_local", F.col("_above").alias("_node"), F.col("_goes").alias("_slot"))
        if tasks <= fan:
            return settle(goes.select("_task", "_local", F.col("_slot").alias("shard")), "goes")
        tasks = -(-tasks // fan)
        loads = settle(summed.join(up, ["_node", "_slot"]).select(F.col("_above").alias("_node"), F.col("_goes").alias("_slot"), "bytes"), "loads")


def shard_by_bytes(
    docs: DataFrame, shards: int = SHARDS, groups_per_task: int = GROUPS_PER_TASK, fan: int = FAN
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot, a row's place in its shard."""
    # The number tells a huge group's rows apart, whatever their ids.
    rows = settle(sized_rows(docs).withColumn("_row", F.monotonically_increasing_id()), "sized")
    total, number = rows.agg(F.sum("size"), F.count("*")).first()
    share = (total or 0) / shards
    by_key = rows.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    # Fewer than ``shards`` keys can exceed the share.
    huge = by_key.where(F.col("_bytes") > share).select(
        "_key", F.ceil(F.col("_bytes") * PARTS_OF_SHARE / share).cast("int").alias("_parts")
    ) if total else by_key.where("false").select("_key", F.lit(1).alias("_parts"))
    rows = rows.join(F.broadcast(huge), "_key", "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0)).cast("int")
    ).drop("_parts", "_row")
    groups = rows.groupBy("_key", "_part").agg(F.sum("size").alias("bytes"))
    tasks = (number or 0) // groups_per_task + 1
    groups = groups.withColumn("_task", F.pmod(F.xxhash64("_key", "_part"), F.lit(tasks)).cast("int"))

    def own(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "_key", "_part"], ascending=[False, True, True], kind="stable")
        placed = difference(((b, *[0] * (shards - 1)) for b in part["bytes"].tolist()), shards)
        part["_local"] = [p[0] for p in placed]
        return part

    schema = "_key string, _part int, bytes long, _task int, _local int"
    local = settle(groups.groupBy("_task").applyInPandas(own, schema), "groups")
    goes = broadcast_if_small(_combined(local, tasks, shards, fan))
    placed = local.join(goes, ["_task", "_local"]).select("_key", "_part", "shard")
    kept = rows.join(placed, ["_key", "_part"]).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(settle(kept, "sharded"), number or 0)


def with_slots(rows: DataFrame, number: int) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard, with no shard in one task.

    Rows are dealt to buckets by doc_id; a bucket's slots begin where those of
    the buckets before it end. ``rows`` is read twice, so pass a stored table.
    """
    buckets = max(1, number // ROWS_PER_BUCKET)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32")
    rows = rows.withColumn("_nth", F.row_number().over(inside) - 1)
    rows = rows.join(starts, ["shard", "_bucket"])
    return rows.withColumn("slot", (F.col("_start") + F.col("_nth")).cast("long")).drop("_bucket", "_nth", "_start")
