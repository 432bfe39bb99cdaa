"""Benchmark items found inside documents, by MinHash containment search.

An item is the set of its five-word shingles (letters and digits, lower case).
Its sketch is the shingles of the least hashes; how many depends on the item's
size partition. A document holds the item's sketch to the degree it holds the
item: the share of sketch values among its own shingles estimates containment,
however long the document is, where a comparison of two signatures would drown a
short item. A partition's bar on that share lets an item at the threshold fall
below it once in 100,000 times. What reaches the bar is verified by the exact
share of the item's shingles in the document.

The items are broadcast where measured to be small, else shuffled. DataFrame
functions only.

Defined cases: texts that are null or have fewer than five words hold and are no
item; rows that share a doc_id (item_id) count as one document (item); null ids
are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from odsflow.llm.store import settle
from odsflow.sizing import broadcast_if_small

SIZE = 5
LEAST = 0.8
#: Size partitions: shingles of an item up to, and values in its sketch.
PARTITIONS = [(8, 8), (16, 10), (32, 14), (64, 20), (128, 26), (1 << 62, 32)]
MISS = 1e-5
ITEMS_BROADCAST = 64 << 20


def bar(sketch: int, least: float = LEAST, miss: float = MISS) -> int:
    """The most hits that an item at the threshold fails to reach at most ``miss`` of the time."""
    below, hits = 0.0, 0
    while True:
        below += math.comb(sketch, hits) * least**hits * (1 - least) ** (sketch - hits)
        if below > miss:
            return max(1, hits)
        hits += 1


def hashed(df: DataFrame, key: str) -> DataFrame:
    """(key, h): a row for every shingle of every text, repeats included."""
    df = df.where(F.col(key).isNotNull() & F.col("text").isNotNull())
    split = F.split(F.lower("text"), "[^\\p{L}\\p{N}]+", -1)
    df = df.select(key, F.filter(split, lambda w: w != "").alias("_words"))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    hashes = F.when(
        F.size("_hashes") >= SIZE,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - SIZE),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(SIZE)]),
        ),
    )
    return df.select(key, F.explode(hashes).alias("h"))


def found_items(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of every item held by a document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    whole = settle(hashed(items, "item_id").distinct(), "items")
    sizes = whole.groupBy("item_id").agg(F.count("*").alias("n_item"))
    ranked = whole.withColumn("_nth", F.row_number().over(Window.partitionBy("item_id").orderBy("h")))
    sized = ranked.join(sizes, "item_id")
    sketch, hits = F.lit(None), F.lit(None)
    for most, values in reversed(PARTITIONS):
        sketch = F.when(F.col("n_item") <= most, values).otherwise(sketch)
        hits = F.when(F.col("n_item") <= most, bar(values, least)).otherwise(hits)
    sketches = sized.where(F.col("_nth") <= sketch)
    # An item smaller than its partition's sketch is its own sketch.
    own = F.least(hits, F.ceil(F.col("n_item") * least).cast("int"))
    sketches = settle(sketches.select("h", "item_id", own.alias("_bar")), "sketches")
    shared = hashed(docs, "doc_id").join(broadcast_if_small(sketches, ITEMS_BROADCAST), "h")
    # The same value twice in a document is one hit.
    hit = shared.distinct().groupBy("doc_id", "item_id", "_bar").count().where("count >= _bar")
    candidates = settle(hit.select("doc_id", "item_id"), "candidates")
    ids = settle(candidates.select("doc_id").distinct(), "ids")
    held = hashed(docs.join(broadcast_if_small(ids, ITEMS_BROADCAST), "doc_id", "left_semi"), "doc_id")
    wanted = broadcast_if_small(whole, ITEMS_BROADCAST)
    both = held.join(wanted, "h").distinct().join(broadcast_if_small(candidates, ITEMS_BROADCAST), ["doc_id", "item_id"], "left_semi")
    counts = both.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    counts = counts.join(broadcast_if_small(settle(sizes, "sizes"), ITEMS_BROADCAST), "item_id")
    share = F.col("n_shared") / F.col("n_item")
    return counts.withColumn("containment", share).where(F.col("containment") >= least).select(
        "doc_id", "item_id", "n_shared", "n_item", "containment"
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` less the documents that hold an item."""
    ids = settle(found_items(docs, items, least).select("doc_id").distinct(), "held")
    ids = broadcast_if_small(ids, ITEMS_BROADCAST).alias("held")
    # Qualified names, as the documents may have columns of any name.
    return docs.alias("docs").join(ids, F.col("docs.doc_id") == F.col("held.doc_id"), "left_anti")
