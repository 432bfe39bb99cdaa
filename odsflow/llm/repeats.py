"""Words of long passages that an earlier document already has, by recompression.

A document is a sequence of word names. Recompression renames it in rounds:
first runs of one name become one symbol, then, round by round, a hash of its
name puts each symbol in a left or right class and every neighbouring
(left, right) pair becomes one symbol. A symbol's name is a 64-bit hash of what
it stands for, so all tasks name alike without asking each other. What a
symbol became depends on few words around it; that span is kept with it. Where
two documents share a passage, all symbols whose span lies inside it are equal.

A window of ``size`` words is judged by one of the high-level symbols whose
spans it holds (its anchor, the one of the least key; a key names the words of
the span), or, where it holds none, by its own name. Equal windows have equal
anchors. So the windows are shuffled by their key; keys of one document go; and
of each window, named by 96 bits (64 of its key, 32 of all its words by another
hash), the least document is found. A word is removed where a window of a
smaller doc_id covers it.

A passage that many documents share is reduced within each slice of rows before
it is shuffled: only its least document of the slice sends it. A key in very many
documents with different words around it is not used; its windows are judged by
their own names, which spread.

Defined cases: a null text has no words; documents below ``size`` words lose
none; rows that share a doc_id are judged as one document of several texts; a
null doc_id loses nothing and is nobody's first; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from odsflow.llm.store import settle
from odsflow.llm.text import mix, ragged, shingles, slices, span_hash, text_bytes, words
from odsflow.sizing import broadcast_if_small

SIZE = 13
ROUNDS = 3
IDS_BROADCAST = 16 << 20
SLICE = 4 << 20
HOT_SHARE, SAMPLE_OF = 0.002, 32

_FAR = 1 << 40
_NONE = np.uint64(2**64 - 1)
_GOLDEN = 0x9E3779B97F4A7C15


def _salted(names: np.ndarray, n: int) -> np.ndarray:
    return mix(names + np.uint64(n * _GOLDEN % 2**64))


def recompress(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The spans (low, high, in words) of the symbols after ``rounds``, where at most ``size`` long.

    ``first`` has the documents' bounds among the names.
    """
    n = len(names)
    head = np.zeros(n + 1, bool)
    head[first] = True
    # Runs: a symbol's span holds its neighbours, which tell that the run ends there.
    same = np.zeros(n, bool)
    same[1:] = (names[1:] == names[:-1]) & ~head[1:n]
    begin = np.flatnonzero(~same)
    count = np.diff(np.append(begin, n))
    name = np.where(count > 1, mix(names[begin] * np.uint64(_GOLDEN) + count.astype(np.uint64)), names[begin])
    opens = head[begin]
    closes = head[begin + count]
    low = np.where(opens, -_FAR, begin - 1)
    high = np.where(closes, _FAR, begin + count + 1)
    for number in range(1, rounds + 1):
        right = (_salted(name, number) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = ~right[:-1] & right[1:] & ~closes[:-1]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        # A symbol left alone depends on the neighbour that it could have paired with.
        after = np.append(np.arange(1, len(name)), len(name) - 1)
        before = np.append(0, np.arange(len(name) - 1))
        mate = np.where(right, before, after)
        alone = ~pair & ~second
        edge = alone & np.where(right, opens, closes)
        lower = np.where(edge, -_FAR, np.minimum(low, low[mate]))
        higher = np.where(edge, _FAR, np.maximum(high, high[mate]))
        joined = name.copy()
        at = np.flatnonzero(pair)
        joined[at] = mix(mix(name[at]) * np.uint64(_GOLDEN) + name[at + 1])
        closes = np.where(pair, closes[after], closes)
        kept = ~second
        name, low, high, opens, closes = joined[kept], lower[kept], higher[kept], opens[kept], closes[kept]
    short = high - low <= size
    spans = np.unique(low[short] * (2 * size) + (high - low)[short])
    return spans // (2 * size), spans // (2 * size) + spans % (2 * size)


class Named:
    """Word names, anchors and windows of one slice of texts."""

    def __init__(self, texts: pa.Array, size: int = SIZE):
        self.data, bounds = text_bytes(texts)
        self.starts, self.ends, self.first = words(self.data, bounds)
        self.size = size
        n = len(self.starts)
        self.names = span_hash(self.data, self.starts, self.ends) if n else np.zeros(0, np.uint64)
        self.low, self.high = recompress(self.names, self.first, size=size) if n else (np.zeros(0, np.int64),) * 2
        fits = np.zeros(n, bool)
        count = np.maximum(np.diff(self.first) - size + 1, 0)
        fits[ragged(self.first[:-1], count)] = True
        self.windows = np.flatnonzero(fits)  # their first words
        self.window_name, _ = shingles(self.names, self.first, size)
        self.window_doc = np.repeat(np.arange(len(count)), count)
        self.window_key = self._pick()[self.windows] if n else np.zeros(0, np.uint64)
        bare = self.window_key == _NONE
        self.window_key[bare] = mix(self.window_name[bare] + np.uint64(1))

    def _pick(self) -> np.ndarray:
        """The least key among the anchors in the window that begins at each word."""
        length = self.high - self.low
        key = np.zeros(len(length), np.uint64)
        for i in range(self.size):  # the words of the span, one more in each step
            on = length > i
            key[on] = key[on] * np.uint64(_GOLDEN) + self.names[self.low[on] + i]
        key = mix(key + length.astype(np.uint64))
        picked = np.full(len(self.names), _NONE)
        for back in range(self.size):
            on = (length + back <= self.size) & (self.low >= back)
            np.minimum.at(picked, self.low[on] - back, key[on])
        return picked

    def hot(self, keys: np.ndarray) -> None:
        """Windows judged by one of ``keys`` (sorted) are judged by their own name instead."""
        if len(keys):
            at = np.minimum(np.searchsorted(keys, self.window_key), len(keys) - 1)
            own = keys[at] == self.window_key
            self.window_key[own] = mix(self.window_name[own] + np.uint64(1))

    def second_name(self) -> np.ndarray:
        """32 more bits for each window, of another hash of its words."""
        other = span_hash(self.data, self.starts, self.ends, table=1)
        rolled = np.zeros(len(self.windows), np.uint64)
        for i in range(self.size):
            rolled = rolled * np.uint64(0xD1342543DE82EF95) + other[self.windows + i]
        return (mix(rolled) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def hot_keys(docs: DataFrame, share: float = HOT_SHARE) -> np.ndarray:
    """Keys of more than ``share`` of a sample's documents; the sample only chooses how rows are dealt.

    A document has a bounded number of keys a word, so this list is bounded too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            named = Named(part.column("text"))
            pairs = np.unique(np.stack([named.window_key, named.window_doc.astype(np.uint64)]), axis=1)
            key, n = np.unique(pairs[0], return_counts=True)
            many = n > share * part.num_rows
            yield pa.RecordBatch.from_arrays([_longs(key[many]), pa.array(n[many].astype(np.int64))], names=["key", "n"])

    sample = docs.where(F.xxhash64("doc_id") % SAMPLE_OF == 0)
    least = max(20, int(share * sample.count()))
    found = sample.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r["key"] for r in found.where(F.col("n") >= least).collect()], np.int64).view(np.uint64))


def _windows(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(key, doc_id, at, names): the windows in a row that one key judges.

    A window that a smaller document of the same slice has is settled there: its
    row has ``at`` below 0 (-1 - at) and a key of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            named = Named(part.column("text"))
            named.hot(hot)
            ids = part.column("doc_id").to_numpy()[named.window_doc]
            place = named.windows - named.first[named.window_doc]
            key, name = named.window_key, named.second_name()
            order = np.lexsort((ids, name, key))
            group = np.ones(len(key), bool)
            group[1:] = (key[order][1:] != key[order][:-1]) | (name[order][1:] != name[order][:-1])
            least = np.empty(len(key), np.int64)
            least[order] = ids[order][np.flatnonzero(group)][np.cumsum(group) - 1]
            known = ids > least
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (named.window_doc[1:] != named.window_doc[:-1]) | (known[1:] != known[:-1])
            begin = np.flatnonzero(new)
            far = known[begin]
            spread = mix(ids[begin].astype(np.uint64) + _salted(place[begin].astype(np.uint64), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    _longs(np.where(far, spread, key[begin])),
                    pa.array(ids[begin]),
                    pa.array(np.where(far, -1 - place[begin], place[begin]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)).astype(np.int32)), pa.array(name)),
                ],
                names=["key", "doc_id", "at", "names"],
            )

    return docs.mapInArrow(run, "key long, doc_id long, at int, names array<int>")


def _with_starts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """All of ``docs`` with the array ``starts`` of ``rows``, empty where there is none."""
    rows = rows.withColumnRenamed("doc_id", "_id")
    ids = broadcast_if_small(rows.select("_id"), IDS_BROADCAST)
    on = F.col("doc_id") == F.col("_id")
    # Documents that lose nothing need not be shuffled.
    some = docs.join(ids, on, "left_semi").join(rows, on).drop("_id")
    rest = docs.join(ids, on, "left_anti").withColumn("starts", F.array().cast("array<long>"))
    return some.unionByName(rest)


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, starts): the windows of each document that a smaller doc_id has."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    by_key = Window.partitionBy("key")
    rows = _windows(docs, hot_keys(docs))
    rows = rows.withColumns({"_low": F.min("doc_id").over(by_key), "_high": F.max("doc_id").over(by_key)})
    rows = rows.where("at < 0 or _low < _high")
    each = rows.select("key", "doc_id", "at", F.posexplode("names").alias("_i", "name"))
    # Placed by key already, the windows need no further shuffle.
    each = each.withColumn("_least", F.min("doc_id").over(Window.partitionBy("key", "name")))
    late = each.where("at < 0 or doc_id > _least")
    place = F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at")) + F.col("_i")
    late = late.select("doc_id", place.cast("long").alias("at"))
    return settle(late.groupBy("doc_id").agg(F.collect_set("at").alias("starts")), "gone")


def dedup_passages(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed, text: the words left, joined by one space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            data, bounds = text_bytes(part.column("text"))
            starts, ends, first = words(data, bounds)
            lists = part.column("starts")
            at = lists.flatten().to_numpy()
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            # Two texts of one doc_id share their list; a window beyond the shorter one is not its own.
            at = (first[row] + at)[at + size <= np.diff(first)[row]]
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + size, -1)
            left = np.cumsum(gone[:-1]) == 0
            raw = data.tobytes()
            before = np.concatenate([[0], np.cumsum(left)])
            kept_at = np.flatnonzero(left)
            begin, end = starts[kept_at].tolist(), ends[kept_at].tolist()
            edges = before[first].tolist()
            texts = [b" ".join([raw[b:e] for b, e in zip(begin[i:j], end[i:j])]) for i, j in zip(edges, edges[1:])]
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(n - np.diff(before[first])), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    return _with_starts(docs, removals(docs)).mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")
