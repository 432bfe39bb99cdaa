"""Packing of documents into windows of several context sizes, without padding.

Hierarchical multi-length packing. Each document is routed to a context tier,
the smallest power of two that holds it; what is longer than the longest tier
fills whole windows of it, and its rest is routed. The tiers are packed from the
longest down: a tier's documents open windows of its size, longest first, and
the gaps that they leave are filled from the shorter ones, with the longest
document that fits. Where none fits, the shortest document that is longer than
the gap is cut, and its rest goes back to its own tier. So every window is full;
a group's last one, for which nothing is left, falls into powers of two. The
windows of a tier are dealt to step groups of equal tokens.

The plan is made on counts of documents of equal length, not on documents: a
group of ``GROUP_PARTS`` tasks has at most one count for each length below the
longest tier. A task numbers its documents of each length as it writes their
ids; running sums over the tasks turn that into ranks, and a rank finds its
places in the group's plan. Documents are not shuffled while the running sums
and plans measure small; beyond that each task's documents meet their own.

Defined cases: a null or empty text is the end mark alone; rows that share a
doc_id or a text are packed each by itself; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from odsflow.llm.store import settle
from odsflow.llm.text import slices, text_bytes
from odsflow.llm.units import byte_units, byte_vocabulary, tokenize, unit_starts

TIERS = (256, 512, 1024, 2048)
END_ID = 1
GROUP_PARTS = 32
STEP_TOKENS = 1 << 18
#: Bytes of running sums and plans up to which every task gets all of them.
PLAN_BROADCAST = 64 << 20

TOKENS = "doc_id long, ids binary, n long, part long, rest int, nth long, windows_before long"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step long"


def _whole_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ids and the rows' bounds among them."""
    vocabulary = byte_vocabulary(path)
    data, bounds = text_bytes(texts)
    starts = unit_starts(data, bounds)
    (ids, count, _), = tokenize(data, starts, [byte_units(path)])
    places = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, bounds)]
    marks, raw = [m.encode() for m in vocabulary.specials], data.tobytes()
    if not any(m in raw for m in marks):
        return ids, places
    # The string of a special token is one token, and parts its text otherwise than white space does.
    rows = [ids[low:high] for low, high in zip(places, places[1:])]
    for i, (low, high) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        if any(m in raw[low:high] for m in marks):
            rows[i] = np.array(vocabulary.encode(raw[low:high].decode("utf-8", "replace")), np.uint32)
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def tokenized(docs: DataFrame, vocabulary: str, longest: int = TIERS[-1], end_id: int = END_ID) -> DataFrame:
    """Each document's ids, the end mark last, and its number among the task's documents of its length.

    ``rest`` is what whole windows leave; ``nth`` counts the task's earlier rows
    of that rest, ``windows_before`` their whole windows. A table to be stored:
    the numbers belong to the attempt that wrote them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, windows = np.zeros(longest, np.int64), 0
        for some in slices(batches):
            ids, bounds = _whole_ids(some.column("text"), vocabulary)
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            rest, full = n % longest, n // longest
            by = np.argsort(rest, kind="stable")
            first = np.searchsorted(rest[by], rest[by])
            nth = np.empty(len(n), np.int64)
            nth[by] = seen[rest[by]] + np.arange(len(n)) - first
            seen += np.bincount(rest, minlength=longest)
            before = windows + np.cumsum(full) - full
            windows += int(full.sum())
            width = 2 if len(ids) == 0 or ids.max() < 1 << 16 else 4
            offsets = pa.py_buffer((bounds * width).astype(np.int32))
            blob = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets, pa.py_buffer(ids.astype(f"<u{width}").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), blob, pa.array(n), pa.array(np.full(len(n), part)), pa.array(rest.astype(np.int32)), pa.array(nth), pa.array(before)],
                names=["doc_id", "ids", "n", "part", "rest", "nth", "windows_before"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TOKENS)


class Pool:
    """Runs (length class, first rank, documents, start) of unplaced stretches, by their size."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self.sizes = 0  # a bit for each size there is

    def put(self, size: int, run: tuple[int, int, int, int]) -> None:
        self.runs.setdefault(size, []).append(run)
        self.sizes |= 1 << size

    def take(self, size: int, most: int) -> tuple[int, int, int, int]:
        """At most ``most`` documents, those of one run."""
        runs = self.runs[size]
        whole, rank, count, start = runs.pop()
        if count > most:
            runs.append((whole, rank + most, count - most, start))
            count = most
        if not runs:
            self.sizes ^= 1 << size
        return whole, rank, count, start

    def count(self, size: int) -> int:
        return self.runs[size][-1][2]

    def longest(self, bound: int) -> int:
        return max((self.sizes & ((2 << bound) - 1)).bit_length() - 1, 0)

    def shortest_above(self, bound: int) -> int:
        above = self.sizes >> (bound + 1)
        return bound + (above & -above).bit_length() if above else 0


def plan(counts: dict[int, int], tiers: tuple[int, ...] = TIERS) -> tuple[np.ndarray, dict[int, int]]:
    """Places for ``counts[length]`` documents of each length below the longest tier.

    Rows (length, start, rank, documents, size, tier, sequence, each, offset): the
    ``size`` tokens from ``start`` on of the documents ranked from ``rank`` on lie in
    the tier's windows from ``sequence`` on, ``each`` to a window, beginning at
    ``offset``. Then the number of windows of each tier.
    """
    pool, opened, places = Pool(), dict.fromkeys(tiers, 0), []
    for length, n in counts.items():
        if length and n:
            pool.put(length, (length, 0, n, 0))

    def close(tier: int, windows: int, parts: list) -> None:
        offset, first = 0, opened.get(tier, 0)
        opened[tier] = first + windows
        for whole, rank, start, size, each in parts:
            places.append((whole, start, rank, windows * each, size, tier, first, each, offset))
            offset += size * each

    def cut(parts: list, first: int, windows: int) -> list:
        return [(whole, rank + first * each, start, size, each) for whole, rank, start, size, each in parts]

    def dissolve(windows: int, parts: list) -> None:
        for whole, rank, start, size, each in parts:
            pool.put(size, (whole, rank, windows * each, start))

    def fall_apart(parts: list) -> None:
        """One window that nothing is left to fill: sequences of a power of two each."""
        pieces = [(whole, rank + i, start, size) for whole, rank, start, size, each in parts for i in range(each)]
        left = sum(p[3] for p in pieces)
        while left:
            power = 1 << (left.bit_length() - 1)
            filled, own = 0, []
            while filled < power:
                whole, rank, start, size = pieces.pop(0)
                used = min(size, power - filled)
                own.append((whole, rank, start, used, 1))
                if used < size:
                    pieces.insert(0, (whole, rank, start + used, size - used))
                filled += used
            close(power, 1, own)
            left -= power

    while pool.sizes:
        size = pool.sizes.bit_length() - 1
        tier = next(t for t in tiers if t >= size)
        whole, rank, count, start = pool.take(size, pool.count(size))
        stack = [(count, tier - size, [(whole, rank, start, size, 1)])]
        while stack:
            windows, gap, parts = stack.pop()
            if not gap:
                close(tier, windows, parts)
            elif filler := pool.longest(gap):
                each = min(gap // filler, pool.count(filler) // windows)
                now = windows if each else pool.count(filler)
                whole, rank, _, start = pool.take(filler, now * max(each, 1))
                if now < windows:
                    stack.append((windows - now, gap, cut(parts, now, windows)))
                stack.append((now, gap - filler * max(each, 1), [*parts, (whole, rank, start, filler, max(each, 1))]))
            elif donor := pool.shortest_above(gap):
                whole, rank, now, start = pool.take(donor, windows)
                pool.put(donor - gap, (whole, rank, now, start + gap))
                if now < windows:
                    stack.append((windows - now, gap, cut(parts, now, windows)))
                close(tier, now, [*parts, (whole, rank, start, gap, 1)])
            elif windows > 1:
                stack.append((windows - windows // 2, gap, parts))
                dissolve(windows // 2, cut(parts, windows - windows // 2, windows))
            elif stack:
                dissolve(1, parts)
            else:
                fall_apart(parts)
    return np.array(places, np.int64).reshape(-1, 9), opened


class Places:
    """A group's plan, ready to be asked: (length, start, rank) sorted as one number."""

    def __init__(self, places: np.ndarray, windows: dict[int, int], longest: int, alone: int = 0):
        self.longest = longest
        keys = self.key(places[:, 0], places[:, 1], places[:, 2])
        by = np.argsort(keys)
        self.keys, self.places = keys[by], places[by]
        self.windows = np.zeros(longest.bit_length(), np.int64)
        for tier, n in windows.items():
            self.windows[tier.bit_length() - 1] = n
        #: Windows of the longest tier before those that a document fills alone.
        self.planned = int(self.windows[-1])
        self.windows[-1] += alone

    def key(self, length, start, rank):
        return ((length * self.longest + start) << 38) | rank

    def find(self, length: np.ndarray, rank: np.ndarray):
        """(row, start, size, tier, number, offset) of all stretches of the rows with these lengths and ranks."""
        row = np.flatnonzero(length)
        start, out = np.zeros(len(row), np.int64), []
        while len(row):
            own = rank[row]
            at = np.searchsorted(self.keys, self.key(length[row], start, own), side="right") - 1
            _, _, first, _, size, tier, sequence, each, offset = self.places[at].T
            nth = own - first
            out.append((row, start, size, tier, sequence + nth // each, offset + nth % each * size))
            more = start + size < length[row]
            row, start = row[more], (start + size)[more]
        return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 6


def _placed(part: pa.RecordBatch, bases: np.ndarray, places: Places, group: int, step_tokens: int) -> pa.RecordBatch:
    """The pieces of one task's rows. Sequences are numbered by group, tier and window."""
    longest = places.longest
    rest, n = part.column("rest").to_numpy().astype(np.int64), part.column("n").to_numpy()
    row, start, size, tier, number, offset = places.find(rest, bases[rest] + part.column("nth").to_numpy())
    full = n // longest
    whole = np.repeat(np.arange(len(n)), full)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
    later = places.planned + bases[0] + np.repeat(part.column("windows_before").to_numpy(), full) + nth
    zeros = np.zeros(len(whole), np.int64)
    row, start = np.concatenate([whole, row]), np.concatenate([nth * longest, start + (full * longest)[row]])
    size, tier = np.concatenate([zeros + longest, size]), np.concatenate([zeros + longest, tier])
    number, offset = np.concatenate([later, number]), np.concatenate([zeros, offset])
    data, bounds = text_bytes(part.column("ids").cast(pa.binary()))
    # Rows are written in one of two widths; their own sizes tell.
    blobs = []
    for r, s, k in zip(row.tolist(), start.tolist(), size.tolist()):
        wide = (bounds[r + 1] - bounds[r]) // n[r]
        own = data[bounds[r] + s * wide : bounds[r] + (s + k) * wide]
        blobs.append(own.view(f"<u{wide}").astype("<u4").tobytes() if wide < 4 else own.tobytes())
    level = np.frexp(tier)[1] - 1
    windows = places.windows[level]
    steps = np.maximum(-(-windows * tier // step_tokens), 1)
    name = (np.int64(group) << 42) | (level.astype(np.int64) << 37)
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id").take(pa.array(row)),
            pa.array(start),
            pa.array(size),
            pa.array(blobs, pa.binary()),
            pa.array(n[row]),
            pa.array(name | number),
            pa.array(offset),
            pa.array(tier.astype(np.int32)),
            pa.array(name | (number * steps // windows)),
        ],
        names=[f.split()[0] for f in PIECES.split(", ")],
    )


def _by_group(hist: DataFrame, tiers: tuple[int, ...]) -> DataFrame:
    """(group, plan): each group's plan, pickled."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(rows["rest"].tolist(), rows["total"].tolist()))
        alone = counts.pop(0, 0)
        made = pickle.dumps((*plan(counts, tiers), tiers[-1], alone))
        return pd.DataFrame({"group": [int(rows["group"].iloc[0])], "plan": [made]})

    totals = hist.groupBy("group", "rest").agg(F.sum("n").alias("total"))
    return totals.groupBy("group").applyInPandas(run, "group long, plan binary")


def _by_part(hist: DataFrame, longest: int) -> DataFrame:
    """(part, group, bases): how many rows of each rest, and whole windows, the group's earlier tasks have."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bases = np.zeros(longest, np.int64)
        bases[rows["rest"].to_numpy()] = rows["base"].to_numpy()
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "group": [int(rows["group"].iloc[0])], "bases": [bases.tobytes()]})

    before = Window.partitionBy("group", "rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    summed = hist.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return summed.groupBy("part").applyInPandas(run, "part long, group long, bases binary")


def place(tokens: DataFrame, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, plan_bytes: int = PLAN_BROADCAST) -> DataFrame:
    """The pieces of stored ``tokens`` in their windows."""
    longest = tiers[-1]
    counted = tokens.where("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n"))
    alone = tokens.groupBy("part").agg(F.sum(F.expr(f"n div {longest}")).alias("n")).select("part", F.lit(0).alias("rest"), "n")
    hist = settle(counted.unionByName(alone).withColumn("group", F.expr(f"part div {GROUP_PARTS}")), "tier-counts")
    plans, bases = settle(_by_group(hist, tiers), "tier-plans"), settle(_by_part(hist, longest), "tier-bases")
    size = sum(df.agg(F.sum(F.length(c))).first()[0] or 0 for df, c in ((plans, "plan"), (bases, "bases")))
    if size > plan_bytes:

        def meet(rows: pa.Table, own: pa.Table) -> pa.Table:
            known = own.to_pylist()[0]
            made = Places(*pickle.loads(known["plan"]))
            found = [_placed(b, np.frombuffer(known["bases"], np.int64), made, known["group"], step_tokens) for b in rows.combine_chunks().to_batches()]
            return pa.Table.from_batches(found)

        return tokens.groupBy("part").cogroup(bases.join(plans, "group").groupBy("part")).applyInArrow(meet, PIECES)
    by_group = {r["group"]: r["plan"] for r in plans.collect()}
    by_part = {r["part"]: (r["group"], r["bases"]) for r in bases.collect()}
    shared = tokens.sparkSession.sparkContext.broadcast((by_group, by_part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_group, by_part = shared.value
        ready = {}
        for some in slices(batches, "ids"):
            parts = some.column("part").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for low, high in zip(edges, edges[1:]):
                group, own = by_part[int(parts[low])]
                if group not in ready:
                    ready[group] = Places(*pickle.loads(by_group[group]))
                yield _placed(some.slice(low, high - low), np.frombuffer(own, np.int64), ready[group], group, step_tokens)

    return tokens.mapInArrow(run, PIECES)


def pack_tiers(
    docs: DataFrame,
    vocabulary: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
    plan_bytes: int = PLAN_BROADCAST,
) -> DataFrame:
    """One row per piece: its document, its ids (unsigned 32 bit, little-endian) and its place.

    ``tier`` is the length of the piece's sequence, ``step`` the step group that
    the sequence belongs to.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers are ascending powers of two")
    longest = tiers[-1]
    tokens = settle(tokenized(docs, vocabulary, longest, end_id), "tier-tokens")
    return place(tokens, tiers, step_tokens, plan_bytes)
