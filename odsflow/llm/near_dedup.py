"""Near-duplicate classes by weighted MinHash (BagMinHash) over word shingles.

A document is the multiset of its five-word shingles. Every shingle carries a
Poisson process over (weight level, time, component), made of independent
processes on the dyadic level intervals [0,1) [1,2) [2,4) ..., each drawn from a
hash of shingle and interval, so all documents see the same points. A document
sees the points below its multiplicities; its signature holds, for each
component, the time of the first point it sees. Two signatures agree in a
component with a probability equal to the weighted Jaccard similarity. Points
are drawn up to a time that fills almost every signature, and further for the
few that it does not.

Equal texts are one node from the start. Signatures are cut into bands; nodes
with an equal band share a bucket. Every node is tested against the least node
of its buckets. Then an exact pass tests all other pairs: in each bucket, every
node that is not connected to the least one meets every node of another
component there. A large bucket is cut into blocks, and each two blocks are a
group of rows of their own, so no pair is a row and no bucket is one task's. A
pair is tested in the first bucket that it shares, by a sketch of the signatures
(250 bits), which drops pairs far below the threshold, and then by the exact
overlap of the two multisets; a task leaves out what its own links have already
joined. The classes are the connected components of the verified links.

Defined cases: a text of one to four words has one shingle, all its words; a
text without words, and a null text, is like none but its equals (nulls: like
none at all, each its own class); rows that share a doc_id are one document; a
null doc_id has a null class; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.links import components
from odsflow.llm.store import carried, restored, settle
from odsflow.llm.text import mix, ragged, shingles, slices, span_hash, text_bytes, words
from odsflow.sizing import broadcast_if_small

SIZE = 5
BANDS, ROWS = 25, 5
LEAST = (4, 5)  # similarity of at least 4/5
FILL = 1.5
#: Unequal bits of 250 that a pair may have: at a similarity of 0.8, 25 and a deviation of 5.5.
FAR_BITS = 25 + 28
#: Bytes of ids that may be broadcast to pick the rows of a few documents.
IDS_BROADCAST = 16 << 20

#: Nodes of a block; pairs enumerated, and pairs verified, at once in a task.
BLOCK = 512
ENUMERATED, VERIFIED = 1 << 18, 1 << 13

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _salt(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLDEN) % 2**64)


def doc_shingles(texts: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of every row, and the rows' bounds among them."""
    data, bounds = text_bytes(texts)
    starts, ends, first = words(data, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    names = span_hash(data, starts, ends)
    found, places = shingles(names, first, size)
    n = np.diff(first)
    short = (n > 0) & (n < size)
    count = np.diff(places) + short
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(at[-1], np.uint64)
    inside = np.ones(len(out), bool)
    inside[at[:-1][short]] = False
    out[inside] = found
    for k in range(1, size):
        rows = np.flatnonzero(n == k)
        value = np.full(len(rows), k, np.uint64)
        for i in range(k):
            value = mix(value * _GOLDEN + names[first[rows] + i])
        out[at[rows]] = value
    return out, at


def bags(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, multiplicity) of the distinct shingles of each row."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    start = np.flatnonzero(new)
    return row[start], found[start], np.diff(np.append(start, len(row)))


def signatures(found: np.ndarray, at: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """A row of ``size`` first times per document; NaN where it has no shingle."""
    row, shingle, weight = bags(found, at)
    out = np.full((len(at) - 1, size), np.nan)
    total = np.diff(at).astype(float)
    until = FILL * np.log(size) / np.maximum(total, 1)
    left = np.flatnonzero(total)
    while len(left):
        member = np.zeros(len(total), bool)
        member[left] = True
        mine = member[row]
        best = _first_points(row[mine], shingle[mine], weight[mine], until, len(total), size)
        out[left] = best[left]
        left = left[~np.isfinite(best[left]).all(axis=1)]
        until = until * 2
    return out


def _first_points(row, shingle, weight, until, rows: int, size: int) -> np.ndarray:
    best = np.full(rows * size, np.inf)
    level = 0
    while len(row):
        low, length = (0, 1) if level == 0 else (2 ** (level - 1), 2 ** (level - 1))
        seed = mix(shingle + _salt(level + 1))
        rate = float(size * length)
        # Of most shingles the first point already lies beyond the document's time.
        first = mix(seed + _GOLDEN)
        gap = (first >> np.uint64(24)).astype(float) * 2.0**-40
        live = np.flatnonzero(gap < -np.expm1(-until[row] * rate))
        owner, seeds, top, limit = row[live], seed[live], weight[live], until[row[live]]
        time = -np.log1p(-gap[live]) / rate
        draw, number = first[live], 1
        while len(owner):
            seen = np.ones(len(owner), bool)
            if length > 1:
                seen = low + (mix(draw) >> np.uint64(32)).astype(float) * 2.0**-32 * length < top
            component = ((draw & np.uint64(0xFFFFFF)) * np.uint64(size)) >> np.uint64(24)
            np.minimum.at(best, owner[seen] * size + component[seen].astype(np.int64), time[seen])
            number += 1
            draw = mix(seeds + _salt(number))
            time = time - np.log1p(-((draw >> np.uint64(24)).astype(float) * 2.0**-40)) / rate
            live = time < limit
            owner, seeds, top, limit, time, draw = owner[live], seeds[live], top[live], limit[live], time[live], draw[live]
        deeper = weight > (1 if level == 0 else 2**level)
        row, shingle, weight = row[deeper], shingle[deeper], weight[deeper]
        level += 1
    return best.reshape(rows, size)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key, bands (bucket ids) and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            signature = signatures(*doc_shingles(part.column("text")))
            known = np.isfinite(signature[:, 0])
            bits = mix(signature.view(np.uint64).reshape(signature.shape))
            bands = np.zeros((len(bits), BANDS), np.uint64)
            for i in range(ROWS):
                bands = mix(bands * _GOLDEN + bits[:, i::ROWS])
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64) * _GOLDEN)
            pairs = np.concatenate([bits & np.uint64(1), (bits >> np.uint64(1)) & np.uint64(1)], axis=1).astype(np.uint8)
            pairs = np.pad(pairs, ((0, 0), (0, 256 - pairs.shape[1])))
            sketch = np.packbits(pairs, axis=1).view(np.int64).reshape(len(bits), 4)
            counts = np.where(known, BANDS, 0)
            values = bands[known].ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("key"),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values)),
                    *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(4)],
                ],
                names=["doc_id", "key", "bands", "s0", "s1", "s2", "s3"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("key"), "text")
    keyed = keyed.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return keyed.mapInArrow(run, "doc_id long, key string, bands array<long>, s0 long, s1 long, s2 long, s3 long")


def _overlap(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the multisets of each pair of texts overlap enough."""
    fa, pa_ = doc_shingles(a)
    fb, pb = doc_shingles(b)
    row = np.concatenate([np.repeat(np.arange(len(a)), np.diff(pa_)), np.repeat(np.arange(len(a)), np.diff(pb))])
    found, side = np.concatenate([fa, fb]), np.concatenate([np.ones(len(fa), np.int64), np.zeros(len(fb), np.int64)])
    order = np.lexsort((found, row))
    row, found, side = row[order], found[order], side[order]
    if not len(row):
        return np.zeros(len(a), bool)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    start = np.flatnonzero(new)
    of_a = np.add.reduceat(side, start)
    of_b = np.diff(np.append(start, len(row))) - of_a
    both = np.bincount(row[start], np.minimum(of_a, of_b), len(a))
    either = np.bincount(row[start], np.maximum(of_a, of_b), len(a))
    return (both * LEAST[1] >= either * LEAST[0]) & (either > 0)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b: ids, and other columns) whose ``texts`` (id, text) are similar enough."""
    kept = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text_a", 2 << 20):
                good = _overlap(part.column("text_a"), part.column("text_b"))
                yield part.select(kept).filter(pa.array(good))

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select(*kept, "text_a", "text_b").mapInArrow(run, pairs.schema)


def _unequal(x: str, y: str) -> Column:
    """Bits in which two sketches differ."""
    bits = [F.bit_count(F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}"))) for i in range(4)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _relabelled(df: DataFrame, column: str, moved: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by its label in ``moved`` (node, label), where it has one."""
    moved = moved.select(F.col("node").alias(column), F.col("label").alias("_to"))
    rest = [c if c != column else F.coalesce("_to", column).alias(column) for c in df.columns]
    return df.join(moved, column, "left").select(*rest)


def _joined_labels(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """``labels`` (node, label) after ``moved`` (node, label), which may name nodes without a label yet."""
    known = _relabelled(labels, "label", moved)
    return known.unionByName(moved.join(labels.select("node"), "node", "left_anti"))


def _dealt(state: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``state`` dealt to groups (bucket, i, j): block i of a bucket's nodes apart (``right`` false), block j of all its nodes."""
    sized = state.join(sizes, "bucket").withColumns({"_i": F.ceil(F.col("n_apart") / block), "_j": F.ceil(F.col("n") / block)})
    place = F.xxhash64("node")
    lefts = sized.where("apart").withColumns({"right": F.lit(False), "i": F.pmod(place, "_i"), "j": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_j") - 1))})
    rights = sized.withColumns({"right": F.lit(True), "i": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_i") - 1)), "j": F.pmod(place, "_j")})
    return lefts.select(*state.columns, "right", "i", "j").unionByName(rights.select(*state.columns, "right", "i", "j"))


def _together(df: DataFrame) -> DataFrame:
    """``df`` with the rows of each group in a row, its left ones first."""
    return df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "right")


def _group_starts(part: pa.RecordBatch) -> np.ndarray:
    new = np.ones(part.num_rows, bool)
    keys = [part.column(c).to_numpy() for c in ("bucket", "i", "j")]
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _groups(batches: Iterator[pa.RecordBatch], column: str | None = None, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut between groups, into parts of about ``limit`` bytes of ``column``."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = batch if left is None else pa.concat_batches([left, batch])
        starts = _group_starts(whole)
        sizes = pc.binary_length(whole.column(column)).to_numpy().astype(np.int64) if column else np.zeros(whole.num_rows, np.int64)
        before = np.concatenate([[0], np.cumsum(sizes)])[starts] // limit
        edges = [0, *starts[1:][np.diff(before) > 0].tolist(), int(starts[-1])]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                yield whole.slice(low, high - low)
        left = whole.slice(int(starts[-1]))
    if left is not None:
        yield left


def _candidates(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left rows, right rows, unequal bits) of the pairs of whole groups that are of different labels, near by their
    sketches, and in no earlier bucket together."""
    starts = _group_starts(part)
    ends = np.append(starts[1:], part.num_rows)
    right, apart = (part.column(c).to_numpy(zero_copy_only=False) for c in ("right", "apart"))
    bucket, node, label = (part.column(c).to_numpy() for c in ("bucket", "node", "label"))
    bands = part.column("bands").flatten().to_numpy().reshape(-1, BANDS)
    sketch = np.stack([part.column(f"s{k}").to_numpy() for k in range(4)], axis=1)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    middle = ends - np.bincount(group, right, len(starts)).astype(np.int64)
    lefts = np.flatnonzero(~right)
    counts = (ends - middle)[group[lefts]]
    cuts = np.flatnonzero(np.diff(np.cumsum(counts) // ENUMERATED)) + 1
    for some, n in zip(np.split(lefts, cuts), np.split(counts, cuts)):
        a, b = np.repeat(some, n), ragged(middle[group[some]], n)
        # Two nodes apart stand on both sides; they meet once.
        on = (label[a] != label[b]) & (~apart[b] | (node[a] < node[b]))
        a, b = a[on], b[on]
        bits = np.zeros(len(a), np.int64)
        for k in range(4):
            bits += np.bitwise_count((sketch[a, k] ^ sketch[b, k]).view(np.uint64))
        on = bits <= FAR_BITS
        a, b, bits = a[on], b[on], bits[on]
        same = bands[a] == bands[b]
        first = same.argmax(axis=1) if len(a) else np.zeros(0, np.int64)
        on = bands[a, first] == bucket[a]
        if on.any():
            yield a[on], b[on], bits[on]


class _Bags:
    """Exact similarity of pairs of the texts of one part."""

    def __init__(self, texts: pa.Array):
        found, at = doc_shingles(texts)
        row, found, self.weight = bags(found, at)
        self.total = np.diff(at)
        kinds, self.kind = np.unique(found, return_inverse=True)
        self.span = max(1, len(kinds))
        by = np.lexsort((self.kind, row))
        row, self.kind, self.weight = row[by], self.kind[by], self.weight[by]
        self.keys = row * self.span + self.kind
        self.first = np.searchsorted(row, np.arange(len(at)))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        least, most = np.minimum(self.total[a], self.total[b]), np.maximum(self.total[a], self.total[b])
        good = (least * LEAST[1] >= most * LEAST[0]) & (most > 0)
        a, b = a[good], b[good]
        distinct = np.diff(self.first)
        a, b = np.where(distinct[a] > distinct[b], b, a), np.where(distinct[a] > distinct[b], a, b)
        mine = ragged(self.first[a], distinct[a])
        pair = np.repeat(np.arange(len(a)), distinct[a])
        asked = b[pair] * self.span + self.kind[mine]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        both = np.bincount(pair, np.where(self.keys[at] == asked, np.minimum(self.weight[mine], self.weight[at]), 0), len(a)) if len(a) else np.zeros(0)
        either = self.total[a] + self.total[b] - both
        good[good] = both * LEAST[1] >= either * LEAST[0]
        return good


def _near_groups(dealt: DataFrame) -> DataFrame:
    """The rows of ``dealt`` that have a candidate in their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches):
            wanted = np.zeros(part.num_rows, bool)
            for a, b, _ in _candidates(part):
                wanted[a] = wanted[b] = True
            yield part.filter(pa.array(wanted))

    return _together(dealt).mapInArrow(run, dealt.schema)


def _group_links(groups: DataFrame) -> DataFrame:
    """(a, b): labels that a verified pair of ``groups`` (with text) joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, "text"):
            own = _Bags(part.column("text"))
            names, label = np.unique(part.column("label").to_numpy(), return_inverse=True)
            root = np.arange(len(names))
            links = []
            for left, right, bits in _candidates(part):
                by = np.argsort(bits, kind="stable")
                for at in range(0, len(by), VERIFIED):
                    a, b = left[by[at : at + VERIFIED]], right[by[at : at + VERIFIED]]
                    on = root[label[a]] != root[label[b]]
                    a, b = a[on], b[on]
                    good = own.near(a, b)
                    for x, y in np.unique(np.stack([label[a[good]], label[b[good]]]), axis=1).T.tolist():
                        x, y = int(root[x]), int(root[y])
                        if x != y:
                            root[root == max(x, y)] = min(x, y)
                            links.append((x, y))
            pairs = names[np.array(links, np.int64).reshape(-1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return _together(groups).mapInArrow(run, "a long, b long")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) of every row of ``docs``."""
    signed = settle(_signed(docs), "signed")
    owners = settle(signed.groupBy("key").agg(F.min("doc_id").alias("node")), "owners")
    nodes = signed.join(owners.select(F.col("node").alias("doc_id"), "key"), ["doc_id", "key"], "left_semi")
    nodes = nodes.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "node")
    sketches = settle(nodes.select("node", "bands", F.struct("s0", "s1", "s2", "s3").alias("sketch")), "nodes")
    banded = sketches.select("node", F.explode("bands").alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    members = settle(banded.join(heads.select("bucket", "head"), "bucket"), "members")
    shared = settle(members.select(F.col("node").alias("id")).distinct(), "shared")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text is not null")
    texts = texts.join(broadcast_if_small(shared, IDS_BROADCAST), "id", "left_semi")
    texts = settle(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
    sketch = sketches.select("node", "sketch")

    stars = members.where("node <> head").select("node", "head").distinct()
    stars = stars.join(sketch, "node").join(sketch.select(F.col("node").alias("head"), F.col("sketch").alias("other")), "head")
    stars = settle(stars.where(_unequal("sketch", "other") <= FAR_BITS).select(F.col("head").alias("a"), F.col("node").alias("b")), "stars")
    labels = components(settle(verified(stars, texts), "verified"))

    # Whoever is not in the head's component meets all others of its buckets that are not in its own.
    state = members.withColumn("label", F.col("node")).withColumn("head_label", F.col("head"))
    moved = broadcast_if_small(labels, IDS_BROADCAST)
    state = _relabelled(_relabelled(state, "label", moved), "head_label", moved)
    state = settle(state.select("bucket", "node", "label", (F.col("label") != F.col("head_label")).alias("apart")), "state")
    sizes = state.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("apart").alias("n_apart")).where("n_apart > 0")
    sizes = broadcast_if_small(settle(sizes, "sizes"), IDS_BROADCAST)
    dealt = _dealt(state, sizes, BLOCK).join(sketches.select("node", "bands", "sketch.*"), "node")
    groups = settle(_near_groups(dealt), "groups")
    found = settle(_group_links(groups.join(texts.withColumnRenamed("id", "node"), "node")), "found")
    # The links join whole components, so only their labels are connected anew.
    labels = _joined_labels(labels, components(found))

    classes = owners.join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("_class"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("key"))
    rows = rows.join(classes, "key", "left")
    known_id = F.coalesce("_class", "doc_id")
    return rows.select("doc_id", F.when(F.col("doc_id").isNotNull(), known_id).alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, that of the least doc_id.

    A row given twice, alike in doc_id and text, is a copy of itself. Unlike texts
    under one doc_id are documents of their own: each has a new id while classes
    are sought. Rows without a doc_id stay.
    """
    key = F.coalesce(F.md5("text"), F.lit("")).alias("_key")
    own = carried(docs).select("*", F.col("doc_id").cast("long").alias("_id"), key)
    pairs = settle(own.where("_id is not null").groupBy("_id", "_key").count(), "pairs")
    repeated = not pairs.where("count > 1").isEmpty()
    unlike = pairs.groupBy("_id").count().where("count > 1").select("_id")
    if not unlike.isEmpty():
        top = pairs.agg(F.max("_id")).first()[0]
        named = pairs.join(unlike, "_id", "left_semi").withColumn("_own", F.monotonically_increasing_id() + F.lit(top + 1))
        named = broadcast_if_small(settle(named.select("_id", "_key", "_own"), "own_ids"), IDS_BROADCAST)
        own = own.join(named, ["_id", "_key"], "left").withColumn("_id", F.coalesce("_own", "_id"))
    classes = settle(near_classes(own.select(F.col("_id").alias("doc_id"), "text")), "classes")
    gone = settle(classes.where("doc_id <> class_id").select(F.col("doc_id").alias("_id")).distinct(), "gone")
    kept = own.join(broadcast_if_small(gone, IDS_BROADCAST), "_id", "left_anti")
    if repeated:
        kept = kept.where("_id is not null").dropDuplicates(["_id"]).unionByName(kept.where("_id is null"))
    return restored(kept, docs.columns)
