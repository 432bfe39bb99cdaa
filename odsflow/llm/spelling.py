"""Spelling variants: words one edit apart, each pointing to its usual form.

Words are counted over all texts. Their near words are found by k-d trees over
letter-count vectors: one inserted, deleted or replaced letter changes the
counts by at most two in sum, so a word's near words of its own length lie in the
boxes that its vector misses by at most one letter too few and one too many, and
those one letter longer in the boxes that it misses by one letter too few. Each
pair of lengths is such a range search; what the boxes let through is verified
letter by letter.

A vector is kept as a bit for each letter and count (at least one, two, three of
it), a box as the bits that all its words have and those that any has; counts
beyond are left out, which loosens a box and never tightens it. The upper levels
of a length's tree, made on a bounded sample of words, part the words into cells
of about ``CELL`` words, which Spark shuffles; a word is sent, as a member, to its
own cell and, as a query, to each cell that its search reaches. A cell that turns
out larger, as one of words with the same letters, is dealt to slices, and its
queries go to each of them. A task makes the lower levels on its cell's members.

Defined cases: a null text has no words; a null doc_id counts as an empty one in
the sums that decide on deletions; rows that share a doc_id are counted each by
itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from odsflow.llm.store import settle
from odsflow.llm.text import ragged, slices, span_hash, text_bytes, words
from odsflow.sizing import broadcast_if_small

SHORTEST, FEWEST = 7, 2
DROP_ONE_IN = 31
#: A form has at least so many times the word's occurrences.
RATIO = 10
CELL = 4096
#: Members of a cell beyond which it is dealt to slices.
CELL_MOST = 4 * CELL
SAMPLE = 65_536
LEAF = 16
#: A task's arrays hold so many queries, pairs of words, and words, at a time.
QUERIES_AT_ONCE = 512
PAIRS_AT_ONCE = 1 << 19
WORDS_AT_ONCE = 1 << 13
COMPARED_BYTES = 1 << 24

# Bits of a vector: letters a to z up to three of each, U+00C0 to U+00FF once, U+00E0 to U+00FF twice.
LETTERS, ACCENTED = 26, 64
BITS = 192
_LEVELS = [(letter, n) for n in (1, 2, 3) for letter in range(LETTERS)]
_LEVELS += [(LETTERS + letter, 1) for letter in range(ACCENTED)]
_LEVELS += [(LETTERS + letter, 2) for letter in range(32, ACCENTED)]
_OF_LETTER = np.array([letter for letter, _ in _LEVELS])
_COUNT = np.array([n for _, n in _LEVELS])

#: What a byte adds to a CRC-32, by the byte and the sum's lowest one.
_CRC = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)


# Words ---------------------------------------------------------------------------


def _runs(texts: pa.Array):
    """Bytes with A-Z in lower case, and starts, ends, rows and lengths in letters of the runs."""
    data, bounds = text_bytes(texts)
    lead = data == 0xC3
    inside = lead.copy()
    inside[1:] |= lead[:-1]
    upper = (data >= 65) & (data <= 90)
    inside |= upper | ((data >= 97) & (data <= 122))
    starts, ends, first = words(data, bounds, ~inside)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    leads = np.concatenate([[0], np.cumsum(lead)])
    return data + np.uint8(32) * upper, starts, ends, row, ends - starts - (leads[ends] - leads[starts])


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes, continued from the sums ``before``; all spans advance byte by byte together."""
    size = ends - starts
    by = np.argsort(-size, kind="stable")
    state, at = ~before[by], starts[by]
    longer = len(by) - np.searchsorted(size[by][::-1], np.arange(size.max(initial=0)), side="right")
    for i, n in enumerate(longer.tolist()):
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + i]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(by), np.uint32)
    out[by] = ~state
    return out


def _without(word: bytes, letter: int) -> bytes:
    text = word.decode("utf-8")
    return (text[:letter] + text[letter + 1 :]).encode("utf-8")


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, size)].tobytes())])


def count_words(docs: DataFrame, shortest: int = SHORTEST, one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n) of all words of at least ``shortest`` letters.

    Of about one run in ``one_in``, as a checksum of doc_id and run decides, one
    letter is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, starts, ends, row, length = _runs(part.column("text"))
            long = length >= shortest
            starts, ends, row, length = starts[long], ends[long], row[long], length[long]
            marks = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in part.column("doc_id").to_pylist()]
            sums = run_crcs(data, starts, ends, np.array(marks, np.uint32)[row])
            cut = sums % np.uint32(one_in) == 0
            raw = data.tobytes()
            at = zip(starts[cut].tolist(), ends[cut].tolist(), (sums[cut] % length[cut]).tolist(), length[cut].tolist())
            shorter = [_without(raw[s:e], letter) for s, e, letter, size in at if size > shortest]
            starts, ends = starts[~cut], ends[~cut]
            _, example, times = np.unique(span_hash(data, starts, ends), return_index=True, return_counts=True)
            whole = _texts(data, starts[example], ends[example])
            found = pa.concat_arrays([whole, pa.array(shorter, pa.binary()).cast(pa.string())])
            n = np.concatenate([times, np.ones(len(shorter), np.int64)])
            yield pa.RecordBatch.from_arrays([found, pa.array(n)], names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# Trees ---------------------------------------------------------------------------


def letter_bits(texts: pa.Array) -> np.ndarray:
    """Each word's vector, three numbers of 64 bits."""
    parts = [_some_bits(texts.slice(low, WORDS_AT_ONCE)) for low in range(0, len(texts), WORDS_AT_ONCE)]
    return np.concatenate([*parts, np.zeros((0, BITS // 64), np.uint64)])


def _some_bits(texts: pa.Array) -> np.ndarray:
    data, bounds = text_bytes(texts)
    letter = np.where(data < 0x80, data.astype(np.int64) - 97, data.astype(np.int64) - 0x80 + LETTERS)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    told = data != 0xC3
    width = LETTERS + ACCENTED
    counts = np.bincount(row[told] * width + letter[told], minlength=len(texts) * width).reshape(-1, width)
    flags = np.zeros((len(texts), BITS), bool)
    flags[:, : len(_LEVELS)] = counts[:, _OF_LETTER] >= _COUNT
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def _one(chosen: np.ndarray) -> np.ndarray:
    flags = np.zeros(BITS, bool)
    flags[np.flatnonzero(chosen)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


class Tree:
    """A k-d tree: a node parts its words by whether they have so many of a letter.

    With ``tight``, a node's box is that of its words; otherwise it is what the
    splits above it say, so the tree also holds words that it was not made on.
    """

    def __init__(self, bits: np.ndarray, leaf: int, tight: bool):
        flags = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, : len(_LEVELS)]
        self.order = np.arange(len(bits))
        self.split, self.left, self.right, low, high, first, last = [], [], [], [], [], [], []
        stack = [(0, len(bits), -1, 0, np.zeros(3, np.uint64), np.full(3, ~np.uint64(0)))]
        while stack:
            start, end, above, side, least, most = stack.pop()
            node, own = len(low), self.order[start:end]
            if above >= 0:
                (self.right if side else self.left)[above] = node
            if tight and len(own):
                least, most = np.bitwise_and.reduce(bits[own]), np.bitwise_or.reduce(bits[own])
            for column, value in ((self.split, -1), (self.left, -1), (self.right, -1), (low, least), (high, most), (first, start), (last, end)):
                column.append(value)
            if len(own) <= leaf:
                continue
            share = flags[own].sum(axis=0, dtype=np.int64)
            at = int(np.argmin(np.abs(2 * share - len(own))))
            if share[at] in (0, len(own)):
                continue
            self.split[node] = at
            has = flags[own, at].astype(bool)
            middle = end - int(share[at])
            self.order[start:end] = np.concatenate([own[~has], own[has]])
            same = _OF_LETTER == _OF_LETTER[at]
            stack.append((start, middle, node, 0, least, most & ~_one(same & (_COUNT >= _COUNT[at]))))
            stack.append((middle, end, node, 1, least | _one(same & (_COUNT <= _COUNT[at])), most))
        self.left, self.right, self.split = np.array(self.left), np.array(self.right), np.array(self.split)
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.size = np.array(first), np.array(last) - np.array(first)

    def reach(self, bits: np.ndarray, most_more: int, most_less: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) where a word of the leaf may have up to ``most_more`` letters that the query lacks
        and lack up to ``most_less`` that it has."""
        query, node, found = np.arange(len(bits)), np.zeros(len(bits), np.int64), []
        while len(query):
            own = bits[query]
            near = _missing(self.low[node], own) <= most_more
            near &= _missing(own, self.high[node]) <= most_less
            query, node = query[near], node[near]
            leaf = self.left[node] < 0
            found.append((query[leaf], node[leaf]))
            query, node = query[~leaf], node[~leaf]
            query, node = np.concatenate([query, query]), np.concatenate([self.left[node], self.right[node]])
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (query, node)

    def home(self, bits: np.ndarray) -> np.ndarray:
        """The leaf of each word."""
        node = np.zeros(len(bits), np.int64)
        while (inner := np.flatnonzero(self.left[node] >= 0)).size:
            at = self.split[node[inner]]
            has = (bits[inner, at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
            node[inner] = np.where(has == 1, self.right[node[inner]], self.left[node[inner]])
        return node


def _missing(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many letters of ``some`` the ``other`` lacks, at least."""
    return np.bitwise_count(some & ~other).sum(axis=1)


# Searches ------------------------------------------------------------------------


def _letters(texts: pa.Array, length: int) -> np.ndarray:
    """Words of ``length`` letters, a row each; every letter is one byte."""
    data, _ = text_bytes(texts)
    behind = np.zeros(len(data), bool)
    behind[1:] = data[:-1] == 0xC3
    return (data + np.uint8(0x40) * behind)[data != 0xC3].reshape(-1, length)


def _replaced(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one != other).sum(axis=1) == 1


def _inserted(one: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Is ``longer`` the word with one letter more?"""
    length = one.shape[1]
    ahead = np.logical_and.accumulate(one == longer[:, :length], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((one == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


def near_pairs(members: pa.Array, length: int, queries: pa.Array, query_length: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) of all pairs one edit apart; queries are as long as the members, or one letter shorter."""
    bits, texts = letter_bits(members), _letters(members, length)
    asked, asked_texts = letter_bits(queries), _letters(queries, query_length)
    tree = Tree(bits, LEAF, True)
    same = query_length == length
    verify, most_less = (_replaced, 1) if same else (_inserted, 0)
    step, found = max(1, COMPARED_BYTES // length), []
    for low in range(0, len(asked), QUERIES_AT_ONCE):
        own = asked[low : low + QUERIES_AT_ONCE]
        query, leaf = tree.reach(own, 1, most_less)
        size = tree.size[leaf]
        edges = np.flatnonzero(np.diff(np.cumsum(size) // PAIRS_AT_ONCE, prepend=-1))
        for begin, end in zip(edges, np.append(edges[1:], len(leaf))):
            member = tree.order[ragged(tree.first[leaf[begin:end]], size[begin:end])]
            asker = np.repeat(query[begin:end], size[begin:end])
            close = _missing(bits[member], own[asker]) <= 1
            close &= _missing(own[asker], bits[member]) <= most_less
            member, asker = member[close], asker[close] + low
            for at in range(0, len(asker), step):
                q, m = asker[at : at + step], member[at : at + step]
                good = verify(asked_texts[q], texts[m])
                found.append((q[good], m[good]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (none, none)


MEMBER, SAME, SHORTER = 0, 1, 2


def _upper_trees(counted: DataFrame, cell: int, sample: int) -> dict[int, Tree]:
    """A tree for each length with more than a cell of words, made on a sample of at most ``sample`` words."""
    sizes = {r["length"]: r["count"] for r in counted.groupBy("length").count().where(F.col("count") > cell).collect()}
    if not sizes:
        return {}
    large = counted.where(F.col("length").isin(list(sizes)))
    drawn = large.select("word", "length").orderBy(F.xxhash64("word")).limit(sample).toArrow()
    lengths, texts, trees = drawn.column("length").to_numpy(), drawn.column("word").combine_chunks(), {}
    for length, n in sizes.items():
        own = texts.take(pa.array(np.flatnonzero(lengths == length)))
        trees[length] = Tree(letter_bits(own), max(8, int(cell * len(own) / n)), False)
    return trees


def near_words(counted: DataFrame, cell: int = CELL, most: int = CELL_MOST, sample: int = SAMPLE) -> DataFrame:
    """(word, near, near_n) of every two words of stored ``counted`` (word, n, length) that are one edit apart, both ways."""
    spark = counted.sparkSession
    trees = spark.sparkContext.broadcast(_upper_trees(counted, cell, sample))
    fields = ["word", "n", "length"]

    def by_length(batches: Iterator[pa.RecordBatch]):
        for part in slices(batches, "word"):
            lengths = part.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                own = part.take(pa.array(np.flatnonzero(lengths == length)))
                yield length, own, letter_bits(own.column("word"))

    def settle_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, own, bits in by_length(batches):
            leaf = trees.value[length].home(bits) if length in trees.value else np.zeros(len(bits), np.int64)
            yield pa.RecordBatch.from_arrays([*(own.column(f) for f in fields), pa.array(leaf)], names=[*fields, "leaf"])

    homes = settle(counted.select(fields).mapInArrow(settle_in, "word string, n long, length int, leaf long"), "word-homes")
    full = homes.groupBy("length", "leaf").count().where(F.col("count") > most).collect()
    parts = {(r["length"], r["leaf"]): -(-r["count"] // most) for r in full}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, own, bits in by_length(batches):
            data, bounds = text_bytes(own.column("word"))
            names = span_hash(data, bounds[:-1], bounds[1:]) if len(data) else np.zeros(0, np.uint64)
            for target, role in ((length, MEMBER), (length, SAME), (length + 1, SHORTER)):
                tree = trees.value.get(target)
                if role == MEMBER:
                    row, leaf = np.arange(len(bits)), own.column("leaf").to_numpy()
                elif tree is None:
                    row, leaf = np.arange(len(bits)), np.zeros(len(bits), np.int64)
                else:
                    row, leaf = tree.reach(bits, 1, 1 if role == SAME else 0)
                count = np.array([parts.get((target, f), 1) for f in leaf.tolist()], np.int64)
                if role == MEMBER:
                    piece = (names[row] % count.astype(np.uint64)).astype(np.int64)
                else:
                    row, leaf, piece = np.repeat(row, count), np.repeat(leaf, count), ragged(np.zeros(len(count), np.int64), count)
                sent = own.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), target, np.int32)),
                        pa.array(leaf),
                        pa.array(piece),
                        pa.array(np.full(len(row), role, np.int8)),
                        sent.column("word"),
                        sent.column("n"),
                    ],
                    names=["target", "leaf", "piece", "role", "word", "n"],
                )

    def search(rows: pa.Table) -> pa.Table:
        length, role = rows.column("target")[0].as_py(), rows.column("role").to_numpy()
        sides = [rows.take(pa.array(np.flatnonzero(role == r))).combine_chunks() for r in (MEMBER, SAME, SHORTER)]
        texts = [s.column("word").combine_chunks() for s in sides]
        found = []
        for own, size in ((SAME, length), (SHORTER, length - 1)):
            if len(texts[own]) and len(texts[MEMBER]):
                query, member = (pa.array(x) for x in near_pairs(texts[MEMBER], length, texts[own], size))
                pair = [s.take(i) for s, i in ((sides[own], query), (sides[MEMBER], member))]
                # Words of one length are both asked for; of two lengths, only the shorter one.
                for one, other in (pair, pair[::-1])[: 1 if own == SAME else 2]:
                    found.append(pa.table({"word": one.column("word"), "near": other.column("word"), "near_n": other.column("n")}))
        none = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
        return pa.concat_tables(found or [none])

    sent = homes.mapInArrow(send, "target int, leaf long, piece long, role byte, word string, n long")
    return sent.groupBy("target", "leaf", "piece").applyInArrow(search, "word string, near string, near_n long")


# Forms ---------------------------------------------------------------------------


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms (word, form) ends that begins at a word.

    A round takes each word's root's root, so chains shorten by half; a form has
    ten times the occurrences, so there are few rounds.
    """
    roots = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = broadcast_if_small(roots.select(F.col("word").alias("root"), F.col("root").alias("_next")))
        further = settle(roots.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        roots = further.select("word", "root")
        if further.where("_moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, ratio: int = RATIO, one_in: int = DROP_ONE_IN
) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words with at least ``shortest`` letters and ``fewest`` occurrences."""
    kept = count_words(docs, shortest, one_in).where(F.col("n") >= fewest)
    counted = settle(kept.withColumn("length", F.length("word")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(counted).groupBy("word").agg(F.count("*").alias("n_near"), best)
    common = -F.col("best.less") >= ratio * F.col("n")
    judged = counted.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.less")).alias("form_n"),
    )
    judged = settle(judged, "spelling-forms")
    roots = follow(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
