"""Alignment of the tokens of two vocabularies over the same texts.

Lockstep vectorised merging. A document's text, a blank before it, is tokenized
by the byte-level vocabulary (A) and the piece vocabulary (B). One NumPy state
vector holds a pointer to the current A and the current B token of every document
of a batch; a long document has several such lanes, which part where the text may
be cut for both vocabularies. In each step every lane emits the link of its two
tokens, then advances the one that ends first in the text's bytes, or both where
they end together, which is a cut between groups; lanes that are done leave the
vector.

Counts are of documents. Each document's distinct links are stored with their
multiplicity; a link's count is summed over all documents after a first sum in
each task. The counts then come back in blocks of whole A ids, each of at most
``BLOCK_LINKS`` links (or one A id's), so what a task holds does not grow with the
corpus; a document's sums over the blocks add up.

Defined cases: a null or empty text, and one whose tokens' bytes are not the
text's (as with a character that vocabulary B takes for a blank), has no tokens:
zeros and an empty text of groups. Rows that share a doc_id, or a text, are
documents by themselves; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from odsflow.llm.store import settle
from odsflow.llm.text import slices, text_bytes
from odsflow.llm.units import byte_units, piece_units, tokenize, unit_starts

#: A tokens of a lane, about; a lane ends with a unit.
LANE = 128
#: Bytes of text whose lanes advance together.
BATCH_BYTES = 1 << 20
BLOCK_LINKS = 4_000_000
#: Links that a task counts together before they are shuffled.
COUNTED_AT_ONCE = 8_000_000

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, times binary"


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray):
    """Links (A place, B place) and cuts (last A place, last B place of a group) of all lanes.

    ``ends`` are the tokens' ends in bytes; a lane goes from its ``a`` and ``b`` to
    ``stop_a``, where its last tokens end together.
    """
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        links_a.append(a)
        links_b.append(b)
        a_done, b_done = end_a <= end_b, end_b <= end_a
        cut = a_done & b_done
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + a_done, b + b_done
        live = a < stop_a
        if not live.all():
            a, b, stop_a = a[live], b[live], stop_a[live]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (links_a, links_b, cuts_a, cuts_b))


@functools.cache
def _digits(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``ids``, with room for one sign more, and how many there are."""
    text = np.arange(ids).astype(bytes)
    digits = text.view(np.uint8).reshape(ids, -1)
    return np.concatenate([digits, np.zeros((ids, 1), np.uint8)], axis=1), np.char.str_len(text)


def _group_texts(ids_a, ids_b, bounds_a, bounds_b, cuts_a, cuts_b, n_ids: int) -> pa.Array:
    """``a1,a2|b1;a3|b2`` of each document, from all its ids and the groups' last places."""
    cuts_a, cuts_b = np.sort(cuts_a), np.sort(cuts_b)
    groups = np.arange(len(cuts_a))
    of_a = np.repeat(groups, np.diff(cuts_a, prepend=-1))
    of_b = np.repeat(groups, np.diff(cuts_b, prepend=-1))
    # A group's A ids stand behind the B ids of the groups before it, its B ids behind its own A ids.
    at_a = np.arange(len(ids_a)) + np.concatenate([[0], cuts_b + 1])[of_a]
    at_b = np.arange(len(ids_b)) + cuts_a[of_b] + 1
    ids, sign = np.empty(len(at_a) + len(at_b), np.uint32), np.full(len(at_a) + len(at_b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    sign[at_a[cuts_a]], sign[at_b[cuts_b]] = ord("|"), ord(";")
    digits, width = _digits(n_ids)
    rows, n = digits[ids], width[ids]
    rows[np.arange(len(ids)), n] = sign
    flat = rows[np.arange(rows.shape[1]) <= n[:, None]]
    ends = np.concatenate([[0], np.cumsum(n + 1)])[bounds_a + bounds_b]
    # The sign after a document's last id goes.
    raw, filled = flat.tobytes(), np.diff(bounds_a) > 0
    return pa.array([raw[s : e - 1].decode() if f else "" for s, e, f in zip(ends[:-1].tolist(), ends[1:].tolist(), filled.tolist())], pa.string())


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def _aligned(part: pa.RecordBatch, path_a: str, path_b: str) -> pa.RecordBatch:
    known_a, known_b = byte_units(path_a), piece_units(path_b)
    texts, rows = part.column("text"), part.num_rows
    empty = pc.equal(pc.fill_null(pc.binary_length(texts), 0), 0)
    data, bounds = text_bytes(pc.if_else(empty, "", pc.binary_join_element_wise(" ", texts, "")))
    starts = unit_starts(data, bounds)
    (ids_a, count_a, whole_a), (ids_b, count_b, whole_b) = tokenize(data, starts, [known_a, known_b])
    # Documents with a unit whose tokens' bytes are not its own have no tokens.
    row = np.searchsorted(bounds, starts, side="right") - 1
    bad = np.zeros(rows, bool)
    bad[row[~(whole_a & whole_b)]] = True
    kept = ~bad[row]
    ids_a, ids_b = ids_a[np.repeat(kept, count_a)], ids_b[np.repeat(kept, count_b)]
    row, count_a, count_b = row[kept], count_a[kept], count_b[kept]
    places_a, places_b = (np.concatenate([[0], np.cumsum(c)]) for c in (count_a, count_b))
    first = np.searchsorted(row, np.arange(rows + 1))
    bounds_a, bounds_b = places_a[first], places_b[first]
    # A lane begins with a document, and with the first unit behind LANE tokens of it.
    nth = (places_a[:-1] - bounds_a[row]) // LANE
    opens = np.ones(len(row), bool)
    opens[1:] = (row[1:] != row[:-1]) | (nth[1:] != nth[:-1])
    lane = np.flatnonzero(opens)
    stops = np.append(places_a[lane[1:]], len(ids_a))[: len(lane)]
    # Both vocabularies' ends count the same bytes, as the tokens of a unit cover it.
    ends_a, ends_b = np.cumsum(known_a.lengths[ids_a]), np.cumsum(known_b.lengths[ids_b])
    link_a, link_b, cut_a, cut_b = lockstep(ends_a, ends_b, places_a[lane], places_b[lane], stops)
    of = np.repeat(np.arange(rows), np.diff(bounds_a))
    n_b, width = len(known_b.lengths), link_type(len(known_a.lengths), len(known_b.lengths))
    names = ids_a[link_a].astype(np.int64) * n_b + ids_b[link_b]
    distinct, times = np.unique((of[link_a] << 40) | names, return_counts=True)
    own = np.searchsorted(distinct >> 40, np.arange(rows + 1))
    columns = [
        part.column("doc_id"),
        pa.array(np.diff(bounds_a)),
        pa.array(np.diff(bounds_b)),
        pa.array(np.bincount(of[cut_a], minlength=rows)),
        pa.array(np.bincount(of[link_a], minlength=rows)),
        _group_texts(ids_a, ids_b, bounds_a, bounds_b, cut_a, cut_b, max(len(known_a.lengths), n_b)),
        _blobs((distinct & ((1 << 40) - 1)).astype(width), own),
        _blobs(times.astype("<u4"), own),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in ALIGNED.split(", ")])


def vocabulary_sizes(path_a: str, path_b: str) -> tuple[int, int]:
    return len(byte_units(path_a).lengths), len(piece_units(path_b).lengths)


def link_type(n_a: int, n_b: int) -> str:
    """How a link's name, A id * ``n_b`` + B id, is stored."""
    return "<u4" if n_a * n_b <= 1 << 32 else "<i8"


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's tokens, groups and links.

    ``groups`` reads ``a1,a2|b1;a3|b2``; ``links`` holds the names of the distinct
    links in ascending order, ``times`` how often each occurs (32 bit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=BATCH_BYTES):
            yield _aligned(part, path_a, path_b)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def count_links(aligned: DataFrame, width: str) -> DataFrame:
    """(link, n): how many documents hold each link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def counted() -> pa.RecordBatch:
            names, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(n)], names=["link", "n"])

        for part in slices(batches, "links"):
            data, _ = text_bytes(part.column("links").cast(pa.binary()))
            waiting.append(np.frombuffer(data.tobytes(), width))
            size += len(waiting[-1])
            if size > COUNTED_AT_ONCE:
                yield counted()
                waiting, size = [], 0
        if size:
            yield counted()

    return aligned.select("links").mapInArrow(run, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))


def _blocks(counts: DataFrame, n_b: int, most: int) -> list[tuple[int, int]]:
    """Ranges of A ids with at most ``most`` links each, or of one id; the vocabulary bounds what is collected."""
    own = counts.groupBy(F.expr(f"link div {n_b}").alias("a")).agg(F.count("*").alias("n")).collect()
    blocks, low, size = [], None, 0
    for a, n in sorted((r["a"], r["n"]) for r in own):
        if low is None or size + n > most:
            blocks += [] if low is None else [(low, a)]
            low, size = a, 0
        size += n
    return blocks + ([] if low is None else [(low, max(r["a"] for r in own) + 1)])


def rate_links(aligned: DataFrame, n_a: int, n_b: int, most: int = BLOCK_LINKS) -> DataFrame:
    """Stored ``aligned`` rows with ``n_best`` and ``count_sum``.

    ``n_best`` counts the links whose count is the highest of their A id,
    ``count_sum`` adds up the counts of all links.
    """
    spark, width = aligned.sparkSession, link_type(n_a, n_b)
    counts = settle(count_links(aligned, width), "link-counts")
    rated = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    names_out, schema = rated.columns, rated.schema
    blocks = _blocks(counts, n_b, most)
    for k, (low, high) in enumerate(blocks):
        block = counts.where((F.col("link") >= low * n_b) & (F.col("link") < high * n_b)).toArrow()
        names, n = (block.column(c).to_numpy() for c in ("link", "n"))
        by = np.argsort(names)
        names, n = names[by], n[by]
        a = names // n_b
        fresh = np.flatnonzero(np.diff(a, prepend=-1))
        best = np.repeat(np.maximum.reduceat(n, fresh), np.diff(np.append(fresh, len(a))))
        shared = spark.sparkContext.broadcast((names.astype(width), n, n == best))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, n, best = shared.value
            for part in slices(batches, "links"):
                data, bounds = text_bytes(part.column("links").cast(pa.binary()))
                links = np.frombuffer(data.tobytes(), width)
                times = np.frombuffer(text_bytes(part.column("times").cast(pa.binary()))[0].tobytes(), "<u4").astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), np.diff(bounds) // links.itemsize)
                at = np.minimum(np.searchsorted(names, links), len(names) - 1)
                times *= names[at] == links
                sums = [np.zeros(part.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], row, times * best[at])
                np.add.at(sums[1], row, times * n[at])
                old = [part.column(c).to_numpy() for c in ("n_best", "count_sum")]
                kept = [c for c, f in zip(part.columns, part.schema) if f.name not in ("n_best", "count_sum")]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(o + s) for o, s in zip(old, sums))], names=names_out)

        rated = rated.mapInArrow(run, schema)
        if k + 1 < len(blocks):
            rated = settle(rated, "rated")
    return rated
