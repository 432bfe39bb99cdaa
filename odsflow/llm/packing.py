"""Best-fit packing of documents into sequences of bounded length.

Bulk-synchronous best-fit. The pieces are range-sorted by length; a piece's
place in that order is its rank. Lengths and gaps are whole numbers up to the
capacity, so the pieces of one length are one run of ranks and the sequences of
one gap are one run too, however many there are. In each round every run of
unplaced pieces looks for its successor, the smallest gap that holds it; runs
that want the same gap take it by rank, longest first; the gaps shrink, and the
next round starts. Where no run finds a gap, the longest opens new sequences.

What the rounds exchange is those runs, at most one for each length and a few
for each gap; the bound is the capacity, not the data, so the rounds run on the
driver on a histogram of at most ``capacity`` rows. The rows themselves are
sorted, ranked and given their places in Spark.

Defined cases: a null or empty text is one piece that holds the end mark only;
equal doc_ids are packed as separate rows (their order among each other is
free); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from odsflow.llm.store import settle
from odsflow.llm.text import slices
from odsflow.llm.tokens import crc32, token_ids

CAPACITY = 4096
END_ID = 1
ROWS_PER_RANGE = 250_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: a document's ids, the end mark last, cut only where it exceeds ``capacity``."""
    mark = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, bounds = token_ids(part.column("text"), vocabulary)
            lengths = np.diff(bounds) + 1
            count = -(-lengths // capacity)
            row = np.repeat(np.arange(part.num_rows), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(lengths[row] - start, capacity)
            begin = bounds[row] + start
            last = piece == count[row] - 1
            sums = []
            for b, n, is_last in zip(begin.tolist(), length.tolist(), last.tolist()):
                own = crc32(ids[b : b + n - is_last])
                sums.append(crc32(mark, own) if is_last else own)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(np.array(sums, np.int64)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length.

    Rows (rank, pieces, length, sequence, offset, each): the pieces ranked from
    ``rank`` on fill the sequences from ``sequence`` on, ``each`` to a sequence,
    beginning at ``offset``. Ranks count from the longest piece.
    """
    order = sorted(counts, reverse=True)
    rank = dict(zip(order, np.cumsum([0, *(counts[n] for n in order)]).tolist()))
    left = dict(counts)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (sequence, sequences)
    places: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def fill(length: int, gap: int, first: int, sequences: int, grown: dict) -> None:
        """Put pieces of ``length`` into that run of gaps; what is left of it goes to ``grown``."""
        each = gap // length
        full = min(sequences, left[length] // each)
        rest = min(left[length] - full * each, each) if full < sequences else 0
        for begin, number, per in ((first, full, each), (first + full, 1, rest)):
            if number and per:
                places.append((rank[length], number * per, length, begin, capacity - gap, per))
                rank[length] += number * per
                left[length] -= number * per
                grown[gap - per * length].append((begin, number))
        used = full + (rest > 0)
        if used < sequences:
            grown[gap].append((first + used, sequences - used))

    while live := [n for n in order if left[n]]:
        sizes = np.array(sorted(g for g in gaps if g and gaps[g]), np.int64)
        successor = np.searchsorted(sizes, live)
        claims = defaultdict(list)
        for length, at in zip(live, successor.tolist()):
            if at < len(sizes):
                claims[int(sizes[at])].append(length)
        grown = defaultdict(list)
        if not claims:
            length = live[0]
            each = capacity // length
            new = -(-left[length] // each)
            fill(length, capacity, opened, new, grown)
            opened += new
        for gap, lengths in claims.items():
            runs = gaps.pop(gap)
            for length in lengths:
                still = defaultdict(list)
                for begin, number in runs:
                    if left[length]:
                        fill(length, gap, begin, number, still)
                    else:
                        still[gap].append((begin, number))
                runs = still.pop(gap, [])
                for size, more in still.items():
                    grown[size] += more
            if runs:
                grown[gap] += runs
        for size, more in grown.items():
            gaps.setdefault(size, []).extend(more)
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``length`` is 1 to ``capacity``. ``pieces`` is read several times, so pass a
    stored table.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"a piece's length must be 1 to {capacity}")
    ranges = max(1, sum(counts.values()) // ROWS_PER_RANGE)
    ordered = [F.desc("length"), F.asc("doc_id"), F.asc("piece")]
    # The ranges are kept as a column: a lost task is computed again from a stored table.
    ranged = settle(pieces.repartitionByRange(ranges, *ordered).withColumn("_range", F.spark_partition_id()), "ranges")
    before, sizes = {}, sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    total = 0
    for at, size in sizes:
        before[at] = total
        total += size
    places = np.array(best_fit(counts, capacity), np.int64).reshape(-1, 6)
    places = places[np.argsort(places[:, 0])]
    offsets = spark.createDataFrame([(k, v) for k, v in before.items()], "_range int, _before long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = batch.column("_rank").to_numpy()
            at = np.searchsorted(places[:, 0], ranks, side="right") - 1
            first, _, length, sequence, offset, each = places[at].T
            nth = ranks - first
            kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "_rank"]
            names = [n for n in batch.schema.names if n != "_rank"]
            kept += [pa.array(sequence + nth // each), pa.array(offset + nth % each * length)]
            yield pa.RecordBatch.from_arrays(kept, names=[*names, "sequence_id", "offset"])

    window = Window.partitionBy("_range").orderBy(*ordered)
    ranked = ranged.withColumn("_nth", F.row_number().over(window).cast("long") - 1)
    ranked = ranked.join(F.broadcast(offsets), "_range").withColumn("_rank", F.col("_before") + F.col("_nth"))
    ranked = ranked.drop("_range", "_nth", "_before")
    kept = [f for f in ranked.schema.fields if f.name != "_rank"]
    result = T.StructType(kept).add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, result)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize whole documents and pack them; one row per piece, with its place."""
    return pack(settle(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
