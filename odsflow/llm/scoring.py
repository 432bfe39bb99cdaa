"""Documents scored by a masked pseudo-likelihood.

Every token is predicted from the ``SIDE`` tokens on either side of it by a small
network: embeddings of the window, one hidden layer, a softmax over classes of
tokens; a token's share of its class is its relative count. A document's score
is the sum of the conditional log-probabilities of all its tokens.

Tokens are the frequent words of the corpus; a rarer word is one of a number of
buckets by its hash, and has its own exact share of its bucket's count: from a
sorted array of the ``KNOWN_WORDS`` most frequent words' counts, or, for rarer
ones, by a join with the counts. Counts, classes and shares come from all rows. Training is
data parallel: in each round every task starts from the common parameters, takes
numpy gradient steps over its own slice (each round one of ``STRIDE`` shares of
the places of every document; the rounds together take every place) and returns
its parameters;
their mean, weighted by places and summed in two levels of groups, starts the
next round. The parameters' size is fixed by the vocabulary.

Defined cases: a null text, or one without words, has no tokens and score 0, its
mean is null; equal texts have equal scores; rows that share a doc_id are scored
each by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from odsflow.llm.store import settle
from odsflow.llm.text import slices, span_hash, text_bytes, words

FREQUENT, BUCKETS, CLASSES = 8192, 1024, 128
SIDE, WIDTH, HIDDEN = 2, 16, 32
#: Every place is trained on: the rounds are a multiple of the stride.
ROUNDS, STRIDE = 2, 2
BATCH, RATE = 2048, 0.004
#: Places scored together, whose logits stay in a core's cache.
SCORED_AT_ONCE = 1 << 11
PARTS = 8
#: Words whose counts every task gets; the counts of rarer ones are joined.
KNOWN_WORDS = 1_000_000

TOKENS = FREQUENT + BUCKETS
PAD = TOKENS


def _names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(texts)
    starts, ends, first = words(data, bounds)
    return (span_hash(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def count_words(docs: DataFrame) -> DataFrame:
    """(name, n) of every word of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names, n = np.unique(_names(part.column("text"))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n.astype(np.int64))], names=["name", "n"])

    return docs.select("text").mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Frequent words in an array sorted by hash; classes of about equal mass."""

    def __init__(self, frequent: list[tuple[int, int]], buckets: dict[int, int]):
        names = np.array([n for n, _ in frequent], np.int64).view(np.uint64)
        by = np.argsort(names)
        self.names, self.ids = names[by], by
        counts = np.ones(TOKENS)
        counts[: len(frequent)] += [c for _, c in frequent]
        self.log_bucket = np.zeros(TOKENS)
        for bucket, count in buckets.items():
            counts[FREQUENT + bucket] += count
            self.log_bucket[FREQUENT + bucket] = np.log(max(count, 1))
        order = np.argsort(-counts, kind="stable")
        mass = np.cumsum(counts[order]) / counts.sum()
        self.classes = np.empty(TOKENS, np.int64)
        self.classes[order] = np.minimum(((mass - counts[order] / counts.sum() / 2) * CLASSES).astype(np.int64), CLASSES - 1)
        in_class = np.bincount(self.classes, counts, CLASSES)
        self.unused = np.flatnonzero(in_class == 0)
        self.log_share = np.log(counts / in_class[self.classes]).astype(np.float32)

    def look_up(self, names: np.ndarray) -> np.ndarray:
        ids = FREQUENT + (names % np.uint64(BUCKETS)).astype(np.int64)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            hit = self.names[at] == names
            ids[hit] = self.ids[at[hit]]
        return ids


def learn_vocabulary(docs: DataFrame) -> Vocabulary:
    return vocabulary_of(settle(count_words(docs), "words"))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    top = counts.orderBy(F.desc("n"), "name").limit(FREQUENT)
    frequent = [(r["name"], r["n"]) for r in top.collect()]
    # pmod of the signed hash equals the remainder of the unsigned one, as BUCKETS is a power of two.
    buckets = counts.groupBy(F.pmod("name", F.lit(BUCKETS)).alias("bucket")).agg(F.sum("n").alias("n")).collect()
    left = {r["bucket"]: r["n"] for r in buckets}
    for name, n in frequent:
        left[name % BUCKETS] -= n
    return Vocabulary(frequent, left)


#: log n(word) is summed in whole units of 2**-32, so that equal texts have equal sums in whatever order.
UNIT = 2.0**32


class KnownCounts:
    """log n(word) of the most frequent words, by their names in ascending order."""

    def __init__(self, names: np.ndarray = np.zeros(0, np.int64), n: np.ndarray = np.zeros(0, np.int64)):
        by = np.argsort(names)
        self.names, self.units = names[by], np.rint(np.log(n[by]) * UNIT).astype(np.int64)

    def units_of(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of each name, and whether it is known."""
        if not len(self.names):
            return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        known = self.names[at] == names
        return self.units[at] * known, known


def known_counts(counts: DataFrame) -> KnownCounts:
    """The words from that count on which at most ``KNOWN_WORDS`` words have."""
    by_count = sorted(((r["n"], r["count"]) for r in counts.groupBy("n").count().collect()), reverse=True)
    least, total = None, 0
    for n, words_of_it in by_count:
        total += words_of_it
        if total > KNOWN_WORDS:
            break
        least = n
    frequent = counts.where(F.col("n") >= least if least is not None else F.lit(False)).select("name", "n").toArrow()
    return KnownCounts(frequent.column("name").to_numpy(), frequent.column("n").to_numpy())


def tokens_of(docs: DataFrame, vocabulary: Vocabulary, known: KnownCounts | None = None) -> DataFrame:
    """(doc_id, tokens: 16-bit ids, rare: names of the words in buckets that are not ``known``, of_known: what the
    others' counts add up to) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, known or KnownCounts()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = shared.value
        for part in slices(batches):
            names, first = _names(part.column("text"))
            ids = vocabulary.look_up(names).astype("<u2")
            rare = ids >= FREQUENT
            units, counted = known.units_of(names[rare].view(np.int64))
            before = np.concatenate([[0], np.cumsum(rare)])[first]
            left = np.concatenate([[0], np.cumsum(~counted)])[before]
            sums = np.concatenate([[0], np.cumsum(units)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), _blobs(ids, first), _blobs(names[rare][~counted], left), pa.array(np.diff(sums[before]))],
                names=["doc_id", "tokens", "rare", "of_known"],
            )

    schema = "doc_id long, tokens binary, rare binary, of_known long"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, schema)


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def rare_logs(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, units): the sum of log n(word) over the names in ``rare``, of each row of ``tokens`` that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "rare"):
            data, bounds = text_bytes(part.column("rare").cast(pa.binary()))
            names = np.frombuffer(data.tobytes(), np.int64)
            row = np.repeat(part.column("row").to_numpy(), np.diff(bounds // 8))
            by = np.lexsort((names, row))
            names, row = names[by], row[by]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (names[1:] != names[:-1])
            start = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[start]), pa.array(names[start]), pa.array(np.diff(np.append(start, len(row))))], names=["row", "name", "times"]
            )

    found = tokens.select("row", "rare").mapInArrow(run, "row long, name long, times long").join(counts, "name")
    units = F.sum(F.col("times") * F.round(F.log("n") * UNIT).cast("long"))
    return found.groupBy("row").agg(units.alias("units"))


def _places(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, row) of all places of a slice."""
    data, bounds = text_bytes(part.column("tokens").cast(pa.binary()))
    return np.frombuffer(data.tobytes(), "<u2"), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds // 2))


def _contexts(tokens: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens on either side of the places ``at``, within their rows."""
    padded = np.concatenate([tokens, [PAD]]).astype(np.uint16)
    context = np.empty((len(at), 2 * SIDE), np.uint16)
    for column, k in enumerate((*range(-SIDE, 0), *range(1, SIDE + 1))):
        near = at + k
        inside = (near >= 0) & (near < len(tokens))
        inside[inside] = row[near[inside]] == row[at[inside]]
        context[:, column] = padded[np.where(inside, near, len(tokens))]
    return context


Parameters = dict[str, np.ndarray]


def initial(seed: int = 0) -> Parameters:
    random = np.random.default_rng(seed)
    shapes = {"embed": (TOKENS + 1, WIDTH), "hidden": (2 * SIDE * WIDTH, HIDDEN), "hidden_bias": (HIDDEN,), "out": (HIDDEN, CLASSES), "out_bias": (CLASSES,)}
    scale = {"embed": 0.1, "hidden": 0.12, "out": 0.1}
    return {k: (random.standard_normal(s) * scale.get(k, 0)).astype(np.float32) for k, s in shapes.items()}


#: Logits below this need no shift before the exponential.
SAFE_LOGIT = 60


def _forward(p: Parameters, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = p["embed"][context].reshape(len(context), -1)
    h = x @ p["hidden"]
    h += p["hidden_bias"]
    np.tanh(h, out=h)
    logits = h @ p["out"]
    logits += p["out_bias"]
    # The hidden layer is between -1 and 1, so this bounds every logit.
    if (np.abs(p["out"]).sum(axis=0) + np.abs(p["out_bias"])).max() > SAFE_LOGIT:
        logits -= logits.max(axis=1, keepdims=True)
    return x, h, logits


class Trainer:
    """Adam over mini-batches; of the embeddings, only those in a batch are moved."""

    def __init__(self, parameters: Parameters):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps = 0

    def step(self, context: np.ndarray, classes: np.ndarray) -> None:
        p, n = self.p, len(context)
        x, h, logits = _forward(p, context)
        d = np.exp(logits, out=logits)
        d *= 1 / (n * d.sum(axis=1, keepdims=True))
        d[np.arange(n), classes] -= 1 / n
        dh = d @ p["out"].T
        dh *= 1 - h * h
        dx = (dh @ p["hidden"].T).reshape(n * 2 * SIDE, WIDTH)
        flat = context.ravel()
        by = np.argsort(flat, kind="stable")
        new = np.ones(len(by), bool)
        new[1:] = flat[by[1:]] != flat[by[:-1]]
        starts = np.flatnonzero(new)
        grads = {"hidden": x.T @ dh, "hidden_bias": dh.sum(axis=0), "out": h.T @ d, "out_bias": d.sum(axis=0)}
        self.steps += 1
        touched = flat[by[starts]]
        self._move("embed", touched, np.add.reduceat(dx[by], starts, axis=0))
        for k, g in grads.items():
            self._move(k, slice(None), g)

    def _move(self, name: str, rows, g: np.ndarray) -> None:
        fix1, fix2 = 1 - 0.9**self.steps, 1 - 0.999**self.steps
        m, v = self.m[name][rows], self.v[name][rows]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        self.m[name][rows], self.v[name][rows] = m, v
        self.p[name][rows] -= RATE * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)


def _flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray) -> Parameters:
    out, at = {}, 0
    for k, like in sorted(initial().items()):
        out[k] = flat[at : at + like.size].reshape(like.shape).astype(np.float32)
        at += like.size
    return out


def train(tokens: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, stride: int = STRIDE) -> Parameters:
    """Parameters after ``rounds`` rounds of data-parallel training over ``tokens``."""
    spark = tokens.sparkSession
    parameters = initial()
    tokens = tokens.select("doc_id", "tokens")
    classes = spark.sparkContext.broadcast(vocabulary.classes)
    for number in range(rounds):
        start = spark.sparkContext.broadcast(parameters)

        def run(batches: Iterator[pa.RecordBatch], number: int = number, start=start) -> Iterator[pa.RecordBatch]:
            trainer, places, waiting = Trainer(start.value), 0, []
            for part in slices(batches, "tokens"):
                own, row = _places(part)
                ids = part.column("doc_id").fill_null(0).to_numpy()
                mine = np.flatnonzero((np.arange(len(own)) + ids[row]) % stride == number % stride)
                np.random.default_rng(number).shuffle(mine)
                waiting.append((_contexts(own, row, mine), classes.value[own[mine]]))
                places += len(mine)
                context, wanted = (np.concatenate(x) for x in zip(*waiting))
                full = len(wanted) // BATCH * BATCH
                for at in range(0, full, BATCH):
                    trainer.step(context[at : at + BATCH], wanted[at : at + BATCH])
                waiting = [(context[full:], wanted[full:])]
            if waiting and len(waiting[0][1]):
                trainer.step(*waiting[0])
            if places:
                flat = _flat(trainer.p) * places
                cut = [x.astype(np.float32).tobytes() for x in np.array_split(flat, PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(PARTS), pa.int32()), pa.array([places] * PARTS, pa.int64()), pa.array(cut, pa.binary())],
                    names=["piece", "places", "sums"],
                )

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            total = np.sum([np.frombuffer(b, np.float32).astype(float) for b in rows["sums"]], axis=0)
            return pd.DataFrame({"piece": [int(rows["piece"].iloc[0])], "places": [int(rows["places"].sum())], "sums": [total.astype(np.float32).tobytes()]})

        schema = "piece int, places long, sums binary"
        own = tokens.mapInArrow(run, schema).withColumn("_group", F.spark_partition_id() % 64)
        some = own.groupBy("piece", "_group").applyInPandas(add, schema)
        rows = sorted(some.groupBy("piece").applyInPandas(add, schema).collect(), key=lambda r: r["piece"])
        if not rows:
            break
        parameters = _shaped(np.concatenate([np.frombuffer(r["sums"], np.float32) / r["places"] for r in rows]))
    return parameters


def log_probabilities(p: Parameters, vocabulary: Vocabulary, own: np.ndarray, context: np.ndarray) -> np.ndarray:
    out = np.empty(len(own), np.float32)
    for at in range(0, len(own), SCORED_AT_ONCE):
        part = slice(at, at + SCORED_AT_ONCE)
        _, _, logits = _forward(p, context[part])
        logits[:, vocabulary.unused] = -np.inf
        picked = logits[np.arange(len(logits)), vocabulary.classes[own[part]]]
        np.exp(logits, out=logits)
        out[part] = picked - np.log(logits.sum(axis=1)) + vocabulary.log_share[own[part]]
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, score and mean_score of every row of ``docs``, by a model of these rows."""
    sc = docs.sparkSession.sparkContext
    counts = settle(count_words(docs), "words")
    vocabulary = vocabulary_of(counts)
    found = tokens_of(docs, vocabulary, known_counts(counts))
    tokens = settle(found.withColumn("row", F.monotonically_increasing_id()), "tokens")
    shared = sc.broadcast((train(tokens, vocabulary), vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters, words_known = shared.value
        for part in slices(batches, "tokens", 1 << 20):
            own, row = _places(part)
            logs = log_probabilities(parameters, words_known, own, _contexts(own, row, np.arange(len(own)))) - words_known.log_bucket[own]
            total = np.bincount(row, logs, part.num_rows)
            n = np.bincount(row, minlength=part.num_rows)
            kept = [part.column(c) for c in ("row", "doc_id", "of_known")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n), pa.array(total)], names=["row", "doc_id", "of_known", "n_tokens", "_of_tokens"])

    scored = tokens.select("row", "doc_id", "tokens", "of_known").mapInArrow(
        run, "row long, doc_id long, of_known long, n_tokens long, _of_tokens double"
    )
    scored = scored.join(rare_logs(tokens, counts), "row", "left")
    score = F.col("_of_tokens") + (F.col("of_known") + F.coalesce("units", F.lit(0))) / UNIT
    mean = F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", score.alias("score")).withColumn("mean_score", mean)
