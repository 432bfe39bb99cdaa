"""Language identification by interpolated Kneser-Ney character models.

A text is read in lower case; what is not a letter is a space, spaces in a row
are one. Every language has a character model of order four: counts come from
all learning rows and are summed in Spark; the lower orders use the number of
different characters seen before a gram, and all orders are interpolated down
to a uniform one. The models share arrays sorted by the hash of the gram, with
a column of log-probabilities for each language. ``MODEL_GRAMS`` bounds them:
of a language with more four-grams, those of the least counts are left to the
lower orders.

A document's language is the one of the lowest cross-entropy per character. Its
score weighs it against the other languages, and falls where the entropy lies
above what documents of that language have: the reach is set by the mean and
deviation over all learning rows.

Defined cases: a null text, or one without letters, is ``und`` with score 0; a
null doc_id is held out of learning; without any learning row every document is
``und``; repeated rows count as often as they come; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.store import settle
from odsflow.llm.text import mix, slices

ORDER = 4
MODEL_GRAMS = 250_000
UNKNOWN = "und"
#: Characters by which a language must be ahead, at one nat each, to be sure; deviations until rejection.
SHARPNESS, REACH = 25.0, 4.0

_SPACE = 32
_BITS = 21
_MASK = (1 << 63) - 1
_letters = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
    out = _letters[np.minimum(codes, 0xFFFF)]
    far = codes > 0xFFFF
    if far.any():
        out[far] = [chr(c).isalpha() for c in codes[far].tolist()]
    return out


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of letters and single spaces, each text led by a space; bounds; texts that have a letter."""
    joined = "\0".join((t or "").replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(("\0" + joined).encode("utf-32-le"), np.uint32)
    opens = codes == 0
    letter = _is_letter(codes)
    row = np.cumsum(opens) - 1
    space = ~letter
    kept = letter | opens
    kept[1:] |= letter[:-1]
    held = np.where(space, _SPACE, codes)[kept].astype(np.int64)
    row = row[kept]
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    return held, bounds, np.bincount(row, held != _SPACE, len(texts)) > 0


def grams(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context of three characters, character, row) at each place but the leading space."""
    context = np.zeros(len(codes), np.int64)
    for back in (3, 2, 1):
        shifted = np.full(len(codes), _SPACE)
        shifted[back:] = codes[:-back]
        context = (context << _BITS) | shifted
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(codes)) - bounds[:-1][row]
    # Before a text there is nothing but spaces.
    for back in (2, 3):
        early = (place > 0) & (place < back)
        context[early] &= (1 << (_BITS * (back - 1))) - 1
        for k in range(back - 1, 3):
            context[early] |= _SPACE << (_BITS * k)
    inside = place > 0
    return context[inside], codes[inside], row[inside]


def learning(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, context, ch, n) over all rows of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=2 << 20):
            langs = part.column("lang").to_pylist()
            texts = part.column("text").to_pylist()
            names = sorted(set(langs))
            for name in names:
                codes, bounds, _ = characters([t for t, lang in zip(texts, langs) if lang == name])
                context, ch, _ = grams(codes, bounds)
                whole = pd.DataFrame({"context": context, "ch": ch}).value_counts().reset_index()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(whole)), *(pa.array(whole[c].to_numpy(np.int64)) for c in ("context", "ch", "count"))],
                    names=["lang", "context", "ch", "n"],
                )

    found = docs.select("lang", "text").mapInArrow(run, "lang string, context long, ch long, n long")
    return found.groupBy("lang", "context", "ch").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of all languages by gram, in arrays sorted by hash."""

    def __init__(self, counts: pd.DataFrame, ones: dict[str, tuple[int, int]]):
        self.langs = sorted(counts["lang"].unique())
        alphabet = max(2, counts["ch"].nunique()) + 1
        self.floor = np.full(len(self.langs), -np.log(alphabet), np.float32)
        per_order: list[dict[str, pd.DataFrame]] = []
        tables = {lang: part[["context", "ch", "n"]].copy() for lang, part in counts.groupby("lang")}
        for order in range(ORDER, 0, -1):
            per_order.append(tables)
            shorter = {}
            for lang, part in tables.items():
                bits = _BITS * max(order - 2, 0)
                less = part["context"] & ((1 << bits) - 1)
                shorter[lang] = pd.DataFrame({"context": less, "ch": part["ch"]}).value_counts().reset_index(name="n")
            tables = shorter
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # by order, from one
        self.backoff: list[tuple[np.ndarray, np.ndarray]] = []
        for order, tables in zip(range(1, ORDER + 1), reversed(per_order)):
            self._add(order, tables, ones if order == ORDER else None)

    def _add(self, order: int, tables: dict[str, pd.DataFrame], ones) -> None:
        contexts = np.unique(np.concatenate([t["context"].to_numpy() for t in tables.values()]))
        pairs = pd.concat(tables.values())[["context", "ch"]].drop_duplicates()
        context, ch = pairs["context"].to_numpy(), pairs["ch"].to_numpy()
        fall = np.zeros((len(contexts), len(self.langs)), np.float32)
        direct = np.zeros((len(pairs), len(self.langs)))
        for i, lang in enumerate(self.langs):
            t = tables[lang]
            n = t["n"].to_numpy(float)
            n1, n2 = ones[lang] if ones else (int((n == 1).sum()), int((n == 2).sum()))
            discount = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
            sums = t.groupby("context")["n"].agg(["sum", "count"])
            at = np.searchsorted(contexts, sums.index.to_numpy())
            fall[at, i] = np.log(np.minimum(discount * sums["count"] / sums["sum"], 1.0))
            share = np.maximum(n - discount, 0) / sums["sum"].reindex(t["context"]).to_numpy()
            merged = pairs.merge(t.assign(p=share), on=["context", "ch"], how="left")
            direct[:, i] = merged["p"].fillna(0).to_numpy()
        names = self.name(context, ch)
        less = self._log_p(order - 1, context & ((1 << (_BITS * max(order - 2, 0))) - 1), ch)
        logs = np.log(direct + np.exp(fall[np.searchsorted(contexts, context)].astype(float) + less)).astype(np.float32)
        by = np.argsort(names)
        self.grams.append((names[by], logs[by]))
        tags = mix(contexts.view(np.uint64))
        by = np.argsort(tags)
        self.backoff.append((tags[by], fall[by]))

    @staticmethod
    def name(context: np.ndarray, ch: np.ndarray) -> np.ndarray:
        return mix(mix(context.view(np.uint64)) + ch.astype(np.uint64))

    def _log_p(self, order: int, context: np.ndarray, ch: np.ndarray) -> np.ndarray:
        out = np.tile(self.floor, (len(ch), 1))
        if order == 0 or not len(ch):
            return out
        context = np.ascontiguousarray(context)
        names, logs = self.grams[order - 1]
        asked = self.name(context, ch)
        at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        hit = names[at] == asked
        out[hit] = logs[at[hit]]
        miss = ~hit
        if miss.any():
            left = context[miss]
            tags, fall = self.backoff[order - 1]
            tag = mix(left.view(np.uint64))
            where = np.minimum(np.searchsorted(tags, tag), len(tags) - 1)
            weight = np.where((tags[where] == tag)[:, None], fall[where], 0)
            out[miss] = weight + self._log_p(order - 1, left & ((1 << (_BITS * max(order - 2, 0))) - 1), ch[miss])
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of every text in every language; characters, 0 without a letter."""
        codes, bounds, lettered = characters(texts)
        context, ch, row = grams(codes, bounds)
        total = np.zeros((len(texts), len(self.langs)))
        if len(ch):
            names = self.name(context, ch)
            _, example, inverse = np.unique(names, return_index=True, return_inverse=True)
            logs = self._log_p(ORDER, context[example], ch[example])
            for i in range(len(self.langs)):
                total[:, i] = np.bincount(row, logs[inverse, i], len(texts))
        n = np.bincount(row, minlength=len(texts))
        return -total / np.maximum(n, 1)[:, None], np.where(lettered, n, 0)


def fit(docs: DataFrame, model_grams: int = MODEL_GRAMS) -> Model | None:
    """Models of all languages in ``docs`` (lang, text), all rows counted."""
    counts = settle(count_grams(docs.where("lang is not null and text is not null")), "grams")
    sizes = counts.groupBy("lang", F.least("n", F.lit(1000)).alias("n")).count().toPandas()
    if not len(sizes):
        return None
    kept, ones = None, {}
    for lang, part in sizes.groupby("lang"):
        by = part.set_index("n")["count"].sort_index()
        ones[lang] = (int(by.get(1, 0)), int(by.get(2, 0)))
        above = by[::-1].cumsum()
        least = int(above[above <= model_grams].index.min()) if (above <= model_grams).any() else 1000
        own = (F.col("lang") == lang) & (F.col("n") >= least)
        kept = own if kept is None else kept | own
    return Model(counts.where(kept).toPandas(), ones)


def identify(docs: DataFrame, learn: Column | None = None, model_grams: int = MODEL_GRAMS) -> DataFrame:
    """doc_id, lang_pred, score, entropy and rejected of every row of ``docs`` (doc_id, text, lang)."""
    spark = docs.sparkSession
    learn = learning(F.col("doc_id")) if learn is None else learn
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", learn.alias("learn"))
    model = fit(docs.where("learn"), model_grams)
    if model is None:
        return docs.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected")
        )
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(batches, limit=2 << 20):
            nats, n = own.entropies(part.column("text").to_pylist())
            best = nats.argmin(axis=1)
            least = nats.min(axis=1)
            ahead = np.exp(-np.minimum((nats - least[:, None]) * SHARPNESS, 700)).sum(axis=1)
            lang = np.array([*own.langs, UNKNOWN], object)[np.where(n > 0, best, len(own.langs))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(lang, pa.string()),
                    pa.array(np.where(n > 0, 1 / ahead, 0.0)),
                    pa.array(least, mask=n == 0),
                    part.column("learn"),
                    part.column("lang"),
                ],
                names=["doc_id", "lang_pred", "_ahead", "entropy", "learn", "lang"],
            )

    schema = "doc_id long, lang_pred string, _ahead double, entropy double, learn boolean, lang string"
    scored = settle(docs.mapInArrow(run, schema), "scored")
    usual = scored.where("learn and lang = lang_pred").groupBy("lang_pred").agg(
        F.avg("entropy").alias("_mean"), F.stddev_pop("entropy").alias("_deviation")
    )
    scored = scored.join(F.broadcast(usual), "lang_pred", "left")
    beyond = (F.col("entropy") - F.col("_mean")) / (REACH * F.greatest("_deviation", F.lit(0.01)))
    inside = F.when(beyond > 0, F.exp(-F.lit(0.7) * beyond * beyond)).otherwise(1.0)
    score = F.coalesce(F.col("_ahead") * F.when(F.col("_mean").isNull(), 1.0).otherwise(inside), F.lit(0.0))
    rejected = F.col("entropy").isNull() | F.coalesce(beyond > 1, F.lit(False))
    return scored.select("doc_id", "lang_pred", score.alias("score"), "entropy", rejected.alias("rejected"))
