"""Quality by weak supervision: rules vote, EM weighs them, a posterior decides.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains
(0). A two-class model explains the votes: a document is good with a prior
probability, and a rule that votes is right with an accuracy of its own.
Expectation-maximisation fits prior and accuracies to the table of vote patterns
(at most ``3 ** rules`` rows, whatever the number of documents); no label is
read. A document's posterior probability of being good replaces a filter that
would ask every rule to pass. DataFrame functions only.

Defined cases: a null text has no words; a text without words fails the base
rules; rows are judged each by itself, so repeated rows and doc_ids get equal
results; an empty table gives no rows; a column that has the name of a result is
replaced, others pass through where asked for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.store import carried, restored, settle

LEAST_WORDS = 50
KEEP_FROM = 0.5
ROUNDS = 25

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Frequent short words of the languages that the corpus is expected to hold.
COMMON_WORDS = ["the", "of", "and", "to", "in", "der", "die", "und", "den", "von", "le", "la", "de", "et", "les", "el", "que", "los", "en", "y"]


def _repeated_words(words: Column, n: Column) -> Column:
    """Words in windows of three that occur twice or more."""
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(sorted_windows: Column) -> Column:
        again = F.filter(
            sorted_windows,
            lambda w, k: (w["h"] == F.get(sorted_windows, k - 1)["h"]) | (w["h"] == F.get(sorted_windows, k + 1)["h"]),
        )
        # get() before the first or after the last is null, and null | true is true.
        starts = F.sort_array(F.transform(again, lambda w: w["i"]))
        # Each window adds the words that the one before it does not cover.
        zero = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            starts, zero, lambda x, i: F.struct(i.alias("at"), (x["n"] + F.least(i - x["at"], F.lit(3))).alias("n")), lambda x: x["n"]
        )

    return window, covered


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts and what the rules look at besides."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.trim(text, F.lit(_SPACE))
    df = docs.withColumn("_words", F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, _SPACES, -1)))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(_SPACE))) > 0))
    n = F.size("_words")
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    window, covered = _repeated_words(F.col("_hashes"), n)
    df = df.withColumn("_windows", F.when(n >= 3, window))
    # Places are needed only where a window comes again.
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(again, F.sort_array(placed)))
    chars = F.length(F.array_join("_words", ""))
    signs = F.regexp_count(text, F.lit("[!-@\\[-`{-~]"))
    return df.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered(F.col("_sorted")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (chars - signs).cast("long").alias("_letters"),
        F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("_upper"),
        F.regexp_count(text, F.lit("[!?|{}\\[\\]=]")).cast("long").alias("_marks"),
        F.size(F.array_distinct("_words")).cast("long").alias("_distinct"),
        F.size(F.array_intersect("_words", F.lit(COMMON_WORDS))).cast("long").alias("_common"),
    )


def votes() -> dict[str, Column]:
    """The rules: each 1, -1 or 0 out of the counts."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def vote(good: Column, bad: Column) -> Column:
        return F.when(good, 1).when(bad, -1).otherwise(0)

    per_word = F.when(n > 0, chars / n)
    return {
        "symbols": vote(F.col("n_symbols") <= 0.05 * n, F.col("n_symbols") > 0.3 * n),
        "repeats": vote(F.col("n_repeat_words") <= 0.2 * n, F.col("n_repeat_words") > 0.4 * n),
        "lines": vote(F.col("n_dup_lines") <= 0.1 * F.col("_n_lines"), F.col("n_dup_lines") > 0.3 * F.col("_n_lines")),
        "length": vote((per_word >= 3) & (per_word <= 10), (per_word < 2.5) | (per_word > 14)),
        "capitals": vote(F.col("_upper") <= 0.2 * F.col("_letters"), F.col("_upper") > 0.4 * F.col("_letters")),
        "marks": vote(F.col("_marks") <= 0.05 * n, F.col("_marks") > 0.3 * n),
        "letters": vote(F.col("_letters") >= 0.8 * chars, F.col("_letters") < 0.72 * chars),
        "variety": vote(F.col("_distinct") >= 0.4 * n, (F.col("_distinct") < 0.15 * n) & (n >= 20)),
        "common": vote(F.col("_common") >= 2, (F.col("_common") == 0) & (n >= 30)),
    }


Accuracy = dict[str, tuple[float, float]]


def _log_odds(names: list[str], prior: float, accuracy: Accuracy) -> Column:
    total = F.lit(math.log(prior / (1 - prior)))
    for name in names:
        good, bad = accuracy[name]
        weight = F.when(F.col(f"_vote_{name}") == 1, math.log(good / (1 - bad)))
        weight = weight.when(F.col(f"_vote_{name}") == -1, math.log((1 - good) / bad))
        total = total + weight.otherwise(0.0)
    return total


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[float, Accuracy]:
    """Prior and accuracies by EM over the counted vote patterns.

    A rule has two accuracies: how often its votes on good documents say good,
    and its votes on bad ones bad. Both are kept so that a vote never speaks
    against what it says, and the classes cannot swap.
    """
    prior, accuracy = 0.8, {name: (0.95, 0.4) for name in names}
    for _ in range(rounds):
        p = _probability(_log_odds(names, prior, accuracy))
        sums = [F.sum("_n").alias("all"), F.sum(F.col("_n") * p).alias("good")]
        for name in names:
            for kind, vote in (("up", 1), ("down", -1)):
                cast = F.when(F.col(f"_vote_{name}") == vote, F.col("_n")).otherwise(0)
                sums += [F.sum(cast * p).alias(f"{kind}_good_{name}"), F.sum(cast * (1 - p)).alias(f"{kind}_bad_{name}")]
        row = patterns.agg(*sums).first()
        if not row["all"]:
            break
        before = [prior, *(x for pair in accuracy.values() for x in pair)]
        prior = min(0.98, max(0.5, row["good"] / row["all"]))
        for name in names:
            good = (row[f"up_good_{name}"] + 1) / (row[f"up_good_{name}"] + row[f"down_good_{name}"] + 1.05)
            bad = (row[f"down_bad_{name}"] + 1) / (row[f"down_bad_{name}"] + row[f"up_bad_{name}"] + 2.5)
            good = min(0.999, max(0.7, good))
            accuracy[name] = (good, min(0.99, max(1.01 - good, bad)))
        if max(abs(a - b) for a, b in zip(before, [prior, *(x for pair in accuracy.values() for x in pair)])) < 1e-4:
            break
    return prior, accuracy


def with_quality(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id (or all of ``docs`` with ``carry``), the base counts, base_failed, kept and p_good."""
    columns = docs.columns
    frame = carried(docs)
    counts = counted(frame)
    rules = votes()
    names = list(rules)
    voted = counts.withColumns({f"_vote_{k}": v.cast("int") for k, v in rules.items()})
    base = ["doc_id", "text", "_rest"] if carry else ["doc_id"]
    voted = settle(voted.select(*base, *COUNTS, *[f"_vote_{k}" for k in names]), "votes")
    patterns = voted.groupBy(*[f"_vote_{k}" for k in names]).agg(F.count("*").alias("_n"))
    prior, accuracy = fit(settle(patterns.coalesce(1), "patterns"), names)
    p_good = _probability(_log_odds(names, prior, accuracy))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = voted.withColumns({"base_failed": failed, "p_good": p_good})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))
    added = [*COUNTS, "base_failed", "kept", "p_good"]
    return restored(judged, columns, added) if carry else judged.select("doc_id", *added)


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` less the documents that the rules reject."""
    columns = docs.columns
    frame = carried(docs)
    return restored(with_quality(frame, carry=True).where("kept").select("doc_id", "text", "_rest"), columns)
