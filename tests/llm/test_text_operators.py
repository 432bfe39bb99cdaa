"""The operators of odsflow.llm against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from odsflow.llm import (
    decontaminate,
    language,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    queries,
    repeats,
    scoring,
    sharding,
)
from odsflow.llm.links import components
from odsflow.llm.tokens import token_ids

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    base = sentence(1)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", None, None),
        (2, base, "en", None, None),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, "   \n\t", "de", "a", 4),
        (6, "one two three", "de", "a", 4),
        (None, base, "en", "a", 1),
        (7, "word " * 3000 + sentence(2, 3000), "de", "b", 1),
        (8, base.rsplit(" ", 1)[0] + " changed", "en", "a", 1),
        (9, sentence(3) + "\nà côté – naïve ÇA ×÷ don't <|endoftext|> 中文 12345\n" + sentence(4), "fr", "a", 1),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def clashing(df):
    names = ["_gone", "_held", "_id", "_own", "held", "bucket", "sketch", "n_lines", "n_dropped", "kept", "key", "h1", "node", "_rest", "_words", "label", "bands", "starts", "_key", "piece"]
    return df.withColumns({n: F.lit("own") for n in names})


# Tokens and packing ----------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abC É×÷ßΣ9'\n\t\x1c\xa0<|>.中́s", max_size=30)), min_size=1, max_size=5))
def test_token_ids_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.vocabulary())
    ids, bounds = token_ids(pa.array(texts, pa.string()), queries.vocabulary())
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == own.encode(text or "", add_special_tokens=False).ids


def test_packing_round_trip(odd):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.vocabulary())
    wanted = Counter()
    for doc_id, text, *_ in odd_rows():
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            wanted[(doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    rows = packing.pack_documents(clashing(odd), queries.vocabulary()).collect()
    assert Counter(tuple(r)[:5] for r in rows) == wanted
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 4096
    assert len(by) == -(-sum(r["length"] for r in rows) // 4096)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_best_fit_places_every_piece(counts):
    places = packing.best_fit(counts, 50)
    ranks, filled = [], Counter()
    for rank, n, length, sequence, offset, each in places:
        ranks += range(rank, rank + n)
        for i in range(n):
            filled[sequence + i // each] += length
    assert sorted(ranks) == list(range(sum(counts.values())))
    assert all(v <= 50 for v in filled.values())
    # Best fit needs at most 1.7 times the fewest; no two pieces above half a sequence share one.
    fewest = max(sum(k * v for k, v in counts.items()) / 50, sum(v for k, v in counts.items() if k > 25))
    assert len(filled) <= 1.7 * fewest + 1


# Shards ------------------------------------------------------------------------


# Few large documents to a task and three tasks to a level leave less to even out with.
@pytest.mark.parametrize("per_task,fan,spread", [(400, sharding.FAN, 0.02), (50, 3, 0.1)])
def test_shards_are_even_and_keep_equal_texts_together(spark, per_task, fan, spread):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard_by_bytes(documents, groups_per_task=per_task, fan=fan).collect()
    size, shards, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        shards[(r["size"], r["text_crc32"])].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == documents.count()
    assert max(size.values()) - min(size.values()) < spread * max(size.values())
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("doc_id", [7, None])
@pytest.mark.parametrize("copies", [9, 400])
def test_a_huge_group_of_one_id_is_divided(spark, doc_id, copies):
    rows = [(doc_id, "equal text " * 20)] * copies + [(8, "another")]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = Counter({k: 0 for k in range(8)})
    for r in found:
        size[r["shard"]] += r["size"]
    assert len(found) == copies + 1
    # No shard is more than two rows, or a part of the group, ahead of another.
    assert max(size.values()) - min(size.values()) <= max(2, copies // 8 / 3) * 221
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_defined_cases(odd, empty):
    rows = sharding.shard_by_bytes(clashing(odd)).collect()
    assert len(rows) == len(odd_rows())
    assert {r["size"] for r in rows if r["doc_id"] == 3} == {1}
    assert sharding.shard_by_bytes(empty).count() == 0


def test_differencing_beats_the_worst_order():
    loads = [(n, 0, 0) for n in (9, 8, 7, 6, 5, 4, 3, 2, 1)]
    sums = [0] * 3
    for (n, _, _), order in zip(loads, sharding.difference(loads, 3)):
        sums[order[0]] += n
    assert max(sums) - min(sums) <= 1


# Quality --------------------------------------------------------------------------


def base_counts(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def test_quality_counts(documents, odd):
    for df in (documents, clashing(odd)):
        texts = defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r["doc_id"]].append(base_counts(r["text"]))
        for r in quality.with_quality(df).collect():
            counts = tuple(r[c] for c in quality.COUNTS)
            assert counts in texts[r["doc_id"]]
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_separates_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.with_quality(docs).join(labels, "doc_id").where("not base_failed")
    good = judged.where("quality = 1")
    assert good.where("kept").count() >= 0.98 * good.count()


def test_quality_stage_keeps_columns(odd, empty):
    assert quality.keep_good(clashing(odd)).columns == clashing(odd).columns
    assert quality.with_quality(empty).count() == 0


# Near duplicates -------------------------------------------------------------------


def shingle_bag(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def classes_by_force(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = {i: shingle_bag(t) for i, t in rows}
    texts = dict(rows)
    for i in parent:
        for j in parent:
            if i < j:
                either = sum((bags[i] | bags[j]).values())
                alike = either and 5 * sum((bags[i] & bags[j]).values()) >= 4 * either
                if alike or (texts[i] is not None and texts[i] == texts[j]):
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def test_near_classes(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(documents).collect()}
    assert found == classes_by_force(rows)


def crowded_rows(n=600, twins=6, seed=1):
    """Texts of 196 words less 28 each, so that all of them share buckets; only the ``twins``, each missing eleven words
    that an earlier one misses, are near (151 of 185 words), all others at most 149 of 187."""
    rng = np.random.default_rng(seed)
    missing = np.zeros((0, 196), np.int64)
    while len(missing) < n + twins:
        one = np.zeros((1, 196), np.int64)
        twin = len(missing) - n
        if twin < 0:
            one[0, rng.choice(196, 28, replace=False)] = 1
        else:
            of = n // 2 + 40 * twin
            one[0, rng.choice(np.flatnonzero(missing[of]), 11, replace=False)] = 1
            one[0, rng.choice(np.flatnonzero(missing[of] == 0), 17, replace=False)] = 1
        shared = missing @ one[0]
        if twin >= 0:
            shared[of] = 0
        if not len(shared) or shared.max() < 10:
            missing = np.concatenate([missing, one])
    # Four x between any two words: a shingle holds one word, so it is there or not with its word.
    texts = ["x x x x " + " x x x x ".join(f"w{k}" for k in np.flatnonzero(row == 0)) + " x x x x" for row in missing]
    classes = {i: i for i in range(n)} | {n + t: n // 2 + 40 * t for t in range(twins)}
    return list(enumerate(texts)), classes


def test_near_classes_of_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 64, raising=False)
    rows, wanted = crowded_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert {i: c for i, c in found.items() if c != wanted[i]} == {}


def test_near_classes_defined_cases(odd, empty):
    found = defaultdict(set)
    for r in near_dedup.near_classes(clashing(odd)).collect():
        found[r["doc_id"]].add(r["class_id"])
    assert found[1] == found[2] == found[8] == {1}
    assert found[None] == {None}
    assert all(found[i] == {i} for i in (3, 4, 5, 6, 7, 9))
    assert near_dedup.near_classes(empty).count() == 0
    kept = near_dedup.keep_one(odd).groupBy("doc_id").count().collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 7, 9]


def test_keeping_one_loses_no_unlike_text(spark):
    a, b, c = sentence(21, 80), sentence(22, 80), sentence(23, 80)
    near_b = b.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (2, near_b, "y"), (3, c, "z"), (3, None, "z"), (3, a, "z"), (None, a, "n"), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    texts = Counter(t for i, t, _ in left if i is not None)
    assert texts[a] == 1 and texts[c] == 1 and texts[None] == 2
    assert texts[b] + texts[near_b] == 1
    assert (None, a, "n") in left and len(left) == 6
    assert set(left) <= set(rows)


def test_signatures_estimate_the_weighted_similarity():
    a, b = "x y z u v " * 30 + sentence(5, 200), "x y z u v " * 10 + sentence(5, 200)
    x, y = shingle_bag(a), shingle_bag(b)
    wanted = sum((x & y).values()) / sum((x | y).values())
    signature = near_dedup.signatures(*near_dedup.doc_shingles(pa.array([a, b])), size=4000)
    assert abs((signature[0] == signature[1]).mean() - wanted) < 0.03


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["label"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# Passages --------------------------------------------------------------------------


def left_by_force(rows, size=13):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, own in words.items():
        gone = set()
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone))
    return out


def test_passages(spark):
    rng = random.Random(7)
    passages = [sentence(100 + i, rng.choice([12, 13, 14, 20, 60])) for i in range(12)] + ["a " * 30, "a b " * 20]
    rows = [
        (i, " ".join(rng.choice([sentence(i * 10 + k, rng.randint(0, 9)), rng.choice(passages)]) for k in range(rng.randint(0, 9))))
        for i in range(120)
    ]
    found = repeats.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {r["doc_id"]: tuple(r)[1:] for r in found.collect()} == left_by_force(rows)


def test_passages_defined_cases(odd, empty):
    rows = repeats.dedup_passages(clashing(odd)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(odd_rows())
    assert by[2]["n_removed"] == 60 and by[1]["n_removed"] == 0
    assert by[None]["n_removed"] == 0 and by[3]["n_words"] == 0
    assert repeats.dedup_passages(empty).count() == 0


# Lines -----------------------------------------------------------------------------


def test_lines_defined_cases(spark, empty):
    rows = [
        (1, "A shared line\nown one here\n A SHARED line ", "x"),
        (2, "a shared LINE\t\nshort\nshort", "x"),
        (3, None, "x"),
        (None, "a shared line", None),
    ]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert (found[1]["n_lines"], found[1]["n_dropped"]) == (3, 0)
    assert (found[2]["text"], found[2]["n_dropped"]) == ("short\nshort", 1)
    assert (found[3]["text"], found[3]["n_lines"]) == ("", 1)
    assert found[None]["n_dropped"] == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fan_out=2)
    for i in range(4):
        runs.add(spark.createDataFrame([(i, 5, 5), (i, i + 10, 1)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert sorted(map(tuple, runs.first_seen().collect())) == [(5, 5, 0), *((i + 10, 1, i) for i in range(4))]


# Benchmark items, licences, languages, scores -------------------------------------------


def test_items_inside_long_documents(spark, empty):
    item = sentence(50, 40)
    almost = item.split()
    almost[20] = "other"
    rows = [
        (1, sentence(51, 4000) + "\n" + item.upper() + ", " + sentence(52, 4000)),
        (2, sentence(53, 300) + " " + " ".join(almost)),
        (3, sentence(54, 300) + " " + " ".join(item.split()[:20])),
        (4, None),
        (None, item),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, "too short"), (7, None), (None, item)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_shared"] for r in decontaminate.found_items(docs, items).collect()}
    assert found == {(1, 9): 36, (2, 9): 31}
    left = decontaminate.drop_contaminated(docs, items).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["3", "4", "None"]
    assert decontaminate.found_items(empty, items).count() == 0
    assert decontaminate.found_items(docs, items.where("false")).count() == 0


def test_licences(spark, odd, empty):
    text = licenses.TEMPLATES["MIT text"]
    rows = [(1, sentence(60, 500) + " " + text + " " + sentence(61, 500)), (2, "Released under the MIT License."), (3, sentence(62)), (4, None)]
    found = licenses.find_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["licence"]) for r in found} == {(1, "MIT text"), (2, "MIT notice")}
    assert [r["first_word"] for r in found if r["doc_id"] == 1] == [500]
    assert licenses.find_licences(clashing(odd)).count() == 0 and licenses.find_licences(empty).count() == 0
    with pytest.raises(ValueError):
        licenses.Templates({"x": "too short"}, 0.8)


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs.select("doc_id", "text", "lang")).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(~language.learning(F.col("doc_id")))
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_languages_defined_cases(spark, odd, empty):
    rows = language.identify(clashing(odd)).collect()
    assert len(rows) == len(odd_rows())
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert language.identify(empty).count() == 0
    unknown = language.identify(odd.where("doc_id is null")).collect()
    assert [r["lang_pred"] for r in unknown] == ["und"]


def test_scores_prefer_the_corpus_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars between 500 and 4000").select("doc_id", "text")
    vocabulary = scoring.learn_vocabulary(docs)
    tokens = scoring.tokens_of(docs, vocabulary).cache()
    parameters = scoring.train(tokens, vocabulary, rounds=2, stride=2)
    own, row = scoring._places(pa.RecordBatch.from_pandas(tokens.limit(200).toPandas()))
    context = scoring._contexts(own, row, np.arange(len(own)))
    trained = scoring.log_probabilities(parameters, vocabulary, own, context).mean()
    untrained = scoring.log_probabilities(scoring.initial(), vocabulary, own, context).mean()
    shuffled = scoring.log_probabilities(parameters, vocabulary, own, np.random.default_rng(0).permutation(context)).mean()
    assert trained > untrained and trained > shuffled
    # Every place's probabilities over all tokens sum to one.
    all_tokens = np.arange(scoring.TOKENS)
    total = np.exp(scoring.log_probabilities(parameters, vocabulary, all_tokens, np.repeat(context[:1], scoring.TOKENS, axis=0))).sum()
    assert abs(total - 1) < 1e-3


def test_scores_learn_from_every_place(spark):
    assert {number % scoring.STRIDE for number in range(scoring.ROUNDS)} == set(range(scoring.STRIDE))
    for ids in ((2, 3, 4), (5, 6, 7)):  # the only place of a document is its first
        docs = spark.createDataFrame([(i, "alpha") for i in ids], "doc_id long, text string")
        vocabulary = scoring.learn_vocabulary(docs)
        learnt = scoring.train(scoring.tokens_of(docs, vocabulary), vocabulary)
        assert learnt["out_bias"].argmax() == vocabulary.classes[0] and learnt["out_bias"].max() > 0


def test_scores_give_rare_words_their_own_share(spark):
    frequent = " ".join(f"f{i}" for i in range(scoring.FREQUENT))
    rare = [f"r{i}" for i in range(2000)]
    names, _ = scoring._names(pa.array(rare))
    mates = defaultdict(list)
    for word, name in zip(rare, names.tolist()):
        mates[name % scoring.BUCKETS].append(word)
    twice, once = next(words for words in mates.values() if len(words) >= 2)[:2]
    docs = spark.createDataFrame([(0, " ".join([frequent] * 3)), (1, twice), (2, twice), (3, once)], "doc_id long, text string")
    by = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    # Alone in a document, words of one bucket differ by their shares of it only.
    assert by[1] == by[2] and abs(by[1] - by[3] - np.log(2)) < 1e-4


def test_a_training_step_equals_plain_adam():
    rng = np.random.default_rng(3)
    start = {k: v.astype(float) for k, v in scoring.initial(1).items()}
    plain = {k: v.copy() for k, v in start.items()}
    m, v = ({k: np.zeros_like(x) for k, x in start.items()} for _ in range(2))
    trainer = scoring.Trainer(start)
    for step in range(1, 4):
        context = rng.integers(0, 40, (64, 2 * scoring.SIDE)).astype(np.uint16)
        context[rng.random(context.shape) < 0.2] = scoring.PAD
        classes = rng.integers(0, scoring.CLASSES, 64)
        trainer.step(context, classes)
        grads = {k: np.zeros_like(x) for k, x in plain.items()}
        for window, wanted in zip(context.astype(int), classes):
            x = np.concatenate([plain["embed"][t] for t in window])
            h = np.tanh(x @ plain["hidden"] + plain["hidden_bias"])
            logits = h @ plain["out"] + plain["out_bias"]
            d = np.exp(logits - logits.max())
            d /= d.sum()
            d[wanted] -= 1
            d /= len(classes)
            back = (plain["out"] @ d) * (1 - h * h)
            grads["out"] += np.outer(h, d)
            grads["out_bias"] += d
            grads["hidden"] += np.outer(x, back)
            grads["hidden_bias"] += back
            for t, g in zip(window, (plain["hidden"] @ back).reshape(len(window), -1)):
                grads["embed"][t] += g
        for k, g in grads.items():
            rows = np.unique(context) if k == "embed" else slice(None)
            m[k][rows] = 0.9 * m[k][rows] + 0.1 * g[rows]
            v[k][rows] = 0.999 * v[k][rows] + 0.001 * g[rows] ** 2
            plain[k][rows] -= scoring.RATE * (m[k][rows] / (1 - 0.9**step)) / (np.sqrt(v[k][rows] / (1 - 0.999**step)) + 1e-8)
    for k in plain:
        assert np.allclose(trainer.p[k], plain[k], atol=1e-6)


@pytest.mark.parametrize("known", [0, 3, 10**6])
def test_scores_equal_a_plain_sum(spark, monkeypatch, known):
    monkeypatch.setattr(scoring, "KNOWN_WORDS", known)
    frequent = " ".join([f"f{i}" for i in range(scoring.FREQUENT)] * 6)
    texts = [frequent, "f1 r1 f2 r2 r2", "r1 r3 r4 f7", None, "r5 " * 5 + "r4 r1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = Counter(w for t in texts for w in (t or "").split())
    vocabulary = scoring.learn_vocabulary(docs)
    p = scoring.train(scoring.tokens_of(docs, vocabulary), vocabulary)
    scores = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    for doc_id, text in list(enumerate(texts))[1:]:
        found = (text or "").split()
        ids = vocabulary.look_up(scoring._names(pa.array([text], pa.string()))[0]).tolist()
        total = 0.0
        for i, (word, own) in enumerate(zip(found, ids)):
            window = [ids[j] if 0 <= j < len(ids) else scoring.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            h = np.tanh(np.concatenate([p["embed"][t] for t in window]) @ p["hidden"] + p["hidden_bias"])
            logits = h @ p["out"] + p["out_bias"]
            logits[vocabulary.unused] = -np.inf
            total += logits[vocabulary.classes[own]] - np.log(np.exp(logits).sum()) + vocabulary.log_share[own]
            if own >= scoring.FREQUENT:
                total += np.log(counts[word]) - vocabulary.log_bucket[own]
        assert abs(scores[doc_id] - total) < 1e-3 * max(1, abs(total))


def test_scores_defined_cases(odd, empty):
    rows = scoring.score(clashing(odd)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(odd_rows())
    assert by[1]["score"] == by[2]["score"] < 0
    assert (by[3]["n_tokens"], by[3]["score"], by[3]["mean_score"]) == (0, 0.0, None)
    assert scoring.score(empty).count() == 0


# Pipeline ------------------------------------------------------------------------------


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        assert 0 < left.count() <= docs.count()
        docs = left
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == docs.count()
    digest = hashlib.sha256("".join(sorted(r["text"] for r in docs.select("text").collect())).encode()).hexdigest()
    assert len(digest) == 64


def near_by_force(rows):
    """The least doc_id of each class, all pairs compared."""
    bags = {i: shingle_bag(t or "") for i, t in rows}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both, either = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if both and 5 * both >= 4 * either:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def lines_by_force(rows):
    space = " \t\n\x0b\x0c\r"
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    keys = {i: [line.strip(space).translate(lower) for line in (t or "").split("\n")] for i, t in rows}
    first = {}
    for i in sorted(keys):
        for key in keys[i]:
            first.setdefault(key, i)
    return {
        i: "\n".join(line for line, key in zip((t or "").split("\n"), keys[i]) if len(key) < 10 or first[key] == i)
        for i, t in rows
    }


def held_by_force(rows, items):
    def shingled(text):
        found = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
        return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}

    wanted = [s for s in map(shingled, items) if s]
    return {i for i, t in rows for s in [shingled(t)] if any(5 * len(s & w) >= 4 * len(w) for w in wanted)}


def test_pipeline_stages_equal_plain_versions(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = corpus_pipeline.settle(stages["quality"](spark, documents, SF), "test-stage")
    judged = {r["doc_id"] for r in docs.select("doc_id").collect()}
    base = {r["doc_id"] for r in quality.with_quality(documents).where("not base_failed").collect()}
    assert not {i for i in base - judged if labels.get(i) == 1}
    assert not {i for i in judged & base if labels.get(i) == 0}

    def pairs(df):
        return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

    before = pairs(docs)
    docs = corpus_pipeline.settle(stages["lines"](spark, docs, SF), "test-stage")
    assert dict(pairs(docs)) == lines_by_force(before)
    before = pairs(docs)
    docs = corpus_pipeline.settle(stages["near_duplicates"](spark, docs, SF), "test-stage")
    equal = {}
    for i, t in sorted(before):
        equal.setdefault(t, i)
    classes = near_by_force([(i, t) for t, i in equal.items()])
    assert {i for i, _ in pairs(docs)} == {c for c in classes.values()}
    before = pairs(docs)
    docs = corpus_pipeline.settle(stages["decontamination"](spark, docs, SF), "test-stage")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {i for i, _ in pairs(docs)} == {i for i, _ in before} - held_by_force(before, items)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.vocabulary())
    packed = Counter()
    for r in stages["packing"](spark, docs, SF).collect():
        packed[r["doc_id"]] += r["length"]
    assert packed == {i: len(own.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs(docs)}


def test_pipeline_stages_on_odd_rows(spark, odd, empty):
    for df in (odd, empty, clashing(odd)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, df, SF)
            assert found.count() >= 0
            assert name == "packing" or found.columns == df.columns
