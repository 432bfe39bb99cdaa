"""Spelling variants against a plain version, and their defined cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from odsflow.llm import queries, spelling
from odsflow.llm.store import settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, source string"


def plain_counts(rows, shortest=7, one_in=31):
    counts = Counter()
    for doc_id, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= shortest:
                counts[word] += 1
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, fewest=2, ratio=10):
    n = {w: c for w, c in counts.items() if c >= fewest}
    by = defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by[len(w) + k] if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(frame):
    return {tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def texts(seed, n=400):
    """Words over few letters, many of them one edit apart, some of them frequent."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(7, 11))) for _ in range(25)]
    words = []
    for _ in range(n):
        w = rng.choice(base)
        for _ in range(rng.choice((0, 0, 0, 1, 2))):
            k, c = rng.randrange(len(w)), rng.choice("abcdéÉ")
            w = rng.choice((w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]))
        words.append(w.upper() if rng.random() < 0.1 else w)
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    chain = "spelling " * 600 + "speling " * 30 + "spelinz " * 2 + "bcdefgh abcdefg " * 3
    return [
        (1, texts(1), "a"),
        (1, texts(1), None),
        (2, texts(2).replace(" ", "-1×"), "a"),
        (3, None, None),
        (4, "", "a"),
        (None, texts(3), "a"),
        (5, "x" * 30_000 + " " + "x" * 30_000 + " " + "x" * 30_001 + " " + "x" * 30_001, "a"),
        (6, chain, "a"),
        (7, "ÀÁÂÃÄÅÆ " * 3 + "àáâãäåæ " * 3 + "ÿÿÿÿÿÿÿ÷×Ø " * 2 + texts(4, 3000), "b"),
    ]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("word", "n", "near", "form", "leaf", "length")})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=9), st.integers(0, 2**32 - 1)), min_size=1, max_size=6))
def test_checksums_equal_zlib(spans):
    data = np.frombuffer(b"".join(s for s, _ in spans) or b"\0", np.uint8)
    ends = np.cumsum([len(s) for s, _ in spans])
    starts = ends - [len(s) for s, _ in spans]
    sums = spelling.run_crcs(data, starts, ends, np.array([c for _, c in spans], np.uint32))
    assert sums.tolist() == [zlib.crc32(s, c) for s, c in spans]


def test_words_equal_a_plain_count(frame, rows):
    counted = {r["word"]: r["n"] for r in spelling.count_words(frame).collect()}
    assert counted == plain_counts([r[:2] for r in rows])
    every = {r["word"]: r["n"] for r in spelling.count_words(frame, 2, 1).collect()}
    assert every == plain_counts([r[:2] for r in rows], 2, 1)


def test_variants_equal_a_plain_search(frame, rows):
    wanted = plain_variants(plain_counts([r[:2] for r in rows]))
    assert found(spelling.spelling_variants(frame)) == wanted
    assert any(form and root != form for _, form, root, *_ in wanted)


@pytest.mark.parametrize("cell,most,sample", [(20, 40, 60), (8, 3, 500), (50, 10_000, 10)])
def test_cells_and_slices_lose_no_pair(spark, cell, most, sample):
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(700)}
    words |= {"".join(rng.sample("abcdefg", 7)) for _ in range(200)}
    counted = settle(spark.createDataFrame([(w, 1, len(w)) for w in words], "word string, n long, length int"), "test-words")
    pairs = [(r["word"], r["near"]) for r in spelling.near_words(counted, cell, most, sample).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abéÿz", min_size=3, max_size=5), min_size=1, max_size=40, unique=True), st.integers(1, 3))
def test_tree_search_equals_all_pairs(words, leaf):
    for length in (4, 5):
        members = [w for w in words if len(w) == length]
        for size in (length, length - 1):
            asked = [w for w in words if len(w) == size]
            if members and asked:
                q, m = spelling.near_pairs(pa.array(members), length, pa.array(asked), size)
                pairs = {(asked[i], members[j]) for i, j in zip(q.tolist(), m.tolist())}
                assert pairs == {(a, b) for a in asked for b in members if one_edit(a, b)}
                bits = spelling.letter_bits(pa.array(members))
                tree = spelling.Tree(bits, leaf, False)
                home = tree.home(bits)
                assert all(j in tree.order[tree.first[h] : tree.first[h] + tree.size[h]] for j, h in enumerate(home.tolist()))


def test_no_documents_and_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    few = spark.createDataFrame([(1, "short words only", "a"), (2, None, "a")], SCHEMA)
    assert spelling.spelling_variants(few).collect() == []


def test_query_equals_a_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, sf).collect()]
    counts = plain_counts(rows)
    result = found(queries.op13_spelling_variants(spark, sf))
    kept = {w: n for w, n in counts.items() if n >= 2}
    assert {(r[0], r[3]) for r in result} == set(kept.items())
    # Near words by their common shortened forms, as all pairs are too many here.
    holes = defaultdict(set)
    for w in kept:
        holes[(w, len(w))].add(w)
        for k in range(len(w)):
            holes[(w[:k] + "*" + w[k + 1 :], len(w))].add(w)
            if w[:k] + w[k + 1 :] in kept:
                holes[(w[:k] + w[k + 1 :], len(w) - 1)].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    assert {(r[0], r[4]) for r in result} == {(w, len(near[w])) for w in kept}
