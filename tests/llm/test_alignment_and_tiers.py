"""Cross-tokenizer alignment and tier packing against plain versions, and their defined cases."""

import functools
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from odsflow.llm import align, queries, tiers
from odsflow.llm.store import settle
from odsflow.llm.text import text_bytes
from odsflow.llm.units import byte_units, byte_vocabulary, piece_units, tokenize, unit_starts

SCHEMA = "doc_id long, text string, source string"
A, B = queries.vocabulary(queries.BYTE_VOCABULARY), queries.vocabulary(queries.PIECE_VOCABULARY)
ODD = "abC É×ß9'\n\t\r\x0b\x1c\x85\xa0 　<|>.中́s▁\x00😀"


def sentence(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    base = sentence(1)
    return [
        (1, base, "a"),
        (2, base, None),
        (2, base, None),
        (3, None, "a"),
        (4, "", "a"),
        (5, "  \n\t \n", "a"),
        (None, "no id", "a"),
        (6, "a ▁ blank of the other vocabulary", "a"),
        (7, "plain <|endoftext|> and <s> </s> <0x0A> strings", "a"),
        (8, "word " * 3000 + sentence(2, 9000), "b"),
        (9, "x" * 5000, "b"),
        (10, sentence(3) + "\nà côté – naïve\r\nÇA ×÷ don't 中文\x00 12345\n\n\n" + sentence(4), "a"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(odd_rows(), SCHEMA)
    names = ["n_a", "n_best", "ids", "part", "rest", "tier", "links", "group", "n"]
    return rows.withColumns({n: F.lit("own") for n in names})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@functools.cache
def byte_tokenizer(special):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(A)
    own.encode_special_tokens = not special
    return own


@functools.cache
def piece_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=ODD, min_size=1, max_size=40), st.text(min_size=1, max_size=20), st.just("a<|endoftext|>\n b")), min_size=1, max_size=4))
def test_units_tokenize_as_whole_texts(texts):
    texts = [" " + t for t in texts]
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    starts = unit_starts(data, bounds)
    first = np.searchsorted(starts, bounds)
    found = tokenize(data, starts, [byte_units(A), piece_units(B)])
    own, special, pieces = byte_tokenizer(False), byte_tokenizer(True), piece_model()
    for text in texts:
        assert byte_vocabulary(A).encode(text) == special.encode(text, add_special_tokens=False).ids
    for (ids, count, _), encode in zip(found, (lambda t: own.encode(t, add_special_tokens=False).ids, lambda t: pieces.encode(t[1:]))):
        places = np.concatenate([[0], np.cumsum(count)])[first]
        for i, text in enumerate(texts):
            if text != " " or encode is None:
                assert ids[places[i] : places[i + 1]].tolist() == (encode(text) or ids[places[i] : places[i + 1]].tolist())


# Alignment ---------------------------------------------------------------------


def plain_alignment(text, own, pieces):
    """(n_a, n_b, groups, links) by one pointer pair."""
    if not text:
        return 0, 0, [], []
    table_a, table_b = byte_units(A).vocabulary.bytes, piece_units(B).vocabulary.bytes
    ids_a, ids_b = own.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    whole = (" " + text).encode()
    if b"".join(table_a[i] for i in ids_a) != whole or b"".join(table_b[i] for i in ids_b) != whole:
        return 0, 0, [], []
    ends_a = np.cumsum([len(table_a[i]) for i in ids_a]).tolist()
    ends_b = np.cumsum([len(table_b[i]) for i in ids_b]).tolist()
    links = [
        (x, y)
        for i, x in enumerate(ids_a)
        for j, y in enumerate(ids_b)
        if max(ends_a[i - 1] if i else 0, ends_b[j - 1] if j else 0) < min(ends_a[i], ends_b[j])
    ] if len(ids_a) < 400 else None
    groups, low_a, low_b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        high_a, high_b = ends_a.index(end, low_a) + 1, ends_b.index(end, low_b) + 1
        groups.append(",".join(map(str, ids_a[low_a:high_a])) + "|" + ",".join(map(str, ids_b[low_b:high_b])))
        low_a, low_b = high_a, high_b
    if links is None:
        links, i, j = [], 0, 0
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
    return len(ids_a), len(ids_b), groups, links


def expected_links(texts):
    own, pieces = byte_tokenizer(False), piece_model()
    found = [plain_alignment(t, own, pieces) for t in texts]
    counts = Counter(link for *_, links in found for link in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links), ";".join(groups))
        for n_a, n_b, groups, links in found
    ]


@pytest.mark.parametrize("most", [align.BLOCK_LINKS, 40])
def test_alignment_equals_one_pointer_pair(odd, monkeypatch, most):
    monkeypatch.setattr(align, "LANE", 64)
    stored = settle(align.align(odd, A, B), "test-aligned")
    rows = align.rate_links(stored, *align.vocabulary_sizes(A, B), most=most).collect()
    found = Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in rows)
    wanted = expected_links([t for _, t, _ in odd_rows()])
    assert found == Counter((row[0], *w) for row, w in zip(odd_rows(), wanted))
    assert sum(w[0] == 0 for w in wanted) == 3  # null, empty, and the text with the other vocabulary's blank


def test_alignment_query_equals_one_pointer_pair(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.documents(spark, sf).collect()
    wanted = expected_links([r["text"] for r in docs])
    digest = [hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for w in wanted]
    rows = queries.op11_cross_tokenizer_links(spark, sf).collect()
    assert Counter(tuple(r) for r in rows) == Counter((d["doc_id"], *w[:-1], h) for d, w, h in zip(docs, wanted, digest))


def test_alignment_of_nothing(empty):
    stored = settle(align.align(empty, A, B), "test-none")
    assert align.rate_links(stored, *align.vocabulary_sizes(A, B)).collect() == []


# Tier packing ------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 60), max_size=12))
def test_plan_places_every_token_once_without_padding(counts):
    sizes = (4, 8, 16, 32)
    places, windows = tiers.plan(counts, sizes)
    made = tiers.Places(places, windows, 32)
    length = np.repeat(np.array(list(counts), np.int64), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()]) if counts else length
    row, start, size, tier, number, offset = made.find(length, rank)
    held = defaultdict(list)
    for r, s, n, t, k, o in zip(*(x.tolist() for x in (row, start, size, tier, number, offset))):
        held[(t, k)].append((o, n))
    for (t, _), own in held.items():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == t
    assert Counter(t for t, _ in held) == Counter({t: n for t, n in windows.items() if n})
    taken = defaultdict(list)
    for r, s, n in zip(row.tolist(), start.tolist(), size.tolist()):
        taken[r].append((s, n))
    for r, own in taken.items():
        own.sort()
        assert [s for s, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == length[r]
    assert len(taken) == len(length)


def test_plan_prefers_whole_documents():
    places, windows = tiers.plan({1500: 10, 548: 10, 600: 3, 424: 3}, tiers.TIERS)
    assert windows == {256: 0, 512: 0, 1024: 3, 2048: 10}
    assert len({(p[0], p[1]) for p in places.tolist()}) == 4


@pytest.mark.parametrize("plan_bytes", [tiers.PLAN_BROADCAST, 0])
def test_tier_packing_round_trip(odd, plan_bytes):
    own = byte_tokenizer(True)
    wanted = Counter()
    for doc_id, text, _ in odd_rows():
        wanted[(doc_id, np.array([*own.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes())] += 1
    assert sum(b"\x50\xc4\x00\x00" in ids for _, ids in wanted) == 1  # the special token's own id
    rows = tiers.pack_tiers(odd, A, plan_bytes=plan_bytes).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["tier"], r["step"]))
        assert len(r["ids"]) == 4 * r["length"]
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
        assert {sum(p[1] for p in parts)} == {p[2] for p in parts} and len({p[3] for p in parts}) == 1
    # The pieces of equal rows cannot be told apart; together they give each row's ids.
    stretches = defaultdict(Counter)
    for r in rows:
        stretches[(r["doc_id"], r["doc_tokens"])][(r["start"], r["length"], r["ids"])] += 1
    total = Counter()
    for (doc_id, ids), n in wanted.items():
        total[(doc_id, len(ids) // 4)] += n * len(ids)
        for start, length, own_ids in stretches[(doc_id, len(ids) // 4)]:
            assert ids[4 * start : 4 * (start + length)] == own_ids
    assert {k: sum(n * 4 * s[1] for s, n in v.items()) for k, v in stretches.items()} == dict(total)


def test_step_groups_are_even(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    rows = tiers.pack_tiers(docs, A, step_tokens=16 * 2048).select("tier", "step", "sequence_id").distinct().collect()
    steps = defaultdict(Counter)
    for r in rows:
        steps[r["tier"]][r["step"]] += 1
    for tier, sizes in steps.items():
        assert max(sizes.values()) - min(sizes.values()) <= 1
        assert max(sizes.values()) * tier <= 16 * 2048


def test_tier_packing_of_nothing(empty):
    assert tiers.pack_tiers(empty, A).collect() == []


def test_tier_query_sums(spark):
    rows = queries.op12_tier_packing(spark, "/root/testdata/sf0.001").collect()
    own = byte_tokenizer(True)
    for r in queries.documents(spark, "/root/testdata/sf0.001").collect()[:40]:
        ids = np.array([*own.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        mine = [p for p in rows if p["doc_id"] == r["doc_id"]]
        assert sum(p["length"] for p in mine) == len(ids) == mine[0]["doc_tokens"]
        for p in mine:
            assert zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
