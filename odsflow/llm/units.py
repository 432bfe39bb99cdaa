"""Tokens of whole texts by the byte-level and the piece vocabulary, unit by unit.

A unit is white space and what follows it up to the next white space. A text is
cut before a blank, tab or line break whose preceding character is surely not
white space; no token of either vocabulary crosses such a place: the byte-level
splitter begins a new part there, and no piece holds one of these characters
behind another character (checked when the vocabulary is read). So a unit's
tokens do not depend on its neighbours, and each distinct unit of a slice of rows
is tokenized once per worker.
"""

from __future__ import annotations

import functools
import json

import numpy as np

from odsflow.llm.text import ragged, span_hash

KNOWN_UNITS = 1_000_000

#: Fixed value: how the byte-level vocabulary splits a text before it merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters before which a text may be cut.
CUTS = b" \t\n"
_IS_CUT = np.zeros(256, bool)
_IS_CUT[list(CUTS)] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_TAIL = np.zeros(256, bool)
_TAIL[0x80:0xC0] = True


def _visible_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Is the character that ends before each place surely not white space?"""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    # Characters of two bytes under C2, and of three under E1 to E3, may be white space.
    pair = (two >= 0xC3) & (two < 0xE0)
    longer = _TAIL[two] & (_TAIL[three] | (three >= 0xE4) | (three == 0xE0))
    return _VISIBLE[one] | (_TAIL[one] & (pair | longer))


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the units of the texts begin; none spans two texts."""
    if not len(data):
        return np.zeros(0, np.int64)
    opens = np.zeros(len(data), bool)
    at = np.flatnonzero(_IS_CUT[data])
    opens[at] = _visible_before(data, at)
    opens[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(opens)


def _cut_safe(pieces: list[str]) -> None:
    for cut in " \t\n":
        mark = "▁" if cut == " " else cut
        for piece in pieces:
            if any(b == mark and a != mark for a, b in zip(piece, piece[1:])):
                raise ValueError(f"the vocabulary has {piece!r}, which crosses a cut")


class ByteLevel:
    """The byte-level vocabulary; ``special`` says whether strings of special tokens are such tokens.

    Its merges are numbered like its tokens, so their ranks are the ids.
    """

    def __init__(self, path: str, special: bool):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        specials = {t["content"]: t["id"] for t in made["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in made["model"]["vocab"].items() if t not in specials}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"])
        if [ranks[bytes(byte[c] for c in a + b)] for a, b in pairs] != list(range(256, len(ranks))):
            raise ValueError("the vocabulary does not number its tokens by their merges")
        self.specials = specials if special else {}
        self.model = tiktoken.Encoding("bytes", pat_str=PARTS, mergeable_ranks=ranks, special_tokens=self.specials)
        self.bytes = [b""] * (max([*ranks.values(), *specials.values()]) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, allowed_special="all") if self.specials else self.model.encode_ordinary(text)


class Pieces:
    """The piece vocabulary; a blank stands before the text already."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = [self.model.is_byte(i) for i in range(len(names))]
        self.blank = self.model.piece_to_id("▁")
        _cut_safe([n for n, b in zip(names, byte) if not b])
        self.bytes = [bytes([int(n[3:5], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, byte)]

    def encode(self, text: str) -> list[int]:
        if text[:1] != " ":
            return self.model.encode(text, num_threads=1)[1:]
        # The model puts a blank before a text, but none before an empty one.
        return self.model.encode(text[1:], num_threads=1) if len(text) > 1 else [self.blank]


class Units:
    """Token ids of units seen before, by hash; forgets all when full."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.lengths = np.array([len(b) for b in vocabulary.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def token_bytes(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.starts[ids], self.lengths[ids])]

    def _together(self, joined: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, tokens of each unit) of units that part where texts may be cut; None where that does not come out."""
        try:
            ids = np.array(self.vocabulary.encode(joined.decode("utf-8")), np.uint32)
        except UnicodeDecodeError:
            return None
        upto = np.cumsum(self.lengths[ids])
        if not np.array_equal(self.token_bytes(ids), np.frombuffer(joined, np.uint8)):
            return None
        behind = np.searchsorted(upto, ends) + 1
        return (ids, np.diff(behind, prepend=0)) if np.array_equal(upto[behind - 1], ends) else None

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(ids, tokens of each unit, whether their bytes are the unit's); each unit is tokenized by itself or among units
        that it may follow."""
        size = ends - starts
        safe = _IS_CUT[data[starts]] & _visible_before(data, ends) & (size > 2)
        count, whole = np.zeros(len(starts), np.int64), np.ones(len(starts), bool)
        own = np.flatnonzero(safe)
        together = self._together(data[ragged(starts[own], size[own])].tobytes(), np.cumsum(size[own])) if len(own) else None
        if together is None:
            own, together = own[:0], (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        count[own] = together[1]
        alone = np.setdiff1d(np.arange(len(starts)), own)
        found = []
        for i in alone.tolist():
            unit = data[starts[i] : ends[i]].tobytes()
            ids = np.array(self.vocabulary.encode(unit.decode("utf-8", "replace")), np.uint32)
            count[i], whole[i] = len(ids), self.token_bytes(ids).tobytes() == unit
            found.append(ids)
        ids = np.concatenate([together[0], *found]).astype(np.uint32)
        at = np.empty(len(starts), np.int64)
        order = np.concatenate([own, alone])
        at[order] = np.cumsum(count[order]) - count[order]
        return ids, at, count, whole

    def look_up(self, names: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of ``names`` (sorted, distinct), the hashes of these spans of ``data``."""
        at = np.searchsorted(self.names, names)
        known = np.zeros(len(names), bool)
        inside = at < len(self.names)
        known[inside] = self.names[at[inside]] == names[inside]
        new = np.flatnonzero(~known)
        if not len(new):
            return at
        if len(self.names) and len(self.names) + len(new) > KNOWN_UNITS:
            self._clear()
            return self.look_up(names, data, starts, ends)
        ids, start, count, whole = self._learn(data, starts[new], ends[new])
        places = at[new]
        self.start = np.insert(self.start, places, start + len(self.ids))
        self.ids = np.concatenate([self.ids, ids])
        self.count = np.insert(self.count, places, count)
        self.whole = np.insert(self.whole, places, whole)
        self.names = np.insert(self.names, places, names[new])
        return np.searchsorted(self.names, names)


@functools.cache
def byte_units(path: str) -> Units:
    return Units(ByteLevel(path, False))


@functools.cache
def byte_vocabulary(path: str) -> ByteLevel:
    return ByteLevel(path, True)


@functools.cache
def piece_units(path: str) -> Units:
    return Units(Pieces(path))


def tokenize(data: np.ndarray, starts: np.ndarray, caches: list[Units]):
    """For each cache (ids, tokens of each unit, whether its bytes are the unit's), over the units at ``starts``."""
    if not len(starts):
        return [(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in caches]
    ends = np.append(starts[1:], len(data))
    names = span_hash(data, starts, ends)
    distinct, example, inverse = np.unique(names, return_index=True, return_inverse=True)
    out = []
    for cache in caches:
        at = cache.look_up(distinct, data, starts[example], ends[example])[inverse]
        count = cache.count[at]
        out.append((cache.ids[ragged(cache.start[at], count)], count, cache.whole[at]))
    return out
