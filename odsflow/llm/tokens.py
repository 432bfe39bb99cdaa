"""Token ids of whole texts by a public word-piece vocabulary.

The tokenizer lower-cases a text, splits it at white space and into runs of
letters, single digits and runs of other characters, and looks each unit up by
itself. So each distinct unit is tokenized once per worker: the units of a
slice of rows are found, hashed and made distinct in numpy, and only new ones
reach the tokenizer. Words with characters beyond ASCII and the Latin-1
letters, with apostrophes or with ``<`` (special tokens) are given to it whole.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa

from odsflow.llm.text import ragged, span_hash, text_bytes, words

KNOWN_UNITS = 2_000_000

_GAP, _LETTER, _DIGIT, _OTHER, _ODD, _LEAD, _TAIL = range(7)


@functools.cache
def _classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[0x20, 9, 10, 11, 12, 13]] = _GAP
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[ord("A") : ord("Z") + 1] = _LETTER
    kinds[ord("a") : ord("z") + 1] = _LETTER
    kinds[[ord("'"), ord("<")]] = _ODD
    kinds[0x80:0xC0] = _TAIL
    kinds[0xC0:] = _ODD
    kinds[0xC3] = _LEAD
    return kinds


@functools.cache
def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that does not stand for itself in the vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


class Units:
    """Token ids of units seen before, by hash; forgets all when full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _tokenize(self, unit: bytes, whole: bool) -> list[int]:
        if whole:
            return self.tokenizer.encode(unit.decode("utf-8"), add_special_tokens=False).ids
        return [t.id for t in self.tokenizer.model.tokenize(unit.decode("latin-1").translate(self.letters))]

    def look_up(self, names: np.ndarray, unit_of) -> np.ndarray:
        """Places of ``names`` (sorted, distinct); ``unit_of(i)`` gives the bytes of a new one."""
        at = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        new = np.flatnonzero(self.names[at] != names) if len(self.names) else np.arange(len(names))
        if len(new):
            if len(self.names) + len(new) > KNOWN_UNITS and len(self.names):
                self._clear()
                return self.look_up(names, unit_of)
            found = [self._tokenize(*unit_of(i)) for i in new]
            count = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for f in found for i in f), np.uint32, int(count.sum()))
            start = np.cumsum(count) - count + len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            places = np.searchsorted(self.names, names[new])
            self.start = np.insert(self.start, places, start)
            self.count = np.insert(self.count, places, count)
            self.names = np.insert(self.names, places, names[new])
            at = np.searchsorted(self.names, names)
        return at


@functools.cache
def _units(path: str) -> Units:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Units(path)


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ids (unsigned 32 bit) and the rows' bounds among them."""
    units = _units(path)
    data, bounds = text_bytes(texts)
    kinds = _classes()[data]
    previous = np.concatenate([[0], data[:-1]]) if len(data) else data
    # A Latin-1 letter is two bytes, C3 and one of 80..BF; the signs × and ÷ are not letters.
    led = np.concatenate([[False], kinds[:-1] == _LEAD]) if len(data) else np.zeros(0, bool)
    odd = (kinds == _ODD) | ((kinds == _TAIL) & (~led | (data == 0x97) | (data == 0xB7)))
    starts, ends, first = words(data, bounds, kinds == _GAP)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
    seen = np.concatenate([[0], np.cumsum(odd)])
    whole = seen[ends] > seen[starts]
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[whole]] = 1
    step[ends[whole]] -= 1
    in_whole = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    lowered = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    lowered += np.uint8(32) * ((previous == 0xC3) & (data >= 0x80) & (data <= 0x9E))
    lowered = np.where(in_whole, data, lowered)
    kinds = np.where((kinds == _LEAD) | (kinds == _TAIL), _LETTER, kinds)
    kinds = np.where(in_whole, _ODD, kinds)
    # A unit begins at a word's start, where the kind changes, and at each digit.
    opens = np.zeros(len(data), bool)
    opens[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    opens[starts] = True
    opens &= kinds != _GAP
    begin = np.flatnonzero(opens)
    word_end = ends[np.searchsorted(starts, begin, side="right") - 1]
    end = np.minimum(np.append(begin[1:], len(data)), word_end)
    names = span_hash(lowered, begin, end) ^ (in_whole[begin] * np.uint64(0xA5A5A5A5A5A5A5A5))
    distinct, example, inverse = np.unique(names, return_index=True, return_inverse=True)
    raw = lowered.tobytes()

    def unit_of(i: int) -> tuple[bytes, bool]:
        j = example[i]
        return raw[begin[j] : end[j]], bool(in_whole[begin[j]])

    at = units.look_up(distinct, unit_of)[inverse]
    count = units.count[at]
    ids = units.ids[ragged(units.start[at], count)]
    total = np.concatenate([[0], np.cumsum(count)])
    return ids, total[np.searchsorted(begin, bounds)]


def crc32(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), before)
