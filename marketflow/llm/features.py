"""Hashed text features: words, shapes of tokens and repetition, as one sparse vector per text."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from marketflow.llm.common import words
from marketflow.llm.lempel_ziv import Rolling
from marketflow.llm.spans import NOT_BLANK, word_spans

BITS = 16
WORDS_KEPT = 20_000
#: bits of the number of places that keep the features of words by their 64-bit hashes, 16 bytes each
PLACE_BITS = 18
LETTERS = re.compile(r"[^\W\d_]+")


#: words of a to z with signs of ASCII around them, whose core and shape need no search
PLAIN = re.compile(rb"([^a-z0-9\x80-\xff]*)([a-z]+)([^a-z0-9\x80-\xff]*)\Z")


class Hasher(dict):
    """Feature numbers of a word, kept for a bounded number of words (see `trim`)."""

    def __init__(self, bits: int = BITS):
        self.mask = (1 << bits) - 1
        self.shapes: dict[tuple[bytes, bytes], int] = {}
        self.keys = np.zeros(1 << PLACE_BITS, np.uint64)
        self.found = np.zeros((1 << PLACE_BITS, 2), np.int32)

    def of_hashed(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: bytes) -> np.ndarray:
        """The numbers of different words (spans of `raw`) with these hashes; a place keeps the word seen last."""
        place = (hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
        pairs = self.found[place].astype(np.int64)
        new = np.flatnonzero(self.keys[place] != hashes)
        if len(new):
            of = self.of
            pairs[new] = np.array([of(raw[a:b]) for a, b in zip(starts[new].tolist(), ends[new].tolist())], np.int64)
            # of words that share a place one is kept, whole
            place, last = np.unique(place[new][::-1], return_index=True)
            new = new[::-1][last]
            self.keys[place], self.found[place] = hashes[new], pairs[new]
        return pairs

    def of(self, word: bytes) -> tuple[int, int]:
        """The same numbers from a word's bytes."""
        if word.isalpha():
            return xxhash.xxh32_intdigest(b"w" + word) & self.mask, self._shape(b"", b"")
        plain = PLAIN.match(word)
        if plain:
            before, core, after = plain.groups()
            return xxhash.xxh32_intdigest(b"w" + core) & self.mask, self._shape(before, after)
        return self[word.decode("utf-8", "surrogatepass")]

    def _shape(self, before: bytes, after: bytes) -> int:
        number = self.shapes.get((before, after))
        if number is None:
            if len(self.shapes) > WORDS_KEPT:
                self.shapes.clear()
            number = self.shapes[before, after] = xxhash.xxh32_intdigest(b"s" + (before + b"a" + after)[:12]) & self.mask
        return number

    def __missing__(self, word: str) -> tuple[int, int]:
        number = lambda text: xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass")) & self.mask
        found = LETTERS.search(word)
        core = found.group() if found else ""
        shape = re.sub(r"\d+", "9", LETTERS.sub("a", word))[:12]
        value = self[word] = (number(f"w{core}"), number(f"s{shape}"))
        return value

    def trim(self) -> None:
        if len(self) > WORDS_KEPT:
            self.clear()


def hashed(text: str | None, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values) of a whole text: square roots of counts, scaled to length 1.

    Words and shapes count once per occurrence; immediate repetition of a word and the
    number of words (by powers of two) are features too. An empty text has the latter only.
    """
    found = words(text)
    pairs = np.array([hasher[w] for w in found], np.int64).reshape(-1, 2)
    again = sum(map(str.__eq__, found, found[1:]))
    extra = [(1 << 20) + min(len(found).bit_length(), 20) & hasher.mask] + [hasher.mask] * again
    numbers, counts = np.unique(np.concatenate([pairs.ravel(), np.array(extra, np.int64)]), return_counts=True)
    values = np.sqrt(counts)
    return numbers, values / np.sqrt((values**2).sum())


_CODES = np.random.default_rng(17).integers(0, 2**63, 256, dtype=np.uint64)


def hashed_rows(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """(row of each entry, feature numbers, values, words of each row) of many lower-cased texts at once.

    The same features as `hashed` gives each text; a word is looked up once for all its
    occurrences, which are told by 64-bit hashes.
    """
    starts, ends, rows = word_spans(data, offsets, NOT_BLANK)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    hashes = Rolling(_CODES[data]).spans(starts, ends) ^ (ends - starts).astype(np.uint64)
    different, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    pairs = hasher.of_hashed(different, starts[first], ends[first], data.tobytes())
    again = rows[1:][(kind[1:] == kind[:-1]) & (rows[1:] == rows[:-1])]
    size = (1 << 20) + np.minimum(np.frexp(n.astype(float))[1], 20) & hasher.mask
    at = np.concatenate([np.repeat(rows, 2), np.arange(len(n)), again])
    numbers = np.concatenate([pairs[kind].ravel(), size, np.full(len(again), hasher.mask)])
    cells, counts = np.unique(at * (hasher.mask + 1) + numbers, return_counts=True)
    at, numbers = cells // (hasher.mask + 1), cells & hasher.mask
    return at, numbers, np.sqrt(counts / np.bincount(at, counts, len(n))[at]), n
