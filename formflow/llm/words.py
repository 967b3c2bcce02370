"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Used inside tasks by the operators that work on word windows. A batch of texts is
one byte buffer; a word is a maximal run of bytes of a given class, its hash a
polynomial over random byte values, taken from prefix sums, so that no loop runs
over words in Python. Every multiplication is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))

#: Longest buffer that is hashed in one piece; a longer single text still is.
BATCH_BYTES = 1 << 20
#: Longest buffer whose tables of powers a worker keeps.
KEPT_BYTES = BATCH_BYTES + (1 << 16)


def word_class(text_pattern: str) -> np.ndarray:
    """The bytes of a class given as a pattern for one byte (bytes above 127 included or not)."""
    import re

    found = re.compile(text_pattern.encode("latin-1"), re.S)
    return np.array([bool(found.fullmatch(bytes([b]))) for b in range(256)])


#: Letters and digits of ASCII and everything outside ASCII.
ALNUM = word_class("[0-9A-Za-z\\x80-\\xff]")
#: Everything but ASCII white space.
SOLID = word_class("[^\\x20\\x09-\\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose bits all depend on all bits of ``x`` (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a batch: hash, byte range in ``buffer``, and the bounds of each text's words."""

    buffer: bytes
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, KEPT_BYTES)
        tables = []
        for step in (_STEP, _STEP_INVERSE):
            t = np.full(size, step, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        if n > KEPT_BYTES:
            return tables[0], tables[1]
        _powers = tuple(tables)
    return _powers


def split_words(texts: list[bytes], is_word: np.ndarray) -> Words:
    """Words of ``texts`` (UTF-8), with A-Z in lower case. ``\\n`` must be outside the class."""
    buffer = b"\n" + b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    inside = is_word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    powers, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=sums[1:], dtype=np.uint64)
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    first = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])
    return Words(buffer, hashes, starts, ends, np.searchsorted(starts, first))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the bounds per text.

    A text with fewer words, but not none, has one window of all its words.
    """
    counts = words.counts()
    h, n = words.hashes, len(words.hashes)
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words.bounds[:-1], per_text)
    left = np.repeat(words.bounds[1:], per_text) - at
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = left > k
        part = h[np.minimum(at + k, n - 1)] if n else h
        out = np.where(there, mix(out * np.uint64(3) + part + np.uint64(k + 1)), out)
    return out, bounds


def in_batches(rows: Iterable[tuple], text_at: int, limit: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Rows in lists whose texts have about ``limit`` bytes together; a longer text is alone."""
    held, size = [], 0
    for row in rows:
        n = len(row[text_at])
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield held
