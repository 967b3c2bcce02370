"""Byte-level BPE encoding and decoding with a rank queue.

A text is cut by the tokenizer's pattern; each piece is merged on its own, always
the pair of the lowest rank first and the leftmost of equal ones. The queue of pairs
has a bucket per merge rank, which holds places in the linked list of parts, and a
bitmap over the ranks in two levels, so that find-first-set gives the next rank in two
steps whatever the length of the piece. A place whose pair has
changed since it was queued is skipped when it comes up. The work for a piece of n
bytes is n queue operations, also where a piece is the whole text. Pieces side by side
share one queue, as merges of different pieces do not meet: a bucket's places are taken
in one go until it is empty or a lower rank turns up.

Ids of short pieces are kept per worker in a table of bounded size, of which those
not met for long are given up. With the pattern SPACED the table also holds the stretches
from space to space, so that known ones are not cut by the pattern at all. The rank table
is that of a public vocabulary file: its size is fixed, and it is broadcast.

Defined results: a null or empty text has no ids and decodes to nothing; repeated rows
are encoded one by one; an empty table gives an empty result; other columns are left
alone; text that looks like a special token is ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from formflow.llm.common import ROW, packed, slices, text_of

#: Pieces of up to KEPT_BYTES whose ids a worker keeps; twice as many, and those of a few texts, are held at most.
KEPT_PIECES, KEPT_BYTES = 500_000, 48
#: Bytes of pieces that are merged in one queue; a longer piece is alone.
QUEUE_BYTES = 1 << 14
#: A pattern none of whose matches goes on over a space after a character other than white space: it begins a match.
SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: base64 token, space, rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Ranks under one word of the bitmap's lower level, as a power of two.
WIDTH = 8
MASK = (1 << WIDTH) - 1


#: What a table of pieces is asked for: a str stands for a space and the str, bytes for themselves.
Key = str | bytes


def _key(piece: str) -> Key:
    return piece[1:] if piece[0] == " " else piece.encode()


class Encoder:
    """Encodes texts by a rank table and a pattern. Not shared between threads."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.spaced = pattern == SPACED
        self.cut = regex.compile(r"(?<=\S) ").split
        self.blanks = [f"{c} " for c in regex.findall(r"\s", "".join(map(chr, range(sys.maxunicode + 1))))] if self.spaced else []
        words = (max(ranks.values()) >> WIDTH) + 1
        self.buckets: list[list[int] | None] = [None] * (words << WIDTH)  # places by rank
        self.lower = [0] * words  # a bit for each rank whose bucket has places
        self.twos = np.full(1 << 16, -1)  # rank of two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.twos[token[0] << 8 | token[1]] = rank
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.kept: dict[Key, bytes] = {}
        self.older: dict[Key, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[array]:
        """Ids of each piece.

        ``end[i]`` is where the part that begins at i ends, which is the next part's
        place; ``before[i]`` is the part's left neighbour; ``pair[i]`` the rank of the
        part together with the next one; ``first[i]`` tells where a piece begins, which no
        part crosses. The queue is empty before and after.
        """
        rank_of, buckets, lower, upper = self.ranks.get, self.buckets, self.lower, 0  # upper: a bit for each word of lower that is not 0
        text = b"".join(pieces)
        n = len(text)
        end = list(range(1, n + 1))
        before = list(range(-1, n))
        first = bytearray(n + 1)
        at = 0
        for piece in pieces:
            first[at] = 1
            before[at] = -1
            at += len(piece)
        first[n] = 1
        codes = np.frombuffer(text, np.uint8).astype(np.int64)
        ranks = np.append(self.twos[codes[:-1] << 8 | codes[1:]], -1)
        ranks[np.flatnonzero(np.frombuffer(first, np.uint8))[1:] - 1] = -1
        pair = ranks.tolist()
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        new = np.flatnonzero(np.diff(ranks[order], prepend=-1))
        places = order.tolist()
        for rank, a, b in zip(ranks[order[new]].tolist(), new.tolist(), [*new[1:].tolist(), len(places)], strict=False):
            buckets[rank] = places[a:b]  # ascending, which is a heap
            word = rank >> WIDTH
            lower[word] |= 1 << (rank & MASK)
            upper |= 1 << word
        while upper:
            # find first set, in the upper word and in the lower one
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = (word << WIDTH) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            lowest = True
            while lowest and bucket:
                i = heappop(bucket) if len(bucket) > 1 else bucket.pop()
                if pair[i] != rank:  # stale
                    continue
                j = end[i]
                end[i] = k = end[j]
                pair[j] = None
                if first[k]:
                    pair[i] = None
                else:
                    before[k] = i
                    pair[i] = new = rank_of(text[i : end[k]])
                    if new is not None:
                        if held := buckets[new]:
                            heappush(held, i)
                        else:
                            buckets[new] = [i]
                            word = new >> WIDTH
                            lower[word] |= 1 << (new & MASK)
                            upper |= 1 << word
                        lowest = new > rank
                h = before[i]
                if h >= 0:
                    pair[h] = new = rank_of(text[h:k])
                    if new is not None:
                        if held := buckets[new]:
                            heappush(held, h)
                        else:
                            buckets[new] = [h]
                            word = new >> WIDTH
                            lower[word] |= 1 << (new & MASK)
                            upper |= 1 << word
                        lowest = lowest and new > rank
            if not bucket:
                word = rank >> WIDTH
                lower[word] ^= 1 << (rank & MASK)
                if not lower[word]:
                    upper ^= 1 << word
        out, i, rank_of = [], 0, self.ranks.__getitem__
        for piece in pieces:
            stop = i + len(piece)
            ids = array("I")
            while i < stop:
                ids.append(rank_of(text[i : end[i]]))
                i = end[i]
            out.append(ids)
        return out

    def _parts(self, text: str) -> list[Key]:
        """The keys of a text's stretches, in order."""
        if not self.spaced or not text:
            return list(map(_key, self.pieces(text)))
        blank = text[0] == " " or any(b in text for b in self.blanks)
        parts = self.cut(text) if blank else text.split(" ")
        parts[0] = parts[0].encode()
        return parts

    def _learn(self, keys: set[Key]) -> None:
        """Puts the ids of ``keys`` into the table."""
        kept, older, rank_of = self.kept, self.older, self.ranks.get
        several, new, size = [], {}, 0

        def merged():
            for key, ids in zip(new, self.merge(list(new.values())), strict=True):
                kept[key] = _little_endian(ids)
            new.clear()

        for key in keys:
            if key in kept:
                continue
            if key in older:
                kept[key] = older[key]
                continue
            pieces = [key] if not self.spaced else list(map(_key, self.pieces(f" {key}" if isinstance(key, str) else key.decode())))
            if pieces != [key]:
                several.append((key, pieces))
            for piece in pieces:
                if piece in kept or piece in new:
                    continue
                if piece in older:
                    kept[piece] = older[piece]
                    continue
                raw = b" " + piece.encode() if isinstance(piece, str) else piece
                whole = rank_of(raw)
                if whole is not None:
                    kept[piece] = _little_endian(array("I", (whole,)))
                    continue
                if new and size + len(raw) > QUEUE_BYTES:
                    merged()
                    size = 0
                new[piece] = raw
                size += len(raw)
        if new:
            merged()
        for key, pieces in several:
            kept[key] = b"".join(map(kept.__getitem__, pieces))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = list(map(self._parts, texts))
        missing = set().union(*parts).difference(self.kept)
        known = len(self.kept)
        if missing:
            self._learn(missing)
        out = [b"".join(map(self.kept.__getitem__, p)) for p in parts]
        if missing:
            for key in [k for k in islice(self.kept, known, None) if len(k) > KEPT_BYTES]:
                del self.kept[key]
            if len(self.kept) >= KEPT_PIECES:
                self.older, self.kept = self.kept, {}
        return out

    def encode(self, text: str) -> array:
        return _ids(self.encode_all([text])[0])


_encoders: dict[str, Encoder] = {}


def encoder_of(key: str, ranks: dict[bytes, int], pattern: str) -> Encoder:
    """This worker's encoder for a vocabulary, so that tasks after the first find its kept pieces."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern)
    return _encoders[key]


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _ids(raw: bytes) -> array:
    ids = array("I")
    ids.frombytes(raw)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with ``n_tokens`` and ``ids``:
    the ids as little-endian unsigned 32-bit integers. With ``decoded`` also the bytes that these ids stand for, as
    :func:`decode` gives them, worked out by the same worker."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(key, *sent.value)
        for batch in slices(batches):
            ids = encoder.encode_all(batch.column("text").to_pylist())
            columns = [batch.column(ROW), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(x, encoder.tokens) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, "n_tokens", "ids", "decoded"][: len(columns)])

    rows = packed(docs, keep, text=text_of("text"))
    types = f"{ROW} {rows.schema[ROW].dataType.simpleString()}, n_tokens long, ids binary"
    return rows.mapInArrow(run, types + (", decoded binary" if decoded else ""))


def decode_ids(raw: bytes, tokens) -> bytes:
    """The bytes of ids (little-endian unsigned 32-bit integers); ``tokens``: the bytes of each id."""
    return b"".join(map(tokens.__getitem__, _ids(raw)))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (columns: the row, n_tokens, ids) with ``decoded``, the bytes that the ids stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [decode_ids(raw, sent.value) for raw in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{_ddl(encoded)}, decoded binary")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
