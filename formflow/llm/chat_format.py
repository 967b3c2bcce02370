"""Chat formatting with a loss mask that is aligned by offsets.

A conversation is rendered whole, ``### role: text</turn>`` for each turn, encoded once
with offsets, and the mask comes from intersecting the sorted spans of the assistant's
texts with the sorted spans of the tokens by binary search. A token that lies across
the edge of a text is under the mask with the part inside the text.

Control strings in texts and roles are escaped by a backslash, as are backslashes, so
that the rendered text can be read back exactly.

Conversations are streams of sorted rows: a task holds one conversation's rendered text
at a time. One that is longer than ``PART_CHARS`` is dealt to tasks by ranges of its turns
and comes out as several rows, cut between turns. A cut changes nothing: a turn ends with
a line feed and the next begins with ``#``, which the tokenizer's pattern never puts into one
piece, so ids and masks of the parts, one after the other, are those of the whole text
(the tests hold them against it). So a conversation of any length is rendered and encoded
in parallel, in bounded memory; only a digest over it, where one is wanted, is a chain
that one task follows, without holding it.

Defined results: null text or role counts as empty; a null conv_id is a conversation of
its own, a null turn comes first; rows with equal turn are ordered by role and text;
repeated rows are turns; an empty table gives an empty result; other columns are left
out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import slices, staged, text_of

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
LEARNT = "assistant"
#: Longer conversations are dealt to several tasks.
PART_CHARS = 1_000_000
#: Ranges of one conversation at most.
STEPS = 1000

_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|:)|(?!###|</turn>)[^\\:])*): ((?:\\(?:\\|###|</turn>)|(?!###|</turn>)[^\\])*)</turn>\n", re.S)


def escape(text: str, what: re.Pattern = _TEXT) -> str:
    return what.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns (role, text), and where the texts to be learnt are in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role, _ROLE) + SEPARATOR
        body = escape(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    out, at = [], 0
    while at < len(rendered):
        found = _TURN.match(rendered, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def mask(tokens: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the tokens (rows of start, end; sorted) that meet a span (sorted), and the parts that do."""
    index, parts = [], []
    for start, end in spans:
        first, last = np.searchsorted(tokens[:, 1], start, "right"), np.searchsorted(tokens[:, 0], end, "left")
        if last > first:
            index.append(np.arange(first, last))
            parts.append(np.clip(tokens[first:last], start, end))
    if not index:
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    return np.concatenate(index), np.concatenate(parts)


_FORMATTED = (
    "conv_id long, ranges int, range int, part int, text string, token_ids array<int>, loss_tokens array<int>, loss_start array<int>, loss_end array<int>"
)
_KEYS = ("conv_id", "ranges", "range")
_BATCH_CHARS = 200_000  # encoded together; an encoding is some hundred times its text


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, list[tuple[str, str]]]]:
    """Turns of one conversation, or of one part of a long one, from rows sorted by conversation, range and turn."""
    key, part, turns, size = None, 0, [], 0
    for batch in batches:
        for *now, role, text in zip(*(batch.column(n).to_pylist() for n in (*_KEYS, "role", "text")), strict=True):
            now = tuple(now)
            if key is not None and now != key:
                yield key, part, turns
                part, turns, size = 0, [], 0
            elif size > PART_CHARS:
                yield key, part, turns
                part, turns, size = part + 1, [], 0
            key = now
            turns.append((role, text))
            size += len(text)
    if key is not None:
        yield key, part, turns


def _ranged(turns: DataFrame) -> DataFrame:
    """``turns`` with the number of ranges that their conversation is dealt in, by its length, and the range of each.

    Only conversations longer than PART_CHARS have more than one: at most one in so many characters of the table, each with
    the turns at which its ranges end, which are quantiles of an aggregate. Turns of one number stay together.
    """
    length = F.sum(F.length("text") + F.length("role")).alias("chars")
    long = turns.groupBy("conv_id").agg(length).where(F.col("chars") > PART_CHARS)
    long = long.select(F.col("conv_id").alias("_conv"), F.ceil(F.col("chars") / PART_CHARS).cast("int").alias("ranges"))
    # a sketch with map-side combine, however many rows a conversation has
    bounds = turns.join(long, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("_conv", "ranges", F.col("turn").cast("double").alias("turn"))
    bounds = bounds.groupBy("_conv", "ranges").agg(F.percentile_approx("turn", [k / STEPS for k in range(1, STEPS)], 10 * STEPS).alias("steps"))
    cut = f"array_distinct(transform(sequence(1, least(ranges, {STEPS}) - 1), k -> element_at(steps, cast(k * {STEPS} div least(ranges, {STEPS}) as int))))"
    bounds = staged(bounds.select("_conv", F.expr(f"coalesce({cut}, array())").alias("ends")), "ranges")
    if bounds.isEmpty():
        return turns.withColumns({"ranges": F.lit(1), "range": F.lit(0)})
    # at most one row for PART_CHARS characters
    found = turns.join(F.broadcast(bounds), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    place = F.expr("coalesce(size(filter(ends, e -> turn > e)), 0)")
    return found.withColumns({"ranges": F.expr("coalesce(size(ends), 0) + 1"), "range": place}).drop("ends")


def format_conversations(rows: DataFrame, tokenizer_json: str) -> DataFrame:
    """One row for each conversation (or part of a long one): its rendered text, the token ids, and which tokens
    are learnt from which characters. Parts of a conversation follow each other by ``range`` (of ``ranges``) and ``part``."""
    sent = rows.sparkSession.sparkContext.broadcast(plain_offsets(tokenizer_json))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(sent.value)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        tokenizer.no_padding()
        tokenizer.no_truncation()

        def flush(held):
            encoded = tokenizer.encode_batch([text for _, _, text, _ in held], add_special_tokens=False)
            columns = [[] for _ in range(9)]
            for (key, part, text, spans), e in zip(held, encoded, strict=True):
                index, cut = mask(np.array(e.offsets, np.int64).reshape(-1, 2), spans)
                for column, value in zip(columns, (*key, part, text, e.ids, index, cut[:, 0], cut[:, 1]), strict=True):
                    column.append(value)
            types = [pa.int64(), *[pa.int32()] * 3, pa.string(), *[pa.list_(pa.int32())] * 4]
            names = [x.split()[0] for x in _FORMATTED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        held, size = [], 0
        for key, part, turns in _parts(batches):
            text, spans = render(turns)
            held.append((key, part, text, spans))
            size += len(text)
            if size > _BATCH_CHARS:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text")
    )
    dealt = _ranged(turns).repartition("conv_id", "range").sortWithinPartitions("conv_id", "range", "turn", "role", "text")
    return dealt.mapInArrow(run, _FORMATTED)


def plain_offsets(tokenizer_json: str) -> str:
    """The tokenizer without a step that trims white space from offsets."""
    made = json.loads(tokenizer_json)
    for step in ("post_processor", "pre_tokenizer"):
        if made.get(step) and made[step].get("type") == "ByteLevel":
            made[step]["trim_offsets"] = False
    return json.dumps(made)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_PIECE = "ranges int, range int, part int, said binary, learnt binary"
_READ_NAMES = [x.split()[0] for x in _READ.split(", ")]


def _learnt(text: str, starts: list[int], ends: list[int]) -> str:
    """The text under the mask, unescaped: the parts of neighbouring tokens are put together first."""
    spans: list[list[int]] = []
    for start, end in zip(starts, ends, strict=True):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return "".join(unescape(text[start:end]) for start, end in spans)


class _Digest:
    """What a conversation's output says, from its parts in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.said, self.chars, self.learnt, self.formatted = conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0

    def add(self, turns: int, said: bytes, chars: int, learnt: bytes, formatted: int) -> None:
        self.turns += turns
        self.said.update(said)
        self.chars += chars
        self.learnt.update(learnt)
        self.formatted += formatted

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.chars, self.learnt.hexdigest(), self.formatted


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its output says: turns and their digest, text under the mask and its digest, length.

    Works on the partitions of ``format_conversations`` as they are. What the parts of a long conversation say
    is read where they are; its digests follow in a stream of these pieces, in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in slices(batches, 64):
            out = []
            names = ("conv_id", "ranges", "range", "part", "text", "loss_start", "loss_end")
            for conv, ranges, range_, part, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{words}\n" for role, words in turns).encode()
                learnt = _learnt(text, starts, ends)
                found = (len(turns), said, len(learnt), learnt.encode(), len(text))
                if ranges > 1:
                    out.append(((conv, found[0], None, found[2], None, found[4]), (ranges, range_, part, said, found[3])))
                    continue
                if part == 0:
                    if now:
                        out.append((now.row(), (1, None, None, None, None)))
                    now = _Digest(conv)
                now.add(*found)
            yield _read_rows(out)
        yield _read_rows([(now.row(), (1, None, None, None, None))] if now else [])

    found = formatted.mapInArrow(read, f"{_READ}, {_PIECE}")
    found = staged(found, "read")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in slices(batches, 8):
            out = []
            names = ("conv_id", "n_turns", "said", "loss_chars", "learnt", "formatted_chars")
            for conv, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if now is None or now.conv != conv:
                    if now:
                        out.append((now.row(), (1, None, None, None, None)))
                    now = _Digest(conv)
                now.add(*rest)
            yield _read_rows(out)
        yield _read_rows([(now.row(), (1, None, None, None, None))] if now else [])

    pieces = found.where("ranges > 1").repartition("conv_id").sortWithinPartitions("conv_id", "range", "part")
    long = pieces.mapInArrow(follow, f"{_READ}, {_PIECE}")
    return found.where("ranges = 1").select(*_READ_NAMES).unionByName(long.select(*_READ_NAMES))


def _read_rows(rows: list[tuple[tuple, tuple]]) -> pa.RecordBatch:
    columns = zip(*(a + b for a, b in rows), strict=True) if rows else [()] * 11
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = [*_READ_NAMES, *(x.split()[0] for x in _PIECE.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
