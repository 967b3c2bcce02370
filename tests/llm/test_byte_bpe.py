"""The rank queue against the public library of the same vocabulary."""

from __future__ import annotations

import random
import string
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from formflow.llm import byte_bpe

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def check(text):
    ids = list(ENCODER.encode(text))
    assert ids == LIBRARY.encode_ordinary(text)
    assert LIBRARY.decode_bytes(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    check(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "aeiou", "äöüß", "日本語", string.ascii_lowercase, "=-", " \n", "0123456789", "é ,.'sx"])
def test_pieces_with_many_ties(alphabet):
    rng = random.Random(len(alphabet))
    for n in (1, 2, 3, 7, 50, 400):
        for _ in range(5):
            check("".join(rng.choices(alphabet, k=n)))


def test_special_tokens_are_text_and_very_long_pieces_are_quick():
    check("<|endoftext|> and 'll")
    rng = random.Random(5)
    start = time.perf_counter()
    check("".join(rng.choices("abcde", k=200_000)))
    assert time.perf_counter() - start < 20


def test_kept_pieces_do_not_change_the_result(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_PIECES", 2)
    for _ in range(3):
        check("unheard-of gibberish unheardof wordlets once again unheardof")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aé ,'s1\n\t\u00a0\u2003\x1c日"), max_size=6))
def test_texts_together(texts):
    """Pieces of many texts in one queue, and stretches between spaces, give each text's own ids."""
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for _ in range(2):
        found = [list(byte_bpe._ids(x)) for x in encoder.encode_all(texts)]
        assert found == [LIBRARY.encode_ordinary(t) for t in texts]


def test_other_patterns_are_not_cut_at_spaces():
    pattern = r"\p{L}+ ?|\s+|[^\p{L}\s]+"
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    encoder = byte_bpe.Encoder(RANKS, pattern)
    for text in ("two words  and three", " a b, c\n d", ""):
        assert list(encoder.encode(text)) == library.encode_ordinary(text)


def test_pieces_share_a_queue(monkeypatch):
    """The bitmap is asked once for a bucket, not once for a place."""
    asked = 0

    class Lower(list):
        def __getitem__(self, word):
            nonlocal asked
            asked += 1
            return list.__getitem__(self, word)

    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    encoder.lower = Lower(encoder.lower)
    rng = random.Random(11)
    words = sorted({"".join(rng.choices(("th", "er", "in", "on", "qu"), k=5)) for _ in range(1000)})
    encoder.encode_all([" ".join(words)])
    assert asked < 2 * len(words) and not any(encoder.lower) and not any(encoder.buckets)


def test_round_trip_with_null_empty_and_other_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "Grüße " * 5000, None), (None, "a\u0000b \U0001f600", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(out) == 5
    for r in out:
        assert bytes(r.decoded).decode() == (r["__row"].text or "")
        assert r.n_tokens * 4 == len(r.ids)
    both = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)
    key = lambda r: str((r["__row"], r.ids))
    assert sorted(both.collect(), key=key) == sorted(out, key=key)
    empty = byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode(empty, RANKS).collect() == []
