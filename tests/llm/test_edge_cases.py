"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from formflow.llm import chat_format, decontaminate, license_scan, log_bloom, quality_rules, url_reputation
from formflow.llm.queries import URL_RULES

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def documents(spark, more=()):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", "c"), (4, LONG, None), (5, "x y z", "d"), (5, "x y z", "d"), (None, "x y z", None), *more]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string")


# --- URL filter -------------------------------------------------------------------------


def test_urls_are_parsed_and_rules_fit(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "nothing here": ("", "", None),
        "HTTP://WWW.Example.ORG/es/Ä?q#f": ("www.example.org", "/es/Ä", "example.org/es/"),
        "x://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"),
        "x://badexample.org/es/": ("badexample.org", "/es/", "org/"),
        "x://a.org": ("a.org", "", None), "x://org/": ("org", "/", "org/"),
        "a://b://c/d": ("b:", "//c/d", None), "x://h.com/de/#://": ("h.com", "/de/", "com/de/"), "x://É.COM/fr/": ("É.com", "/fr/", "com/fr/"),
    }
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(cases)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(0, False), (1, None)], "page_id long, bad boolean")
    out = {r["__row"].page_id: r for r in url_reputation.judge(pages, outcomes, URL_RULES).collect()}
    for i, (url, want) in enumerate(cases.items()):
        assert (out[i].host, out[i].path, out[i].rule) == want, url
        assert out[i].verdict == ("block" if want[2] in ("example.org/es/", "example.org/en/1", "com/de/") else "allow"), url
        assert out[i]["__row"].host == "mine"
    assert url_reputation.judge(pages.limit(0), outcomes, URL_RULES).collect() == []
    assert url_reputation.keep_allowed(pages, outcomes.limit(0), URL_RULES).columns == pages.columns


def test_domains_and_suffixes(spark):
    cases = {
        "www.example.com": ("example.com", "com"), "a.com.": ("a.com", "com"), "a.b.com..:80": ("b.com", "com"), "x.gov.uk": ("x.gov.uk", "gov.uk"),
        "www.x.co.uk": ("x.co.uk", "co.uk"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "10.0.0.1:8080": ("10.0.0.1", "10.0.0.1"),
        "[::1]:80": ("[::1]", "[::1]"), "me@host.org:1": ("host.org", "org"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "1.2.3.example": ("3.example", "example"),
    }
    hosts = spark.createDataFrame([(h,) for h in cases], "host string")
    domain = url_reputation.domain_of(hosts.host)
    got = {r.host: (r.d, r.s) for r in hosts.select("host", domain.alias("d"), url_reputation.suffix_of(domain).alias("s")).collect()}
    assert got == cases
    own = url_reputation.domain_of(hosts.host, ["example.com"])
    assert hosts.where("host = 'www.example.com'").select(own).first()[0] == "www.example.com"


def test_a_list_of_suffixes_and_repeated_and_long_urls(spark):
    rows = [(i, f"http://h{i % 2}.shop.x/{'p' * (100_000 if i == 3 else 5)}") for i in range(40)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i % 2 == 1) for i in range(40)] * 3, "page_id long, bad boolean")
    out = url_reputation.judge(pages, outcomes, (), long_suffixes=["shop.x"]).collect()
    assert len(out) == 80 and {(r.host, r.verdict) for r in out} == {("h0.shop.x", "allow"), ("h1.shop.x", "block")}
    rates = {r.host: r for r in url_reputation.host_rates(pages, outcomes, ["shop.x"]).collect()}
    assert (rates["h1.shop.x"].n, rates["h1.shop.x"].bad) == (40, 40)


def test_reputation_shrinks_and_blocks_on_evidence(spark):
    hosts = {"bad.example.co.uk": (40, 38), "good.example.net": (40, 1), "little.example.net": (1, 1), "other.example.co.uk": (40, 2)}
    rows, labels = [], []
    for host, (n, bad) in hosts.items():
        for k in range(n):
            labels.append((len(rows), k < bad))
            rows.append((len(rows), f"http://{host}/{k}"))
    rows.append((9999, "http://new.example.net/"))
    out = url_reputation.judge(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean"), ()
    ).collect()
    found = {r.host: r for r in out}
    assert {h for h, r in found.items() if r.verdict == "block"} == {"bad.example.co.uk"}
    assert 0.025 < found["good.example.net"].bad_rate < 0.2
    assert found["little.example.net"].bad_rate < 0.9 and found["little.example.net"].bad_bound < 0.4


# --- quality rules ----------------------------------------------------------------------


def test_measures_and_rules(spark):
    spam = "buy it now " * 60
    shout = " ".join(f"WORD{i}X" for i in range(80))
    plain = " ".join(f"tale{i} of" for i in range(40))
    lines = "\n".join(["the same line of words again and again"] * 9 + [f"line{i} has its own words {i * 7}" for i in range(9)])
    docs = documents(spark, [(10, spam, ""), (11, shout, ""), (12, plain, ""), (13, lines, ""), (14, plain + " ### ||| ### $$$", "")])
    out = {(r["__row"].doc_id, r["__row"].n_words): r for r in quality_rules.judge(docs).collect()}
    by_id = {k[0]: r for k, r in out.items()}
    for k in (1, 2, 3, 5, 10):
        assert by_id[k].base_failed and not by_id[k].kept
    assert by_id[10].n_repeat_words == 180 and by_id[12].n_repeat_words == 0
    assert by_id[13].n_dup_lines == 8
    assert {k: by_id[k].kept for k in (11, 12, 14)} == {11: False, 12: True, 14: False}
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in by_id.items() if r.kept}
    assert quality_rules.judge(docs.limit(0)).collect() == []


def test_order_of_rules_changes_no_verdict(spark):
    docs = documents(spark, [(20 + i, " ".join(f"w{j * (i + 1) % 71}" for j in range(90)) + "!" * (i * 20), "") for i in range(5)])
    rules = list(quality_rules.RULES)
    ordered = quality_rules.order_rules(docs, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    kept = [sorted(str(r["__row"].doc_id) for r in quality_rules.judge(docs, o).where("kept").collect()) for o in (rules, rules[::-1])]
    assert kept[0] == kept[1]


# --- decontamination --------------------------------------------------------------------


def brute_hits(text, items):
    find = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    words, hit, names = find(text), set(), set()
    for name, item in items:
        w = find(item)
        size = min(13, len(w))
        for s in range(len(w) - size + 1) if w else ():
            for i in range(len(words) - size + 1):
                if words[i : i + size] == w[s : s + size]:
                    hit |= set(range(i, i + size))
                    names.add(str(name))
    return len(words), len(hit), sorted(names - {"None"})


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_matches_are_those_of_brute_force(spark, block_bytes):
    rng = random.Random(3)
    alphabet = ["ab", "cd", "Ef", "gé", "hi"]
    item = lambda n: " ".join(rng.choices(alphabet, k=n))
    items = [(1, item(14)), (2, item(20)), (10, item(13)), (3, "Lone-word; pair"), (4, None), (5, " .. "), (None, item(15)), (1, "also one"), (7, item(30))]
    texts = [item(rng.randint(1, 80)) for _ in range(30)] + [f"{item(9)} {t.upper() if t else ''}! {item(9)}" for _, t in items]
    texts += [None, "", "lone", "lone word pair", "x " * 300 + "lone word pair", "ab " * 400]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.matches(docs, bench, block_bytes).collect()
    assert len(out) == len(texts)
    for r in out:
        n, hit, names = brute_hits(texts[r["__row"].doc_id], items)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, hit, names), texts[r["__row"].doc_id]
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    clean = decontaminate.keep_clean(docs, bench.limit(0))
    assert clean.columns == docs.columns and clean.count() == len(texts)
    assert decontaminate.matches(docs.limit(0), bench).collect() == []


def test_longest_match_and_its_place():
    block = decontaminate.Block([("i", b"a b c d e f g h i j k l m n o p")])
    found = decontaminate.search(block, [b"x y z", b"q a b c d e f g h i j k l m n q"])
    assert found["best"][0] == 14 and found["where"][0] == 4
    assert found["best"][5] == 0  # nine words: shorter than any window


# --- chat formatting --------------------------------------------------------------------


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("part_chars", [1_000_000, 40])
def test_conversations_are_read_back(spark, monkeypatch, part_chars):
    monkeypatch.setattr(chat_format, "PART_CHARS", part_chars)
    nasty = ["", "</turn>\n### user: hi</turn>\n", "\\", "\\\\### ", "####", " lead and trail ", "🙂é\u0301 日本 <|endoftext|>", "a\nb\n\n", "\\</turn>"]
    rng, rows = random.Random(2), []
    for c in (1, 2, 3, None):
        for t in range(12):
            rows.append((c, t // 2, rng.choice(["user", "assistant", "assistant", "a: b", "", None, "###"]), rng.choice([*nasty, None]), "x"))
    rows.append((9, None, "assistant", LONG, None))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(4)
    made = chat_format.format_conversations(df, tokenizer())
    got = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1] if r[1] is not None else -1, (r[2] or "").encode(), (r[3] or "").encode()) for r in rows if r[0] == c)
        learnt = b"".join(t for _, role, t in turns if role == b"assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for _, r, t in turns)).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learnt.decode()), hashlib.sha256(learnt).hexdigest())
    assert got[9].formatted_chars == len("### assistant: </turn>\n") + len(LONG)
    for r in made.collect():
        assert len(r.loss_tokens) == len(r.loss_start) and max([*r.loss_tokens, -1]) < len(r.token_ids)
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0), tokenizer())).collect() == []


@pytest.mark.parametrize("part_chars", [1, 300, 5000])
def test_parts_of_a_long_conversation_are_encoded_as_the_whole(spark, monkeypatch, part_chars):
    """Ids, loss tokens and their characters of all parts, one after the other, against one encoding of the whole text."""
    from tokenizers import Tokenizer

    rng = random.Random(part_chars)
    pieces = ["word", " ", "  ", "\n", "\n\n", "###", "# ", "</turn>", "\\", "é", "日本", "🙂", "12", "'s", ">", ">\n", "\t", "\r\n", "!!!", " ", " "]
    said = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
    rows = [(1, t // 3, rng.choice(["user", "assistant", said()]), said()) for t in range(400)] + [(2, 0, "assistant", "short"), (1, None, "assistant", " first ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    whole = chat_format.format_conversations(df, tokenizer()).where("conv_id = 1").collect()
    assert len(whole) == 1
    monkeypatch.setattr(chat_format, "PART_CHARS", part_chars)
    made = chat_format.format_conversations(df, tokenizer()).where("conv_id = 1").collect()
    parts = sorted(made, key=lambda r: (r.range, r.part))
    assert len(parts) > 1 and len({r.range for r in parts}) > 1 and {r.ranges for r in parts} == {parts[0].ranges}
    text = "".join(r.text for r in parts)
    assert text == whole[0].text
    library = Tokenizer.from_str(chat_format.plain_offsets(tokenizer()))
    library.encode_special_tokens = True
    ids, loss, chars, at, token = [], [], [], 0, 0
    for r in parts:
        ids += r.token_ids
        loss += [token + k for k in r.loss_tokens]
        chars += [(at + a, at + b) for a, b in zip(r.loss_start, r.loss_end, strict=True)]
        at, token = at + len(r.text), token + len(r.token_ids)
    assert ids == list(whole[0].token_ids) == library.encode(text, add_special_tokens=False).ids
    assert loss == list(whole[0].loss_tokens) and chars == list(zip(whole[0].loss_start, whole[0].loss_end, strict=True))


# --- language model ---------------------------------------------------------------------


def test_base_score_and_counts(spark, monkeypatch):
    monkeypatch.setattr(log_bloom, "BUCKET", 50)
    docs = documents(spark, [(30 + i, " ".join(f"W{j % (i + 2)} Été" for j in range(40)), "") for i in range(6)])
    training = docs.where("doc_id < 33")
    tok = lambda t: [x for x in SPACE.split("".join(c.lower() if c.isascii() else c for c in t or "")) if x] + ["\0"]
    counts = Counter(w for r in training.collect() for w in tok(r.text))
    n, v = sum(counts.values()), len(counts)
    by_pass = []
    for head, segment in ((5, 1 << 27), (100_000, 300)):
        out = log_bloom.score(docs, training, head=head, segment_bytes=segment).collect()
        assert len(out) == docs.count()
        for r in out:
            words = tok(r["__row"].text)
            want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
            assert abs(r.base_score - want) < 1e-6 * abs(want)
            assert r.score < 0 and math.isfinite(r.score)
        by_pass.append(sorted(round(r.score, 2) for r in out))
    assert np.allclose(by_pass[0], by_pass[1], rtol=0.02)
    assert log_bloom.score(docs.limit(0), training).collect() == []
    assert all(math.isfinite(r.score) for r in log_bloom.score(docs, training.limit(0)).collect())


def test_pairs_that_occur_once_are_counted(spark):
    docs = spark.createDataFrame([(1, "one two three four five")], "doc_id long, text string")
    got = log_bloom.score(docs, docs).collect()[0].score
    # six tokens with the end mark, each once after its word: counts of 1 are exact
    assert abs(got - 6 * math.log10(log_bloom.BACK + (1 - log_bloom.BACK) * 2 / 13)) < 1e-9


def test_filter_never_counts_too_low():
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    counts = rng.zipf(1.6, len(grams)).clip(1, 10**7)
    part = log_bloom.spread(grams, 3)
    held = log_bloom.Filter({i: log_bloom.part_of_filter(grams[part == i], counts[part == i]) for i in range(3)}, 3)
    found, want = held.level(grams), log_bloom.levels(counts)
    assert (found >= want).all() and (found == want).mean() > 0.97
    other = np.unique(rng.integers(2**63, 2**64 - 1, 4000, dtype=np.uint64))
    assert (held.level(other) == 0).mean() > 0.97
    middle = log_bloom.expected(want)
    assert (middle / counts).max() < 1.7 and (middle / counts).min() > 0.6


# --- licences ---------------------------------------------------------------------------


WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
}


def test_wrapped_headers(spark):
    """Standard headers as they stand in source files: broken at 70 to 80 columns, with comment marks, alone or between code."""
    rows = []
    for name, text in WRAPPED.items():
        for mark in ("", "# ", " * ", "// ", "    "):
            body = "\n".join(mark + x for x in text.split("\n"))
            rows += [(name, body), (name, f"{mark}Copyright 1999 The Authors\n{mark}\n{body}\n\nint main(void) {{ return 0; }}"), (name, "A tale.\n" + body)]
    filler = [(None, " ".join(f"tale{(i * 7 + j) % 53} of" for j in range(30))) for i in range(40)]
    verse = [(None, "\n".join(f"line {k} of a verse that goes on and on" for k in range(20))), (None, "\n\n\n"), (None, "a\n" * 50)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows + filler + verse)] * 2, "doc_id long, text string")
    for r in license_scan.scan(docs).collect():
        want, text = (rows + filler + verse)[r["__row"].doc_id]
        assert sorted(set(r.found)) == ([want] if want else []), (want, list(r.found), text)
        assert len(r.found) <= 2


def test_licences(spark):
    texts = {
        1: "A tale of old.\nReleased under the MIT License.\nThe end.",
        2: "All rights reserved.",
        3: "The guest reserved a room and all rights of way were open to the public.",
        4: "Licensed under the Apache License, Version 2.0 and more\nThis work is licensed under the GNU General Public License, version 3.",
        5: None, 6: "", 7: LONG,
    }
    filler = [(100 + i, " ".join(f"tale{(i * 7 + j) % 53} of" for j in range(30)), "z") for i in range(40)]
    docs = spark.createDataFrame([*((k, t, "y") for k, t in texts.items()), *filler], "doc_id long, text string, found string")
    out = {r["__row"].doc_id: r for r in license_scan.scan(docs).collect()}
    assert len(out) == 47 and out[1]["__row"].found == "y"
    assert [list(out[k].found) for k in (1, 2, 3, 4, 5, 6, 7)] == [["mit"], ["reserved"], [], ["apache-2.0", "gpl"], [], [], []]
    assert list(out[1].places) == [1] and out[5].paragraphs == 0
    assert license_scan.scan(docs.limit(0)).collect() == []
