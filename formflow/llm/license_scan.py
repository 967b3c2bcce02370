"""Licence notices by a trained paragraph classifier.

A paragraph's words and word pairs, hashed, are the sparse features of a multinomial
logistic regression over licence families and a class for text without a licence. It is
trained on variations of the notices below (words left out, other words around them) and
on paragraphs of a bounded sample of documents; a temperature fitted on variations held
back calibrates its probabilities. A paragraph whose licence is not certain enough is
of the unknown class, and so is one whose predicted family no template of that family
confirms: enough of a template's word pairs must be in the paragraph.

A paragraph is a line, and also up to ``SPAN`` consecutive lines of a text that is wrapped:
lines of ``WRAP`` characters at most, without an empty one between them. So a notice
that is broken at 70 or 80 columns, with comment marks before its lines, is judged whole.
Of spans that overlap the first one with a family counts, unless a line of it has that
family by itself; an unknown one counts only where nothing near it is known.

Scoring is one expression per document over its paragraphs, without a shuffle: the
features that carry a weight are a fixed table in the plan, all others cost one lookup.

Defined results: null counts as empty; a document without words has no paragraph;
repeated rows are scanned one by one; of families with equal scores the first by name
is predicted; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, text_of

# Notices as the licences word them.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "This project is licensed under the terms of the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("cc0", "Dedicated to the public domain under CC0 1.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved"),
)
#: Text with the same words and no licence.
OTHERWISE = (
    "The driver lost his license after the accident and all his points",
    "All guests reserved a table for the evening",
    "Human rights are discussed in the public domain of the press",
    "She was granted permission to use the hall free of charge",
    "The general public was admitted to the work shop at once",
    "The album was released under a new name in version two of the list",
    "He read the terms of the contract and the conditions in the file",
    "A copy of the form can be found in the source of the river",
)
NONE = "none"
FAMILIES = (NONE, *sorted({f for f, _ in TEMPLATES}))

SLOTS = 1 << 15
VARIANTS, HELD_BACK = 40, 8
SAMPLE_DOCS = 200
#: Words around a notice are taken from so many paragraphs of the sample, the first so many words of each.
AROUND_PARAGRAPHS, AROUND_WORDS = 40, 6
#: Longest line of a wrapped text, and lines that are judged together.
WRAP, SPAN = 100, 4
CERTAIN, CONFIRMED = 0.6, 0.6
TEMPERATURES = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)


def words_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\\\p{{L}}\\\\p{{N}}]+', 0)"


def pairs_sql(words: str) -> str:
    """Hashes of the neighbouring words of an array."""
    return f"transform({words}, (w, i) -> if(i = 0, null, xxhash64(get({words}, i - 1), w)))"


def slots_sql(words: str) -> str:
    """Distinct slots of an array's words and word pairs."""
    return (
        f"array_distinct(transform({words}, w -> int(pmod(xxhash64(w), {SLOTS}))) || "
        f"transform(filter({pairs_sql(words)}, x -> x is not null), x -> int(pmod(x, {SLOTS}))))"
    )


def _literal(values) -> str:
    return "array(" + ", ".join(values) + ")"


Templates = list[tuple[str, list[int]]]


def template_pairs(spark: SparkSession) -> Templates:
    """Word pairs of each notice, a fixed number."""
    made = spark.createDataFrame(list(TEMPLATES), "family string, text string").selectExpr("family", f"{words_sql('text')} as words")
    pairs = made.selectExpr("family", f"array_distinct(filter({pairs_sql('words')}, x -> x is not null)) as p")
    return [(r.family, r.p) for r in pairs.collect()]


def confirmed_sql(words: str, family: str, templates: Templates) -> str:
    """Whether a template of the family has enough of its word pairs in ``words``; of any family if it is ''."""
    tests = []
    for name, pairs in templates:
        held = _literal(f"{x}L" if x >= 0 else f"(-{-x}L)" for x in pairs)
        same = f"{family} = '{name}' and " if family else ""
        tests.append(f"({same}size(array_intersect({pairs_sql(words)}, {held})) >= {CONFIRMED * len(pairs)}D)")
    return " or ".join(tests)


def examples(docs: DataFrame, templates: Templates) -> DataFrame:
    """Labelled word arrays: label, slots as strings, whether it is held back for the calibration."""
    spark = docs.sparkSession
    taken = spark.createDataFrame(docs.select(text_of("text").alias("text")).take(SAMPLE_DOCS), "text string")
    # words leave through the generator: a filter on them is not pushed below it, where it would repeat the cutting
    lines = taken.selectExpr(f"explode(filter(transform(split(text, '\\n'), x -> {words_sql('x')}), w -> size(w) > 0)) as words")
    plain = lines.where(f"not ({confirmed_sql('words', '', templates)})")
    around = [w for r in plain.limit(AROUND_PARAGRAPHS).collect() for w in r.words[:AROUND_WORDS]] or ["and"]
    held = _literal("'" + w + "'" for w in around)
    notices = spark.createDataFrame([*TEMPLATES, *((NONE, t) for t in OTHERWISE)], "family string, text string")
    varied = notices.selectExpr("family", f"{words_sql('text')} as words", f"explode(sequence(0, {VARIANTS - 1})) as v")
    # words left out, from none to one in five, and words of the sample before or after
    varied = varied.selectExpr(
        "family",
        f"""if(v % 3 = 1, slice({held}, 1 + pmod(v * 7, {len(around)}), if(v % 2 = 0, 30, pmod(v, 12))), array()) ||
            filter(words, (w, i) -> pmod(xxhash64(w, i, v), 100) >= pmod(v * 5, 25)) ||
            if(v % 4 = 1, slice({held}, 1 + pmod(v * 11, {len(around)}), pmod(v, 9)), array()) as words""",
        f"v >= {VARIANTS - HELD_BACK} as held_back",
    )
    plain = plain.selectExpr(f"'{NONE}' as family", "words", "pmod(xxhash64(words), 5) = 0 as held_back")
    label = f"double(array_position({_literal(repr(f) for f in FAMILIES)}, family) - 1) as label"
    return varied.unionByName(plain).selectExpr(label, f"transform({slots_sql('words')}, x -> string(x)) as grams", "held_back")


@dataclass(frozen=True)
class Model:
    """Weights by slot and family, against those of text without a licence."""

    slots: tuple[int, ...]
    weights: tuple[tuple[float, ...], ...]
    bias: tuple[float, ...]
    temperature: float


def fit(docs: DataFrame, templates: Templates) -> Model:
    """Fits on VARIANTS variations of each notice and the paragraphs of SAMPLE_DOCS documents at most."""
    data = examples(docs, templates).coalesce(1).cache()
    # what occurs in one or two examples only says nothing of others, and most of the sample's word pairs do
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=SLOTS, minDF=3.0).fit(data)
    rows = counter.transform(data)
    model = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=25, standardization=False).fit(rows.where("not held_back"))
    raw = model.transform(rows.where("held_back")).select("label", vector_to_array("rawPrediction").alias("z"))
    loss = "sum(ln(aggregate(z, 0D, (s, x) -> s + exp((x - get(z, int(label))) / {t}))))"
    losses = raw.selectExpr(*(loss.format(t=f"{t}D") for t in TEMPERATURES)).first()
    data.unpersist()
    best = min(zip(losses, TEMPERATURES, strict=True))[1] if losses[0] is not None else 1.0
    matrix, bias = model.coefficientMatrix, model.interceptVector
    weights = {
        int(slot): tuple(round(float(matrix[k, i] - matrix[0, i]), 4) for k in range(len(FAMILIES))) for i, slot in enumerate(counter.vocabulary)
    }
    weights = {slot: w for slot, w in weights.items() if max(map(abs, w)) >= 0.02}
    slots = tuple(sorted(weights))
    return Model(slots, tuple(weights[s] for s in slots), tuple(round(float(b - bias[0]), 4) for b in bias), best)


def labelled_sql(words: str, model: Model, templates: Templates) -> str:
    """Of a paragraph's words: its family, ``unknown`` if it is not certain or not confirmed, null if there is no licence."""
    row = {s: i + 1 for i, s in enumerate(model.slots)}
    # folded to constants by the optimizer
    index = "cast(split('" + ",".join(str(row.get(s, 0)) for s in range(SLOTS)) + "', ',') as array<int>)"
    table = "cast(split('" + ",".join(str(x) for w in model.weights for x in w) + "', ',') as array<double>)"
    known = f"filter(transform({slots_sql(words)}, s -> get({index}, s)), i -> i > 0)"
    start = _literal(f"{b}D" for b in model.bias)
    scores = (
        f"transform({start}, (b, k) -> aggregate(known, b, (s, i) -> s + get({table}, (i - 1) * {len(FAMILIES)} + k)) / {model.temperature}D)"
    )
    names = _literal(repr(f) for f in FAMILIES)
    family = f"get({names}, int(array_position(z, array_max(z)) - 1))"
    certain = f"1 / aggregate(z, 0D, (s, x) -> s + exp(x - array_max(z))) >= {CERTAIN}D"
    judged = f"case when {family} = '{NONE}' then null when {certain} and ({confirmed_sql(words, family, templates)}) then {family} else 'unknown' end"
    return f"get(transform(array({known}), known -> if(size(known) = 0, null, get(transform(array({scores}), z -> {judged}), 0))), 0)"


def _spans_sql(lines: str) -> str:
    """For each line the words of the span that begins with it, null if the next line does not continue it."""
    words = ""
    for k in range(SPAN - 1, 0, -1):
        more = f" || {words}" if words else ""
        words = f"if(coalesce(get({lines}, i + {k}).wrapped, false), get({lines}, i + {k}).words{more}, array())"
    return f"transform({lines}, (l, i) -> if(l.wrapped and coalesce(get({lines}, i + 1).wrapped, false), l.words || {words}, null))"


def _found_sql(families: str) -> str:
    """Of the families of all lines and, after them, of all spans: (place, family) of each notice, by place."""
    near = f"sequence(-{SPAN - 1}, {SPAN - 1})"
    span = lambda at: f"get({families}, if({at} between 0 and n - 1, n + {at}, -1))"
    line = lambda at: f"get({families}, if({at} between 0 and n - 1, {at}, -1))"
    known = lambda x: f"coalesce({x} <> 'unknown', false)"
    of_line = f"""{known(line('i'))} or {line('i')} = 'unknown' and not exists({near}, d -> d <= 0 and {known(span('i + d'))})"""
    of_span = f"""case when {known(span('i'))} then not exists({near}, d -> d < 0 and coalesce({span('i + d')} = {span('i')}, false)
                or d >= 0 and coalesce({line('i + d')} = {span('i')}, false))
            else not exists({near}, d -> {known(span('i + d'))} or d < 0 and {span('i + d')} is not null or {line('i + d')} is not null) end"""
    places = "sequence(0, n - 1)"
    return f"""array_sort(
        transform(filter({places}, i -> {line('i')} is not null and ({of_line})), i -> named_struct('place', i, 'family', {line('i')})) ||
        transform(filter({places}, i -> {span('i')} is not null and ({of_span})), i -> named_struct('place', i, 'family', {span('i')})))"""


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with ``paragraphs`` (lines with words), and for those with a
    licence ``places`` (numbers of lines from 0) and ``found`` (the family, or unknown)."""
    templates = template_pairs(docs.sparkSession)
    model = fit(docs, templates)
    rows = packed(docs, keep, text=text_of("text"))
    line = f"transform(array({words_sql('x')}), w -> named_struct('words', w, 'wrapped', size(w) > 0 and length(x) <= {WRAP}))[0]"
    rows = rows.withColumn("lines", F.expr(f"transform(split(text, '\n', -1), x -> {line})"))
    judged = f"transform(lines.words || {_spans_sql('lines')}, words -> if(size(words) > 0, {labelled_sql('words', model, templates)}, null))"
    # arrays are columns of their own, and leave through a generator, so that each is worked out once
    rows = rows.select(ROW, F.expr("inline(array(named_struct('paragraphs', size(filter(lines, l -> size(l.words) > 0)), 'n', size(lines), "
                                   f"'families', {judged})))"))  # fmt: skip
    found = f"if(exists(families, x -> x is not null), {_found_sql('families')}, array())"
    rows = rows.select(ROW, "paragraphs", F.expr(found).alias("hits"))
    return rows.select(ROW, "paragraphs", F.col("hits.place").alias("places"), F.col("hits.family").alias("found"))
