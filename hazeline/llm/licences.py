"""Licence texts in documents: matching statistics on a generalised suffix automaton.

The automaton holds every run of words of all templates. A document's words stream through
it; where a match can't go on, its longest run is kept if it is long enough. Kept runs are
chained per template, in order on both sides with small gaps, and a template is found if the
best chain covers enough of it. Work per document is linear in its words, and only words that
occur in some template in a row reach the automaton.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import in_slices, text_bytes

# Phrases that name a licence, and notices of public licences in lower case.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
]

MIN_RUN, MAX_GAP, MIN_COVER = 3, 6, 0.8

FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words of letters, digits and characters beyond ASCII."""
    return text.translate(FOLD).split()


@dataclass
class State:
    length: int = 0
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    ends: set[tuple[int, int]] = field(default_factory=set)


class SuffixAutomaton:
    """All runs of words of several templates; each state knows where its runs end."""

    def __init__(self, templates: list[list[bytes]]):
        self.words: dict[bytes, int] = {}
        self.states = [State()]
        self.lengths = [len(t) for t in templates]
        for number, template in enumerate(templates):
            last = 0
            for at, word in enumerate(template):
                symbol = self.words.setdefault(word, len(self.words) + 1)
                last = self._extend(last, symbol)
                self.states[last].ends.add((number, at))
        for state in sorted(self.states[1:], key=lambda s: -s.length):
            if state.link > 0:
                self.states[state.link].ends |= state.ends

    def _extend(self, last: int, symbol: int) -> int:
        states = self.states
        if symbol in states[last].next:
            target = states[last].next[symbol]
            return target if states[target].length == states[last].length + 1 else self._split(last, symbol, target)
        new = len(states)
        states.append(State(length=states[last].length + 1, link=0))
        while last >= 0 and symbol not in states[last].next:
            states[last].next[symbol] = new
            last = states[last].link
        if last >= 0:
            target = states[last].next[symbol]
            whole = states[target].length == states[last].length + 1
            states[new].link = target if whole else self._split(last, symbol, target)
        return new

    def _split(self, last: int, symbol: int, target: int) -> int:
        """A copy of ``target`` for the runs that are one longer than those of ``last``."""
        states, copy = self.states, len(self.states)
        old = states[target]
        states.append(State(states[last].length + 1, old.link, dict(old.next)))
        old.link = copy
        while last >= 0 and states[last].next.get(symbol) == target:
            states[last].next[symbol] = copy
            last = states[last].link
        return copy

    def runs(self, symbols: list[int], start: int, least: int):
        """Longest matches that can't go on: (first word, number of words, ends in templates)."""
        states, at, length = self.states, 0, 0
        for i, symbol in enumerate([*symbols, 0]):
            if symbol in states[at].next:
                at, length = states[at].next[symbol], length + 1
                continue
            if length >= least:
                yield start + i - length, length, states[at].ends
            while at > 0 and symbol not in states[at].next:
                at = states[at].link
                length = states[at].length
            if symbol in states[at].next:
                at, length = states[at].next[symbol], length + 1


@cache
def automaton() -> SuffixAutomaton:
    return SuffixAutomaton([text.encode().split() for _, text in TEMPLATES])


def covers(runs: list[tuple[int, int, int]], max_gap: int = MAX_GAP) -> tuple[int, int, int]:
    """The chain of runs of one template that covers most of it: (words, first word, end).

    ``runs`` are (first word, words, end in the template). The next run of a chain starts after
    the last on both sides, or overlaps it alike on both, at most ``max_gap`` words on.
    """
    chains: list[tuple[int, int, int, int]] = []
    best = (0, 0, 0)
    for start, n, end in sorted(runs):
        stop, t_start, t_stop = start + n, end - n + 1, end + 1
        score, first = n, start
        for have, c_first, c_stop, c_t in reversed(chains):
            if c_stop < start - max_gap - max(n, 0) - 512:
                break
            over = max(0, c_stop - start, c_t - t_start)
            gap = max(start - c_stop, t_start - c_t)
            if over < n and gap <= max_gap and c_t < t_stop and c_stop < stop and have + n - over > score:
                score, first = have + n - over, c_first
        chains.append((score, first, stop, t_stop))
        best = max(best, (score, -first, -stop))
    return best[0], -best[1], -best[2]


def template_spans(words: list[bytes]) -> list[tuple[str, float, int, int]]:
    """(label, covered share, first word, end) of every template with a match."""
    machine = automaton()
    get = machine.words.get
    symbols = [get(w, 0) for w in words]
    found: dict[int, list[tuple[int, int, int]]] = {}
    marks = bytes(map(bool, symbols))
    for m in re.finditer(rb"\x01{%d,}" % MIN_RUN, marks):
        for start, n, ends in machine.runs(symbols[m.start() : m.end()], m.start(), MIN_RUN):
            for template, end in ends:
                found.setdefault(template, []).append((start, n, end))
    spans = []
    for template, runs in found.items():
        score, first, stop = covers(runs)
        spans.append((TEMPLATES[template][0], min(1.0, score / machine.lengths[template]), first, stop))
    return spans


def phrase_places(words: list[bytes], phrase: str) -> list[int]:
    """First words of all places where the phrase's words stand in a row."""
    wanted = phrase.encode().split()
    places, at = [], -1
    while True:
        try:
            at = words.index(wanted[0], at + 1)
        except ValueError:
            return places
        if words[at : at + len(wanted)] == wanted:
            places.append(at)


def scan(text: bytes, min_cover: float = MIN_COVER) -> dict:
    words = words_of(text)
    base, places = set(), []
    for phrase, label in PHRASES.items():
        if here := phrase_places(words, phrase):
            base.add(label)
            places += here
    spans = template_spans(words)
    labels = base | {label for label, share, _, _ in spans if share >= min_cover}
    share = max([float(bool(base)), *(share for _, share, _, _ in spans)])
    return {
        "n_words": len(words), "n_base": len(places),
        "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": share,
        "spans": [dict(zip(("label", "share", "first", "stop"), s)) for s in spans if s[1] >= min_cover],
    }


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("first", pa.int64()), ("stop", pa.int64())]))),
    ]
)


def licence_scan(docs: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """A row per document: phrase places, labels, score and the covered template spans.

    Null and empty texts have no words, no labels (empty text) and score 0. Rows that repeat
    stay. The score is the largest covered share of a template, or 1 if a phrase occurs.
    """

    def per_batch(batches):
        for batch in in_slices(batches):
            rows = [scan(t, min_cover) for t in batch["_text"].to_pylist()]
            rows = [r | {"doc_id": d} for r, d in zip(rows, batch["doc_id"].to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    return source.mapInArrow(
        per_batch,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label: string, share: double, first: bigint, stop: bigint>>",
    )


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return licence_scan(table(spark, folder, "documents")).drop("spans")
