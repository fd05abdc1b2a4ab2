"""Licence scans: matching statistics against a suffix automaton of licence tokens.

The templates' words form one generalised suffix automaton. Streaming a text through it gives, at
each word, the longest suffix that occurs in some template, and through its suffix links the
longest one that occurs in each template; where a template's match cannot be made longer it is a
block of that template, even if another template's goes on. Blocks that follow each other in both
text and template are chained into spans, and a span that covers enough of its template is a
finding. Short phrases are templates too, found wherever they end as a suffix of the running match.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import WORD_TABLE, as_bytes, text_batches, with_struct

# Phrases looked for at every place, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Well-known licence notices by label, as words; several may share a label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was"
        " not distributed with this file you can obtain one at",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
)

# Shortest block that may belong to a span, most text words between two chained blocks, and the
# share of a template that a finding covers.
MIN_BLOCK, MAX_GAP, COVERED = 3, 8, 0.8


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of a-z, 0-9 and non-ASCII characters."""
    return text.translate(WORD_TABLE).split()


class Automaton:
    """Generalised suffix automaton of the templates and phrases, with what each state stands for."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Mapping[str, str]):
        self.templates = [(label, words_of(text.encode())) for label, text in templates]
        self.phrases = [(label, words_of(text.encode())) for text, label in phrases.items()]
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, (_, words) in enumerate([*self.templates, *self.phrases]):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)), ends)
                if number < len(self.templates):
                    ends[last].add((number, at + 1))
        order = sorted(range(1, len(self.step)), key=lambda s: -self.length[s])
        for s in order:  # where a string ends, its suffixes end too
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        self.tokens = [[self.vocabulary[w] for w in words] for _, words in self.templates]
        # Of each state and template the longest match: its length, 0 for the whole running match, and
        # the places in the template where it ends.
        self.held: list[dict[int, tuple[int, list[int]]]] = [{} for _ in self.step]
        for s in reversed(order):
            shorter = self.link[s]
            for number, (size, places) in self.held[shorter].items():
                self.held[s][number] = (size or self.length[shorter], places)
            own = defaultdict(list)
            for number, at in sorted(ends[s]):
                own[number].append(at)
            self.held[s] |= {number: (0, places) for number, places in own.items()}
        self.closed: dict[tuple[int, int | None], list[tuple[int, int, list[int]]]] = {}
        # Phrases that end with a state's strings, by the length the match must have.
        own = defaultdict(list)
        for number, (_, words) in enumerate(self.phrases):
            s = 0
            for word in words:
                s = self.step[s][self.vocabulary[word]]
            own[s].append((len(words), number))
        self.found: list[list[tuple[int, int]]] = [[] for _ in self.step]
        for s in reversed(order):
            self.found[s] = self.found[self.link[s]] + own[s]

    def _new(self, length: int, step: dict[int, int], link: int, ends: list) -> int:
        self.step.append(step), self.length.append(length), self.link.append(link), ends.append(set())
        return len(self.step) - 1

    def _extend(self, last: int, token: int, ends: list) -> int:
        known = self.step[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, token, known, ends)
        new = self._new(self.length[last] + 1, {}, 0, ends)
        while last >= 0 and token not in self.step[last]:
            self.step[last][token] = new
            last = self.link[last]
        if last >= 0:
            known = self.step[last][token]
            fits = self.length[known] == self.length[last] + 1
            self.link[new] = known if fits else self._split(last, token, known, ends)
        return new

    def _split(self, last: int, token: int, known: int, ends: list) -> int:
        copy = self._new(self.length[last] + 1, dict(self.step[known]), self.link[known], ends)
        self.link[known] = copy
        while last >= 0 and self.step[last].get(token) == known:
            self.step[last][token] = copy
            last = self.link[last]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Phrase places (phrase, start), and blocks (template, text start, template start, words)."""
        get, step, link, length, found = self.vocabulary.get, self.step, self.link, self.length, self.found
        places, blocks = [], []
        state = size = 0
        for at, token in enumerate(map(get, words)):
            if size >= MIN_BLOCK:
                self._close(blocks, state, size, token, at)
            if token is None:
                state = size = 0
                continue
            to = step[state].get(token)
            if to is None:
                while state > 0 and token not in step[state]:
                    state = link[state]
                    size = length[state]
                to = step[state].get(token, 0)
                size = size + 1 if to else 0
            else:
                size += 1
            state = to
            for need, number in found[state]:
                if size >= need:
                    places.append((number, at + 1 - need))
        if size >= MIN_BLOCK:
            self._close(blocks, state, size, None, len(words))
        return places, blocks

    def _close(self, blocks: list, state: int, size: int, token: int | None, end: int) -> None:
        """Adds the blocks of those templates whose longest match ends before ``token``."""
        found = self.closed.get((state, token))
        if found is None:
            found = []
            for template, (own, places) in self.held[state].items():
                words = self.tokens[template]
                if token is None or not any(at < len(words) and words[at] == token for at in places):
                    found.append((template, own, places))
            self.closed[state, token] = found
        for template, own, places in found:
            n = own or size
            if n >= MIN_BLOCK:
                blocks += [(template, end - n, at - n, n) for at in places]

    def chain(self, blocks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Best spans (template, start, end, words covered), one for each chain of blocks.

        A block joins the chain before it in text and template that covers most, if at most
        MAX_GAP words of text lie between. Chains that overlap give way to the fullest one, of
        equals to the first; blocks that no span reaches are chained again among themselves.
        """
        spans = []
        by_template = defaultdict(list)
        for template, start, at, size in blocks:
            by_template[template].append((start, at, size))
        for template, own in by_template.items():
            own.sort()
            taken: list[tuple[int, int]] = []  # start and end of the spans of this template, by start
            while own:
                for covered, first, end in self._fullest(own, taken):
                    i = bisect_left(taken, (first,))
                    if (i == len(taken) or end <= taken[i][0]) and (i == 0 or taken[i - 1][1] <= first):
                        spans.append((template, first, end, covered))
                        insort(taken, (first, end))
                own = [b for b in own if not self._reached(b, taken)]
        return spans

    @staticmethod
    def _reached(block: tuple[int, int, int], taken: list[tuple[int, int]]) -> bool:
        i = bisect_left(taken, (block[0] + block[2],))
        return i > 0 and taken[i - 1][1] > block[0]

    @staticmethod
    def _fullest(own: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(words covered, first word, end) of the best chain to each block, the fullest first; none crosses ``taken``."""
        best: list[tuple[int, int]] = []  # words covered and first word of the chain that ends here
        longest = max(size for _, _, size in own)
        part = [bisect_right(taken, (start,)) for start, _, _ in own]
        for i, (start, at, size) in enumerate(own):
            covered, first = size, start
            for j in range(i - 1, -1, -1):
                s, a, n = own[j]
                if start - s > longest + MAX_GAP or part[j] != part[i]:
                    break
                if s + n <= start <= s + n + MAX_GAP and a + n <= at and best[j][0] + size > covered:
                    covered, first = best[j][0] + size, best[j][1]
            best.append((covered, first))
        ranked = [(c, first, start + size) for (c, first), (start, _, size) in zip(best, own)]
        return sorted(ranked, key=lambda x: (-x[0], x[1], x[2]))


@cache
def _automaton(templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton(templates, dict(phrases))


PLACE = pa.struct([("label", pa.string()), ("start", pa.int64())])
SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
FIELDS = "n_words long, places array<struct<label string, start long>>, spans array<struct<label string, start long, end long, coverage double>>"


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """``docs`` with n_words, places (label, start) and spans (label, start, end, coverage).

    ``places`` has every place of a phrase, by start; ``spans`` the chained spans of the
    templates with the share of the template they cover (below ``COVERED`` too), words from 0,
    ends exclusive. Null and empty texts have no words, places or spans. Input columns named as
    a result are replaced.
    """
    templates, pairs = tuple(templates), tuple(phrases.items())
    text_batches(docs.sparkSession)

    @F.arrow_udf(FIELDS)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = _automaton(templates, pairs)
        labels = [label for label, _ in machine.phrases]
        for texts in batches:
            counts, places, spans = [], [], []
            for value in as_bytes(texts):
                words = words_of(value.as_py())
                at, blocks = machine.scan(words)
                counts.append(len(words))
                places.append([{"label": labels[p], "start": s} for p, s in sorted(at, key=lambda x: (x[1], x[0]))])
                found = []
                for t, first, end, covered in machine.chain(blocks):
                    label, own = machine.templates[t]
                    found.append({"label": label, "start": first, "end": end, "coverage": covered / len(own)})
                spans.append(sorted(found, key=lambda x: (x["start"], x["end"], x["label"])))
            columns = [pa.array(counts, pa.int64()), pa.array(places, pa.list_(PLACE)), pa.array(spans, pa.list_(SPAN))]
            yield pa.StructArray.from_arrays(columns, ["n_words", "places", "spans"])

    return with_struct(docs, scanned(docs[f"`{text}`"]))
