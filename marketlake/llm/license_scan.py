"""License scans: matching statistics against a generalised suffix automaton.

The automaton holds every run of words of the license templates. A text is streamed through
it once; at each word the state and the matched length give the longest run of words that ends
there and stands in some template (the matching statistics). Maximal runs of ``MIN_MATCH`` words
or more are chained along their template, across gaps of at most ``MAX_GAP`` words on either side,
into covered spans; a span that covers ``COVERAGE`` of a template's words gives its label if each of
the template's marks, the words that tell it from its variants, lies in one match, and if no
span that overlaps it covers more words of another label's template. Short
phrases are templates that must be covered in whole, and each of their places counts.

Templates are notices, openings, and the sections of the full texts (``license_texts``). A section that
stands in several licenses has all their names as its label, joined by ``/``.

The automaton's size is bounded by the templates, which are a parameter of the job and not
data. A match has ``MIN_MATCH`` words or is a phrase, so only runs of words that stand in a known run
of that length, or in a known pair of a phrase, are stepped through.

Defined results: null, empty and wordless texts have no words, no labels and score 0. Each
input row gives one output row; rows may repeat. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._text import ALNUM_WORD, Words, mix, row_slices
from marketlake.llm.license_texts import SECTIONS

MIN_MATCH = 4
MAX_GAP = 6
COVERAGE = 0.6

# Phrases of which every place counts, by label.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}

# Public license notices and license openings, by label; marks stand between asterisks.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the *Apache License, Version 2.0*",
        "Licensed under the *Apache License, Version 2.0* (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "mit": [
        "Released under the *MIT License*",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the *Mozilla Public License, v. 2.0*.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
# Variants of Creative Commons by their short and long names, and their versions.
for _short, _long in (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _port in (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic")):
        TEMPLATES[f"cc-{_short.lower()}-{_version}"] = [
            f"Licensed under *CC {_short} {_version}*",
            f"This work is licensed under a *Creative Commons {_long} {_version}* {_port} License",
        ]
# Members of the GNU family by their names, and their versions.
for _label, _name, _versions in (("gpl", "GNU General", ("2", "3")), ("agpl", "GNU Affero General", ("3",)),
                                 ("lgpl", "GNU Lesser General", ("2.1", "3"))):
    for _version in _versions:
        TEMPLATES[_label + "-" + (_version if "." in _version else f"{_version}.0")] = [
            f"This work is licensed under the *{_name} Public License, version {_version}*",
            *(f"This {_thing} is free software: you can redistribute it and/or modify it under the "
              f"terms of *the {_name} Public License as published* by the Free Software Foundation, "
              f"either *version {_version} of the License*, or (at your option) any later version."
              for _thing in ("program", "library")),
            f"This program is free software; you can redistribute it and/or modify it under the terms "
            f"of *the {_name} Public License version {_version} as published* by the Free Software "
            "Foundation.",
        ]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    whole: bool  # a phrase: all of it, every place
    marks: tuple[tuple[int, int], ...] = ()  # runs of words that must each lie in one match


def template_words(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                            re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def marked_template(label: str, text: str) -> Template:
    """A template of which the words between asterisks are marks."""
    words: tuple[str, ...] = ()
    marks = []
    for i, part in enumerate(text.split("*")):
        own = template_words(part)
        if i % 2:
            marks.append((len(words), len(words) + len(own)))
        words += own
    return Template(label, words, False, tuple(marks))


def templates(phrases: dict[str, str] = PHRASES, texts: dict[str, list[str]] = TEMPLATES,
              sections: dict[str, list[str]] = SECTIONS) -> list[Template]:
    out = [Template(k, template_words(v), True) for k, v in phrases.items()]
    out += [marked_template(k, t) for k, v in texts.items() for t in v]
    out += [Template(k, template_words(t), False) for k, v in sections.items() for t in v]
    if any(not t.words for t in out):
        raise ValueError("a template has no words")
    return out


class SuffixAutomaton:
    """A generalised suffix automaton over the templates' words.

    ``phrases[s]`` lists (template, length) of the whole phrases that are suffixes of the runs of
    state ``s``; ``ends[s]`` the (template, end) places of the runs of a state, for states whose
    runs reach ``min_match`` words.
    """

    def __init__(self, known: list[Template], min_match: int):
        self.known, self.min_match = known, min_match
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[list[tuple[int, int]]] = [[]]
        final: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(known):
            state = 0
            for i, word in enumerate(template.words):
                state = self._extend(state, word, places)
                places[state].append((t, i + 1))
            if template.whole:
                final.setdefault(state, []).append((t, len(template.words)))
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.phrases: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for s in order[1:]:
            self.phrases[s] = (*self.phrases[self.link[s]], *final.get(s, []))
        for s in reversed(order[1:]):
            places[self.link[s]].extend(places[s])
        self.ends = [tuple(dict.fromkeys(p)) if n >= min_match else ()
                     for p, n in zip(places, self.length, strict=True)]

    def _new(self, length: int, nexts: dict[str, int], link: int, places: list) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        places.append([])
        return len(self.link) - 1

    def _split(self, p: int, word: str, q: int, places: list) -> int:
        """A state for the runs of ``q`` that are one word longer than those of ``p``."""
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q], places)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: str, places: list) -> int:
        q = self.next[last].get(word)
        if q is not None:  # another template has this run
            return q if self.length[q] == self.length[last] + 1 else self._split(
                last, word, q, places)
        state = self._new(self.length[last] + 1, {}, 0, places)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(
                p, word, q, places)
        return state

    def statistics(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest known run that ends at each word."""
        state, matched = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            yield state, matched


def scan_run(automaton: SuffixAutomaton, words: list[str], at: int
             ) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
    """Places (phrase, start) and maximal matches (start, end, template, template end) of a run
    of words whose first stands at ``at``."""
    places, matches = [], []
    before = (0, 0)
    for i, now in enumerate([*automaton.statistics(words), (0, 0)], at):
        state, matched = now
        if before[1] >= automaton.min_match and matched <= before[1]:  # the match ended
            matches += [(i - before[1], i, t, end) for t, end in automaton.ends[before[0]]
                        if not automaton.known[t].whole]
        places += [(t, i + 1 - n) for t, n in automaton.phrases[state] if n <= matched]
        before = now
    return places, matches


def covered_spans(matches: list[tuple[int, int, int, int]], known: list[Template],
                  max_gap: int) -> list[tuple[int, int, int, float, bool]]:
    """(start, end, template, share of the template's words, whether each mark lies in one match) of
    the chains of matches."""
    open_: dict[int, list] = {}
    spans = []

    def close(t: int) -> None:
        start, end, _, covered, seen = open_.pop(t)
        marked = all(any(a <= m and n <= b for a, b in seen) for m, n in known[t].marks)
        spans.append((start, end, t, min(1.0, covered / len(known[t].words)), marked))

    for start, end, t, stop in sorted(matches):
        begin = stop - (end - start)
        chain = open_.get(t)
        if chain and (start - chain[1] > max_gap or not 0 <= begin - chain[2] <= max_gap
                      or start < chain[1]):
            gain = end - max(start, chain[1])
            if start < chain[1] and gain <= 0:
                continue  # inside what is covered
            close(t)
            chain = None
        if chain is None:
            open_[t] = [start, end, stop, end - start, [(begin, stop)]]
        else:
            chain[1:] = [end, stop, chain[3] + end - start, [*chain[4], (begin, stop)]]
    for t in list(open_):
        close(t)
    return sorted(spans)


def labelled_spans(spans: list[tuple[int, int, int, float, bool]], known: list[Template],
                   coverage: float) -> list[bool]:
    """Which spans give their label: covered and marked, and no overlapping one of another label
    covers more words."""
    order = sorted((i for i, s in enumerate(spans) if s[3] >= coverage and s[4]),
                   key=lambda i: -spans[i][3] * len(known[spans[i][2]].words))
    held = [False] * len(spans)
    best: list[int] = []
    for i in order:
        start, end, t, share, _ = spans[i]
        held[i] = all(end <= spans[k][0] or spans[k][1] <= start or known[spans[k][2]].label
                      == known[t].label or spans[k][3] * len(known[spans[k][2]].words)
                      <= share * len(known[t].words) for k in best)
        if held[i]:
            best.append(i)
    return held


_ROW = ("doc_id long, n_words long, places array<struct<label:string,start:long>>, "
        "spans array<struct<label:string,start:long,`end`:long,coverage:double,labelled:boolean>>")


def _scan(known: list[Template], min_match: int, max_gap: int, coverage: float) -> Callable:
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()),
                               ("end", pa.int64()), ("coverage", pa.float64()),
                               ("labelled", pa.bool_())]))
    step = np.uint64(0x9E3779B97F4A7C15)
    # the known runs that a match or a phrase is made of, by their length
    parts = [(max(1, min_match), [t for t in known if not t.whole]),
             (2, [t for t in known if t.whole]), (1, [t for t in known if t.whole and len(t.words) == 1])]

    def grams(h: np.ndarray, n: int) -> np.ndarray:
        out = h[:len(h) - n + 1]
        for i in range(1, n):
            out = mix(out * step + h[i:len(h) - n + 1 + i])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(known, min_match)
        alive = []
        for n, some in parts:
            own = Words(pa.array([" ".join(t.words) for t in some], pa.string()), ALNUM_WORD, lower=True)
            if len(own) >= n:
                alive.append((n, np.unique(grams(own.hashes(), n)[own.inside(n)[:len(own) - n + 1]])))
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), ALNUM_WORD, lower=True)
                h = words.hashes()
                # word i is live if it is part of a known run of its row
                live = np.zeros(len(words) + 1, dtype=bool)
                for n, runs in alive:
                    if len(words) >= n:
                        at = np.flatnonzero(np.isin(grams(h, n), runs)
                                            & words.inside(n)[:len(words) - n + 1])
                        for k in range(n):
                            live[at + k] = True
                new = np.ones(len(words) + 1, dtype=bool)
                new[1:] = ~live[:-1]
                new[words.first] = True
                starts = np.flatnonzero(live & new)
                rows = np.searchsorted(words.first, starts, side="right") - 1
                places: list[list] = [[] for _ in range(words.rows)]
                matches: list[list] = [[] for _ in range(words.rows)]
                for i, r in zip(starts.tolist(), rows.tolist(), strict=True):
                    j, stop = i + 1, int(words.first[r + 1])
                    while j < stop and live[j]:
                        j += 1
                    found = scan_run(automaton, [words.word(k).decode() for k in range(i, j)],
                                     i - int(words.first[r]))
                    places[r] += found[0]
                    matches[r] += found[1]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(words.first)),
                    pa.array([[{"label": known[t].label, "start": s} for t, s in p]
                              for p in places], place),
                    pa.array([[{"label": known[t].label, "start": a, "end": b, "coverage": c,
                                "labelled": held} for (a, b, t, c, _), held in zip(
                                    found, labelled_spans(found, known, coverage), strict=True)]
                              for found in (covered_spans(m, known, max_gap) for m in matches)], span),
                ], names=["doc_id", "n_words", "places", "spans"])
    return run


def license_spans(docs: DataFrame, known: list[Template] | None = None, min_match: int = MIN_MATCH,
                  max_gap: int = MAX_GAP, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words, phrase places (label, start) and covered template spans of every row.

    Starts and ends are word numbers from 0, ends exclusive.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan(known or templates(), min_match, max_gap, coverage), _ROW)


def license_labels(docs: DataFrame, coverage: float = COVERAGE, **options) -> DataFrame:
    """:func:`license_spans` with base_labels, labels (sorted arrays) and score.

    The score is the greatest share of a template that the text covers (1 for a phrase).
    """
    found = license_spans(docs, coverage=coverage, **options)
    base = F.array_distinct(F.col("places.label"))
    more = F.transform(F.filter("spans", lambda s: s["labelled"]), lambda s: s["label"])
    return found.select(
        "*", F.array_sort(base).alias("base_labels"),
        F.array_sort(F.array_union(base, more)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`license_labels` over ``documents``."""
    found = license_labels(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"), "score")
