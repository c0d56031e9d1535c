"""License scan with a generalised suffix automaton over the words of licence texts.

All templates go into one automaton, built once. A document's words are streamed through it; after
each word the automaton's state and match length are the matching statistics: the longest run of
words ending here that stands in some template. Runs that cannot be extended are the maximal
matches. Long ones are chained, template by template, in order of both texts; a chain covering
enough of its template becomes a span and gives the template's label. Short phrases are templates
too: where the match reaches a phrase's whole length, the phrase stands.

The library of templates is a fixed list of this module (or the caller's), not data: it is what
bounds the automaton that every task holds.

Nulls and edge cases: a null text is empty: no words, no spans, score 0, labels the empty string.
Repeated rows give repeated results. Words of a document are read one at a time; memory grows with
the matches found, not with the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.llm.frames import batched, raw_text, table
from strandline.llm.words import WORD

# Phrases of the base result and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices and openings of well-known public licences, by label.
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2.0 unless "
        "required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution",
    ),
    "cc-by-4.0": (
        "licensed under a creative commons attribution 4.0 international license",
        "licensed under cc by 4.0",
    ),
    "gpl-2.0": ("licensed under the gnu general public license version 2",),
    "gpl-3.0": (
        "licensed under the gnu general public license version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "mit-notice": ("released under the mit license", "licensed under the mit license"),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software",
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
    ),
}

#: Words a match must have to count as long, or the whole template if that is shorter.
MIN_MATCH = 4
#: Words that may lie between two chained matches, in the document and in the template.
MAX_GAP = 12
#: Share of a template that its chained matches must cover.
MIN_COVERAGE = 0.8


@dataclass
class Automaton:
    """The smallest automaton of all word runs of the templates; state 0 is the empty run."""

    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])  # (template, words up to here)
    sizes: list[int] = field(default_factory=list)

    @classmethod
    def build(cls, templates: Iterable[list[bytes]]) -> Automaton:
        made = cls()
        for number, words in enumerate(templates):
            made.sizes.append(len(words))
            last = 0
            for place, word in enumerate(words, 1):
                last = made._grow(last, word)
                made.ends[last].add((number, place))
        # A run's occurrences are also those of every longer run of which it is the end.
        for state in sorted(range(1, len(made.link)), key=made.length.__getitem__, reverse=True):
            made.ends[made.link[state]] |= made.ends[state]
        made.ends[0] = set()
        return made

    def _state(self, length: int, step: dict[bytes, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, parent: int, word: bytes, child: int) -> int:
        """``child`` holds runs of several lengths; those that end at ``parent`` get a state of their own."""
        if self.length[child] == self.length[parent] + 1:
            return child
        twin = self._state(self.length[parent] + 1, dict(self.step[child]), self.link[child])
        self.link[child] = twin
        while parent >= 0 and self.step[parent].get(word) == child:
            self.step[parent][word] = twin
            parent = self.link[parent]
        return twin

    def _grow(self, last: int, word: bytes) -> int:
        if word in self.step[last]:  # a run that an earlier template has, too
            return self._split(last, word, self.step[last][word])
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.step[last][word])
        return new

    def statistics(self, words: Iterable[bytes]) -> Iterator[tuple[int, int]]:
        """After each word: the state and length of the longest template run that ends there."""
        state = run = 0
        step, link, length = self.step, self.link, self.length
        first = step[0]
        for word in words:
            if word not in first:  # in no template at all
                state = run = 0
            else:
                while word not in step[state]:
                    state = link[state]
                    run = length[state]
                state = step[state][word]
                run += 1
            yield state, run


@dataclass
class Scan:
    words: int
    phrases: list[tuple[int, int]]  # (first word, phrase)
    spans: list[tuple[int, int, int, float]]  # (first word, word after the last, template, share covered)


class Scanner:
    """The automaton of phrases and templates, and what its states mean."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, tuple[str, ...]] = TEMPLATES):
        self.phrase_labels = list(phrases.values())
        self.template_labels = [label for label, texts in templates.items() for _ in texts]
        bodies = [*phrases, *(text for texts in templates.values() for text in texts)]
        self.automaton = Automaton.build([WORD.findall(b.encode().lower()) for b in bodies])
        sizes, base, made = self.automaton.sizes, len(phrases), self.automaton
        #: By state: the phrases that end there (with their length); the template places there, each with
        #: the words that a match there can have at most. What ends with a shorter run ends here, too.
        self.endings: list[list[tuple[int, int]]] = [[] for _ in made.link]
        self.places: list[dict[tuple[int, int], int]] = [{} for _ in made.link]
        for state in sorted(range(1, len(made.link)), key=made.length.__getitem__):
            above, own = made.link[state], made.ends[state]
            whole = ((sizes[t], t) for t, at in own if t < base and at == sizes[t] <= made.length[state])
            self.endings[state] = sorted({*self.endings[above], *whole})
            shorter = {place: min(most, made.length[above]) for place, most in self.places[above].items()}
            self.places[state] = shorter | {(t - base, at): at for t, at in own if t >= base}
        self.sizes = sizes[base:]
        self.shortest = min([MIN_MATCH, *self.sizes])

    def scan(self, raw: bytes) -> Scan:
        phrases: list[tuple[int, int]] = []
        pieces: dict[int, list[tuple[int, int, int]]] = {}  # by template: (end in text, end in template, words)
        endings, state, run, count = self.endings, 0, 0, 0
        words = (m.group() for m in WORD.finditer(raw.lower()))
        for next_state, next_run in self.automaton.statistics(words):
            if run >= self.shortest:
                self._collect(pieces, count, state, run, next_state)
            state, run = next_state, next_run
            count += 1
            if endings[state]:
                phrases += [(count - size, phrase) for size, phrase in endings[state] if size <= run]
        if run >= self.shortest:
            self._collect(pieces, count, state, run, 0)
        spans = [span for template in sorted(pieces) for span in self._chain(template, pieces[template])]
        return Scan(count, sorted(phrases), self._disjoint(spans))

    def _collect(self, pieces: dict, end: int, state: int, run: int, after: int) -> None:
        """Notes the matches that end with ``state``: its places that ``after`` does not go on from."""
        further = self.places[after]
        for (template, at), most in self.places[state].items():
            if (template, at + 1) not in further and min(run, most) >= min(MIN_MATCH, self.sizes[template]):
                pieces.setdefault(template, []).append((end, at, min(run, most)))

    def _chain(self, template: int, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, float]]:
        """Chains of matches in order of both texts; the ones that cover enough of the template.

        A match continues the best-covered of the open chains that end shortly before it in both
        texts; chains too far behind are closed, so that only a few are open at any word.
        """
        open_chains: list[tuple[int, int, int, int]] = []  # (first word, end in text, end in template, covered)
        done: list[tuple[int, int, int]] = []
        for end, at, run in found:
            start = end - run
            still = [c for c in open_chains if start - c[1] <= MAX_GAP]
            done += [(c[0], c[1], c[3]) for c in open_chains if start - c[1] > MAX_GAP]
            best = (start, end, at, run)
            for first, chain_end, chain_at, covered in still:
                overlap = max(0, chain_end - start, chain_at - (at - run))
                if overlap < run and at > chain_at and at - run - chain_at <= MAX_GAP and covered + run - overlap > best[3]:
                    best = (first, end, at, covered + run - overlap)
            open_chains = [*still, best]
        done += [(c[0], c[1], c[3]) for c in open_chains]
        size = self.sizes[template]
        for first, end, covered in done:
            if covered >= MIN_COVERAGE * size:
                yield first, end, template, min(1.0, covered / size)

    def _disjoint(self, spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
        """Of spans that overlap, the one that covers most words (then share, then the first)."""
        kept: list[tuple[int, int, int, float]] = []
        for span in sorted(spans, key=lambda s: (-s[3] * self.sizes[s[2]], -s[3], s)):
            at = bisect_left(kept, span)
            if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
                kept.insert(at, span)
        return kept


def scan_licenses(docs: DataFrame, text: str = "text", scanner: Scanner | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, then

    n_words; phrases array<struct<first, label>> (every place of a phrase); spans
    array<struct<first, end, label, coverage>> (covered template spans, in words, end exclusive).
    """
    scanner = scanner or Scanner()
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    found = (
        "n_words bigint, phrases array<struct<first:bigint,label:string>>, "
        "spans array<struct<first:bigint,end:bigint,label:string,coverage:double>>"
    )
    phrase_type = pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())]))
    span_type = pa.list_(
        pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("coverage", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shared.value
        for batch in batches:
            scans = [tool.scan(body) for body in batch.column(batch.num_columns - 1).to_pylist()]
            phrases = [[{"first": a, "label": tool.phrase_labels[p]} for a, p in s.phrases] for s in scans]
            spans = [
                [{"first": a, "end": b, "label": tool.template_labels[t], "coverage": c} for a, b, t, c in s.spans]
                for s in scans
            ]
            columns = [pa.array([s.words for s in scans], pa.int64()), pa.array(phrases, phrase_type), pa.array(spans, span_type)]
            yield pa.record_batch(
                [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "n_words", "phrases", "spans"]
            )

    source = docs.select(*keep, raw_text(text).alias("text_bytes"))
    return batched(source, run, StructType([*source.schema[:-1], *StructType.fromDDL(found)]))


def op1_license(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and covered licence templates of every document.

    score: the best coverage of a template span, or 1 where a base phrase stands, else 0.
    """
    scans = scan_licenses(table(spark, folder, "documents"))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    base, more = F.col("phrases.label"), F.col("spans.label")
    return scans.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min("phrases.first").alias("first_word"),
        F.array_max("phrases.first").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"),
        F.col("spans"),
    )
