"""License scans by template-markup matching.

A template is text with markup.  ``<<optional>> ... <<end>>`` encloses a region that may be
absent, ``<<any N>>`` stands for up to N words of any kind.  Templates are compiled into
token automata; an automaton accepts a stretch of words whose mandatory wording matches
exactly, word by word.

Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, that is of
digits, letters a-z and non-ASCII characters.  They are found and hashed for whole batches
in numpy; base phrases are places of consecutive hashes.  An automaton only starts where its
first two words can stand, and ends with its longest match.

Null text is empty.  Without any place, the word positions are null, the label lists are
empty strings and the score is 0; a base phrase alone scores 0.5, an accepted template 1.
Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textops import ALNUM, Words, chunks, word_hash

#: fixed values: base phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: fixed values: public license notices with optional and replaceable regions
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2.0 <<optional>> the license you may not use this file except in "
                  "compliance with the license <<optional>> you may obtain a copy of the license at <<any 8>> unless required by applicable law "
                  "or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
                  "conditions of any kind either express or implied <<end>> <<end>>",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
           "conditions are met <<any 4>> redistributions of source code must retain the above copyright notice this list of conditions "
           "and the following disclaimer",
    "cc-by-4.0": "creative commons attribution 4.0 international <<optional>> public <<end>> license",
    "cc-by-nc-4.0": "cc by nc 4.0",
    "gpl-2.0": "gnu general public license <<optional>> as published by the free software foundation <<end>> <<optional>> either <<end>> "
               "version 2 <<optional>> of the license <<optional>> or at your option any later version <<end>> <<end>>",
    "gpl-3.0": "gnu general public license <<optional>> as published by the free software foundation <<end>> <<optional>> either <<end>> "
               "version 3 <<optional>> of the license <<optional>> or at your option any later version <<end>> <<end>>",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
           "that the above copyright notice and this permission notice appear in all copies",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
           "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
           "publish distribute sublicense and or sell copies of the software <<any 120>> the software is provided as is without warranty "
           "of any kind",
    "mit-notice": "released under the mit license",
    "copyright": "copyright <<optional>> c <<end>> <<any 10>> all rights reserved",
}
LABELS = {"mit-notice": "mit"}


class Automaton:
    """A nondeterministic automaton over words; state 0 starts, the last state accepts."""

    def __init__(self, template: str):
        self.step: list[dict[str, int]] = [{}]  # word -> state; "*" stands for any word
        self.skip: list[list[int]] = [[]]  # moves without a word
        opened: list[int] = []
        for part in re.findall(r"<<[^>]*>>|[^<]+", template):
            if part == "<<optional>>":
                opened.append(len(self.step) - 1)
            elif part == "<<end>>":
                self.skip[opened.pop()].append(len(self.step) - 1)
            elif part.startswith("<<any"):
                first, n = len(self.step) - 1, int(part[5:-2])
                for _ in range(n):
                    self._add("*")
                for k in range(n):
                    self.skip[first + k].append(first + n)
            else:
                for word in re.findall(r"[0-9a-z]+", part):
                    self._add(word)
        self.last = len(self.step) - 1
        if opened or self.last in self._closed({0}):
            raise ValueError("a template needs mandatory words and closed regions")

    def _add(self, word: str) -> None:
        self.step[-1][word] = len(self.step)
        self.step.append({})
        self.skip.append([])

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def _next(self, states: set[int], word: str) -> set[int]:
        return self._closed({t for s in states for key in (word, "*") if (t := self.step[s].get(key)) is not None})

    def openings(self) -> set[tuple[str, str | None]]:
        """The pairs of words that a match can begin with; None: any, or no second word."""
        found: set[tuple[str, str | None]] = set()
        for first in {w for s in self._closed({0}) for w in self.step[s]}:
            after = self._next(self._closed({0}), first)
            found |= {(first, None if w == "*" else w) for s in after for w in self.step[s]}
            if self.last in after:
                found.add((first, None))
        return found

    def longest(self, words: Iterator[str]) -> int:
        """The number of words of the longest match at the beginning of ``words``; 0: none."""
        states, best = self._closed({0}), 0
        for n, word in enumerate(words, 1):
            states = self._next(states, word)
            if self.last in states:
                best = n
            if not states:
                break
        return best


class Scanner:
    """Base phrases and template automata, compiled for hashed words."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], labels: dict[str, str]):
        hashed = lambda w: np.uint64(word_hash(w))
        self.phrases = [([hashed(w) for w in phrase.split()], label) for phrase, label in phrases.items()]
        self.automata = []
        for name, template in templates.items():
            a = Automaton(template)
            pairs = [(hashed(x), None if y is None else hashed(y)) for x, y in a.openings()]
            self.automata.append((a, labels.get(name, name), pairs))

    def places(self, w: Words) -> list[tuple[np.ndarray, str]]:
        """Positions (among the chunk's words) and label of each phrase."""
        out = []
        for hashes, label in self.phrases:
            at = np.flatnonzero(w.hash == hashes[0])
            for k, h in enumerate(hashes[1:], 1):
                at = at[at + k < len(w.hash)]
                at = at[(w.hash[at + k] == h) & (w.doc[at + k] == w.doc[at])]
            out.append((at, label))
        return out

    def matches(self, w: Words) -> list[tuple[int, int, str]]:
        """(position, words, label) of each accepted template."""
        out = []
        for automaton, label, pairs in self.automata:
            starts = set()
            for x, y in pairs:
                at = np.flatnonzero(w.hash == x)
                if y is not None:
                    at = at[at + 1 < len(w.hash)]
                    at = at[(w.hash[at + 1] == y) & (w.doc[at + 1] == w.doc[at])]
                starts.update(at.tolist())
            for at in sorted(starts):
                if n := automaton.longest(self._words_from(w, at)):
                    out.append((at, n, label))
        return out

    @staticmethod
    def _words_from(w: Words, at: int) -> Iterator[str]:
        for i in range(at, int(w.first[w.doc[at] + 1])):
            yield w.data[w.start[i]:w.end[i]].tobytes().decode().translate(_LOWER)


_LOWER = {i: i + 32 for i in range(65, 91)}


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and ``matches``, the accepted templates as (word, words, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates, LABELS)
        for batch in batches:
            for at, w in chunks(batch.column(1), ALNUM):
                found: dict[int, list] = {}
                for positions, label in scanner.places(w):
                    for p in positions.tolist():
                        found.setdefault(int(w.doc[p]), [[], set(), []])
                        found[int(w.doc[p])][0].append(p - int(w.first[w.doc[p]]))
                        found[int(w.doc[p])][1].add(label)
                for p, n, label in scanner.matches(w):
                    found.setdefault(int(w.doc[p]), [[], set(), []])[2].append((p - int(w.first[w.doc[p]]), n, label))
                rows = [_row(found.get(i)) for i in range(w.n_docs)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                         pa.list_(pa.struct([("word", pa.int64()), ("words", pa.int64()), ("label", pa.string())])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, w.n_docs), pa.array(w.counts, pa.int64()),
                     *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, matches array<struct<word: long, words: long, label: string>>")


def _row(found: list | None) -> tuple:
    if found is None:
        return 0, None, None, "", "", 0.0, []
    places, base, accepted = found
    accepted.sort()
    return (len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {m[2] for m in accepted})), 1.0 if accepted else 0.5,
            [{"word": a, "words": n, "label": label} for a, n, label in accepted])
