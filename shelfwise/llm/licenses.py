"""License scans by template-markup matching.

Templates are word sequences with two kinds of markup: ``[[ ... ]]`` is an optional region and
``{{m-n}}`` a replaceable region of m to n words of any wording. Each template is compiled into an
automaton over words; a text holds the license where the automaton accepts a run of its
words, so that all mandatory wording must be there exactly and in order.

Words are the maximal runs of letters, digits and non-ASCII characters of the lower-cased (A-Z)
whole text. Texts are scanned as Arrow bytes: all words are hashed at once and looked up among the
templates' words, and only texts that hold every mandatory word of a template are walked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import PLAIN_WORD, arrow_text, byte_values, span_hashes, steps, word_spans

# Fixed base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label -> template.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0 [[the license]]",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
           "provided that the following conditions are met",
    "cc-by-4.0": "licensed under [[a]] [[creative commons]] cc by 4 0",
    "cc-by-nc-4.0": "licensed under [[a]] [[creative commons]] cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under [[a]] [[creative commons]] cc by sa 4 0",
    "copyright-notice": "copyright [[c]] {{1-8}} all rights reserved",
    "gpl-3.0": "licensed under [[the terms of]] the gnu general public license [[as published by {{1-6}}]] "
               "[[either]] version 3",
    "mit": "[[released]] under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files [[the software]] to deal in {{1-3}} without restriction",
}
ANY = -2


class Automaton:
    """Word automaton of one template: state i reads ``steps[i]`` or jumps to ``skips[i]``."""

    def __init__(self, label: str, template: str, vocabulary: dict[str, int]):
        self.label = label
        self.steps: list[int] = []
        self.skips: dict[int, int] = {}
        opened: list[int] = []
        self.mandatory: set[int] = set()
        for part in re.findall(r"\[\[|\]\]|\{\{\d+-\d+\}\}|[^\s\[\]{}]+", template):
            if part == "[[":
                opened.append(len(self.steps))
            elif part == "]]":
                self.skips[opened.pop()] = len(self.steps)
            elif part.startswith("{{"):
                least, most = map(int, part[2:-2].split("-"))
                for i in range(most):
                    if i >= least:
                        self.skips[len(self.steps)] = len(self.steps) + most - i
                    self.steps.append(ANY)
            else:
                word = vocabulary[part]
                if not opened:
                    self.mandatory.add(word)
                self.steps.append(word)
        self.first = {self.steps[s] for s in self._closed({0})}

    def _closed(self, states: set[int]) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                if s in self.skips:
                    todo.append(self.skips[s])
        return {s for s in out if s < len(self.steps)} | ({len(self.steps)} if len(self.steps) in out else set())

    def accepts_at(self, words: np.ndarray, start: int) -> bool:
        """Whether a run of words beginning at ``start`` is the template's wording."""
        states, end = self._closed({0}), len(self.steps)
        for at in range(start, min(len(words), start + end)):
            if end in states:
                return True
            states = self._closed({s + 1 for s in states if self.steps[s] in (ANY, words[at])})
            if not states:
                return False
        return end in states

    def found_in(self, words: np.ndarray) -> bool:
        if not self.mandatory.issubset(words.tolist()):
            return False
        starts = np.flatnonzero(np.isin(words, list(self.first)))
        return any(self.accepts_at(words, int(s)) for s in starts)


class Scanner:
    """Compiled phrases and templates, applied to Arrow batches."""

    def __init__(self, base: dict[str, str], templates: dict[str, str]):
        parts = [w for p in base for w in p.split()] + \
            [w for t in templates.values() for w in re.findall(r"[^\s\[\]{}]+", re.sub(r"\{\{.*?\}\}", " ", t))]
        words = sorted(set(parts))
        self.hashes = np.array([_word_hash(w) for w in words], np.uint64)
        order = np.argsort(self.hashes)
        self.hashes = self.hashes[order]
        self.vocabulary = {words[k]: i for i, k in enumerate(order)}
        self.phrases = [([self.vocabulary[w] for w in p.split()], label) for p, label in base.items()]
        self.automata = [Automaton(label, t, self.vocabulary) for label, t in templates.items()]

    def rows(self, text: pa.Array) -> dict[str, list | np.ndarray]:
        data, offsets = arrow_text(text)
        n = len(offsets) - 1
        starts, ends, row = word_spans(_WORD_OF_LOWER[data], offsets)
        h = span_hashes(byte_values(data, lower=True), starts, ends)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        ids = np.where(self.hashes[at] == h, at, -1)
        first_of = np.searchsorted(row, np.arange(n + 1))
        n_base = np.zeros(n, np.int64)
        lo, hi = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        base_labels: list[set[str]] = [set() for _ in range(n)]
        for phrase, label in self.phrases:
            k = len(phrase)
            if len(ids) < k:
                continue
            m = len(ids) - k + 1
            hit = row[:m] == row[k - 1:]
            for j, w in enumerate(phrase):
                hit &= ids[j:j + m] == w
            hit = np.flatnonzero(hit)
            np.add.at(n_base, row[hit], 1)
            np.minimum.at(lo, row[hit], hit - first_of[row[hit]])
            np.maximum.at(hi, row[hit], hit - first_of[row[hit]])
            for r in np.unique(row[hit]):
                base_labels[r].add(label)
        labels, scores = [], np.zeros(n)
        known = np.add.reduceat(np.append(ids >= 0, False), first_of[:n]) if n else np.zeros(0)
        for r in range(n):
            found = set()
            if known[r] and first_of[r + 1] > first_of[r]:
                words = ids[first_of[r]:first_of[r + 1]]
                found = {a.label for a in self.automata if a.found_in(words)}
            scores[r] = 1.0 if found else 0.5 if base_labels[r] else 0.0
            labels.append(",".join(sorted(base_labels[r] | found)))
        none = hi < 0
        return {"n_words": np.diff(first_of), "n_base": n_base, "first_word": pa.array(lo, mask=none),
                "last_word": pa.array(hi, mask=none), "base_labels": [",".join(sorted(s)) for s in base_labels],
                "labels": labels, "score": scores}


_WORD_OF_LOWER = PLAIN_WORD.copy()
_WORD_OF_LOWER[65:91] = PLAIN_WORD[97:123]


def _word_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(byte_values(data, lower=True), np.array([0]), np.array([len(data)]))[0]


COLUMNS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double")


def scan(docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id and the license findings of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are their smallest and
    largest word positions (null without any), ``labels`` adds the labels of accepted templates. ``score`` is 1
    if a template is accepted, 0.5 if only base phrases are there, else 0. Null text is empty; repeated rows are scanned
    each; an empty table gives no rows.
    """
    scanner = Scanner(BASE if base is None else base, TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                found = scanner.rows(part.column("text"))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | {
                    k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in found.items()})

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")
