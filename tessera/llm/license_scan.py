"""License scans by template-markup matching.

A template is license wording with two kinds of markup: ``[[ ... ]]`` is optional and
``{{n}}`` is replaceable by up to n words. Its words form a token automaton: mandatory
words must follow one another exactly (case and punctuation apart), optional regions
may be passed over as a whole, replaceable regions take any words up to their bound.
The automaton is run over the words of whole texts from every place where the first
two words fit; it accepts when the last mandatory word is reached, and reads on through
optional endings as far as they match.

Base phrases are found as consecutive words; the templates add labels of their own.
``score`` is 0 without any place, 0.5 with base phrases only, and with a template
0.5 + 0.5 times the largest share of a template's words that was matched.

One pass of ``mapInArrow``, no shuffle. Defined results: null and empty texts have no
words and score 0. Rows are judged one by one: repeated rows repeat their result, extra
columns are ignored, empty tables give empty results. Overlapping places all count.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from tessera.llm.common import LOWER, Words, byte_class, map_arrow

#: Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Wording of common license notices; [[optional]], {{replaceable by up to n words}}.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[,]] version 2.0 [[(the license) you may not use this file except in "
                  "compliance with the license you may obtain a copy of the license at {{8}} unless required by applicable law "
                  "or agreed to in writing software distributed under the license is distributed on an as is basis without "
                  "warranties or conditions of any kind either express or implied]]",
    "gpl-notice": "licensed under the [[terms of the]] gnu [[lesser]] [[affero]] general public license [[as published by the free software "
                  "foundation]] [[either]] version {{1}} [[of the license or (at your option) any later version]]",
    "cc-by-nc": "licensed under [[a]] [[the]] [[creative commons]] cc by nc [[4.0]] [[international]] [[license]]",
    "cc-by-family": "licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[sharealike]] {{2}} [[international]] license",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files (the software) to deal in the software without restriction including without limitation the "
           "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
           "persons to whom the software is furnished to do so subject to the following conditions [[the above copyright notice "
           "and this permission notice shall be included in all copies or substantial portions of the software]] [[the software is "
           "provided as is without warranty of any kind express or implied]]",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
           "[[provided that the above copyright notice and this permission notice appear in all copies]]",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
           "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list "
           "of conditions and the following disclaimer [[2 redistributions in binary form must reproduce the above copyright "
           "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
           "with the distribution]] [[3 neither the name of {{10}} nor the names of its contributors may be used to endorse or "
           "promote products derived from this software without specific prior written permission]]",
    "all-rights-reserved": "copyright [[c]] {{4}} all rights reserved",
}

WORD_BYTES = byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def words_of(text: str) -> list[str]:
    """Words of a text as the vectorised scan sees them."""
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in text))


class Automaton:
    """Nondeterministic token automaton of one template.

    ``edges[state]``: (word or None for any word, next state, counted words);
    ``free[state]``: states reached without a word. Subsets of states are made into
    deterministic states when first met."""

    def __init__(self, template: str):
        self.edges: list[list[tuple]] = [[]]
        self.free: list[list[int]] = [[]]
        self.words = 0
        at = 0
        opened: list[int] = []
        for part in re.split(r"(\[\[|\]\]|\{\{\d+\}\})", template):
            if part == "[[":
                opened.append(at)
            elif part == "]]":
                end = self._new()
                self.free[at].append(end)
                self.free[opened.pop()].append(end)
                at = end
            elif part.startswith("{{"):
                gap = [at] + [self._new() for _ in range(int(part[2:-2]))]
                end = self._new()
                for a, b in zip(gap, gap[1:]):
                    self.edges[a].append((None, b))
                for a in gap:
                    self.free[a].append(end)
                at = end
            else:
                for word in words_of(part):
                    nxt = self._new()
                    self.edges[at].append((word, nxt))
                    self.words += 1
                    at = nxt
        self.accept = at
        self.subsets: dict[frozenset, dict] = {}
        self.start = self._closed({0})

    def _new(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _closed(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, subset: frozenset, word: str) -> frozenset:
        known = self.subsets.setdefault(subset, {})
        listed = word if any(w == word for s in subset for w, _ in self.edges[s]) else None
        if listed not in known:
            known[listed] = self._closed({n for s in subset for w, n in self.edges[s] if w is None or w == listed})
        return known[listed]

    def beginnings(self) -> set[tuple[str, str]]:
        """The first two words of every text it can accept (templates begin with two
        listed words)."""
        out = set()
        for s in self.start:
            for word, _ in self.edges[s]:
                if word is None:
                    raise ValueError("a template must begin with listed words")
                second = self.step(self.start, word)
                out.update((word, w) for q in second for w, _ in self.edges[q])
        return out

    def match(self, words, at: int, end: int) -> int | None:
        """End of the longest accepted run of words from ``at``, None if there is none."""
        subset, found = self.start, None
        for i in range(at, end):
            subset = self.step(subset, words(i))
            if not subset:
                break
            if self.accept in subset:
                found = i + 1
        return found


class Scanner:
    """Compiled phrases and templates; ``scan`` takes a list of texts."""

    def __init__(self, templates: dict[str, str] | None = None, phrases=PHRASES):
        self.automata = {k: Automaton(v) for k, v in sorted((TEMPLATES if templates is None else templates).items())}
        self.phrases = [(words_of(p), label) for p, label in phrases]
        pairs: dict[tuple, list[str]] = {}
        for name, a in self.automata.items():
            for pair in a.beginnings():
                pairs.setdefault(pair, []).append(name)
        self.pairs = pairs
        listed = sorted({w for p in pairs for w in p if w is not None} | {w for p, _ in self.phrases for w in p})
        hashes = Words([w.encode() for w in listed], WORD_BYTES).hashes()
        order = np.argsort(hashes)
        self.keys, self.names = hashes[order], [listed[i] for i in order]
        self.code = {w: i + 1 for i, w in enumerate(self.names)}

    def scan(self, texts: list[bytes]) -> dict[str, list]:
        w = Words(texts, WORD_BYTES)
        n = len(w.starts)
        ids = np.zeros(n + 3, np.int64)
        if n:
            h = w.hashes()
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            ids[:n] = np.where(self.keys[at] == h, at + 1, 0)
        owner = np.append(w.owner, [-1, -1, -1])
        base: list[list[tuple]] = [[] for _ in texts]
        found: list[list[tuple]] = [[] for _ in texts]
        for phrase, label in self.phrases:
            hit = np.ones(n, bool)
            for k, word in enumerate(phrase):
                hit &= (ids[k:n + k] == self.code[word]) & (owner[k:n + k] == owner[:n])
            for i in np.flatnonzero(hit):
                base[owner[i]].append((int(i - w.first[owner[i]]), label))

        lowered = LOWER[w.buf]

        def word(i: int) -> str:
            return lowered[w.starts[i]:w.ends[i]].tobytes().decode("utf-8", "replace")

        likely = np.zeros(n, bool)
        for a, b in self.pairs:
            likely |= (ids[:n] == self.code[a]) & ((ids[1:n + 1] == self.code[b]) if b is not None else True)
        for i in np.flatnonzero(likely):
            doc, second = owner[i], word(i + 1) if i + 1 < n else ""
            end = int(w.first[doc] + w.counts[doc])
            names = {x for pair in ((word(i), second), (word(i), None)) for x in self.pairs.get(pair, ())}
            for name in sorted(names):
                stop = self.automata[name].match(word, int(i), end)
                if stop is not None:
                    found[doc].append((name, int(i - w.first[doc]), int(stop - w.first[doc])))
        out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "places", "score")}
        for d in range(len(texts)):
            starts = [s for s, _ in base[d]]
            base_labels = {x for _, x in base[d]}
            shares = [min(1.0, (e - s) / self.automata[k].words) for k, s, e in found[d]]
            out["n_words"].append(int(w.counts[d]))
            out["n_base"].append(len(starts))
            out["first_word"].append(min(starts, default=None))
            out["last_word"].append(max(starts, default=None))
            out["base_labels"].append(",".join(sorted(base_labels)))
            out["labels"].append(",".join(sorted(base_labels | {k for k, _, _ in found[d]})))
            out["places"].append([f"{k}:{s}:{e}" for k, s, e in sorted(found[d], key=lambda x: (x[1], x[0]))])
            out["score"].append(0.5 + 0.5 * max(shares) if shares else 0.5 if starts else 0.0)
        return out


_scanner: dict = {}
SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, places array<string>, score double")


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; ``places`` lists template matches as label:start:end (words)."""
    listed = tuple(sorted((TEMPLATES if templates is None else templates).items()))

    def run(cols, texts):
        if listed not in _scanner:
            _scanner[listed] = Scanner(dict(listed))
        return _scanner[listed].scan(texts) | {"doc_id": cols["doc_id"]}

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(source, run, SCHEMA, ["doc_id", "text"], "text")
