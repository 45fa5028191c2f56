"""License scans: phrases, and spans of licence templates by matching statistics.

The words of all templates and notices form one generalised suffix automaton.  A text is streamed
through it: after each word the automaton holds, for each template, the longest stretch of words
ending there that occurs in it (the matching statistic).  Stretches of at least ``LEAST_MATCH`` words
that cannot be extended are chained, in template order, into spans of the template they cover; a
template of which ``LEAST_COVER`` is covered gives its label, the largest covered share is the score.
A stretch may stand at any of its places in the template; a text word covers one template word.

Notices are one-line grants and statements.  They differ from each other by a word or two, so a share
of one says little: a notice counts where it stands whole, and not inside a longer notice or a span
of its own label.

``spans`` holds every chained span and notice as ``label:first:stop:covered``: the first word in the
text, the word after the last one, and the number of template words covered.  A template whose
copies follow each other has a span for each.

Base places are the fixed phrases, word for word; each gives its label.  A text with a base place
scores at least ``PHRASE_SCORE``.

Null texts count as empty: no words, no labels, no spans, score 0.  Repeated rows have the same
result; an empty table gives an empty one.  Whole texts are streamed, however long.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import WORD_TABLE, per_text

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

LEAST_MATCH = 5
LEAST_COVER = 0.3
PHRASE_SCORE = 0.5

# Notices as the licences' own publishers word them, by label.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
}

# One-line grants and statements, by label.
_KINDS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}


def _commons(kind: str, name: str) -> list[str]:
    """How a Creative Commons licence is named."""
    loose = name.replace("Non", "Non-").replace("ShareAlike", "Share-Alike")
    loose = loose.replace("NoDerivatives", "No-Derivatives")
    plain = {name, loose, name.replace("NoDerivatives", "NoDerivs")}
    out = [f"Creative Commons {n}" for n in sorted(plain)]
    out += [f"creativecommons.org/licenses/{kind}", f"licensed under CC {kind}"]
    if kind != "by":
        return [*out, f"CC {kind}"]
    # "cc by" alone is said of letters too
    return [*out, *(f"CC BY {v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0"))]


NOTICES = {
    "mit": ["under the MIT License", "under the terms of the MIT License", "SPDX-License-Identifier: MIT"],
    "apache": [
        "under the Apache License",
        "under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "under the GNU General Public License",
        "under the terms of the GNU General Public License",
        "This work is licensed under the GNU General Public License, version 3",
        "SPDX-License-Identifier: GPL",
    ],
    "bsd": [
        "under the BSD License",
        "under the terms of the BSD License",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD",
    ],
    "mpl": ["Mozilla Public License", "SPDX-License-Identifier: MPL"],
    **{f"cc-{kind}": _commons(kind, name) for kind, name in _KINDS.items()},
    "cc0": ["CC0 1.0 Universal", "under CC0 1.0", "creativecommons.org/publicdomain/zero"],
    "public-domain": ["released into the public domain", "dedicated to the public domain"],
    "all-rights-reserved": ["All rights reserved"],
}


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_TABLE).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with an end place per sequence."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # sequence to the first place where it ends
        for k, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                state = last
                while state > 0 and k not in self.ends[state]:
                    self.ends[state][k] = place
                    state = self.link[state]
        self.places: list[dict[int, list[int]]] = [{} for _ in self.next]  # all places where it ends
        self.whole: dict[int, int] = {}  # state to the sequence that it holds whole
        for k, sequence in enumerate(sequences):
            at = 0
            for place, word in enumerate(sequence):
                at = state = self.next[at][word]
                while state > 0:
                    self.places[state].setdefault(k, []).append(place)
                    state = self.link[state]
            self.whole[at] = k

    def _state(self, length: int, link: int, following: dict, ends: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(ends)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the part of ``target`` that is one word longer than ``state``."""
        copy = self._state(
            self.length[state] + 1,
            self.link[target],
            dict(self.next[target]),
            dict(self.ends[target]),
        )
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        new = self._state(self.length[last] + 1, 0, {}, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            if self.length[target] == self.length[state] + 1:
                self.link[new] = target
            else:
                self.link[new] = self._split(state, word, target)
        return new

    def matches(self, words: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of the stretches of ``words`` that cannot be extended."""
        out, state, length = [], 0, 0
        for at, word in enumerate(words):
            if word not in self.next[state]:
                if length >= least:
                    out.append((at, length, state))
                while state > 0 and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if state == 0:
                    length = 0
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
        if length >= least:
            out.append((len(words), length, state))
        return out


    def steps(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest stretch that ends at each word."""
        state, length = 0, 0
        for word in words:
            while state > 0 and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length

    def held(self, state: int, length: int, least: int) -> dict[int, tuple[int, int]]:
        """(length, state) of the longest stretch ending here, for each sequence that holds one."""
        out: dict[int, tuple[int, int]] = {}
        while state > 0 and length >= least:
            for k in self.places[state]:
                out.setdefault(k, (length, state))
            state = self.link[state]
            length = self.length[state]
        return out

    def longest_whole(self, state: int, length: int) -> tuple[int, int] | None:
        """(sequence, length) of the longest whole sequence ending here."""
        while state > 0:
            if state in self.whole and length >= self.length[state]:
                return self.whole[state], self.length[state]
            state = self.link[state]
        return None


class Licenses:
    """The scanner of given templates, phrases and notices."""

    def __init__(self, templates=None, phrases=None, notices=None):
        templates = TEMPLATES if templates is None else templates
        phrases = PHRASES if phrases is None else phrases
        notices = NOTICES if notices is None else notices
        lines = {tuple(words_of(line)): label for label, all_ in notices.items() for line in all_}
        long = [words_of(t) for t in templates.values()]
        short = list(map(list, lines))
        self.labels = list(templates)
        self.sizes = [max(1, len(s)) for s in long]
        self.least = min([LEAST_MATCH, *map(len, short)])
        self.ids: dict[bytes, int] = {}
        for sequence in [*long, *short, *map(words_of, phrases)]:
            for word in sequence:
                self.ids.setdefault(word, len(self.ids))
        coded = [[[self.ids[w] for w in s] for s in kind] for kind in (long, short)]
        self.automaton, self.notices = map(Automaton, coded)
        self.notice_labels = list(lines.values())
        self.phrases = [([self.ids[w] for w in words_of(p)], label) for p, label in phrases.items()]

    def stretches(self, runs: list[tuple[int, list[int]]]) -> list[list[tuple[int, int, list[int]]]]:
        """Per template (first word, stop word, end places) of what cannot be extended, in text order."""
        out: list[list[tuple[int, int, list[int]]]] = [[] for _ in self.labels]
        for at, run in runs:
            before: dict[int, tuple[int, int]] = {}
            stop = at
            for stop, step in enumerate([*self.automaton.steps(run), (0, 0)], at):
                now = self.automaton.held(*step, LEAST_MATCH) if step[1] >= LEAST_MATCH else {}
                for k, (n, state) in before.items():
                    if k not in now or now[k][0] != n + 1:
                        out[k].append((stop - n, stop, self.automaton.places[state][k]))
                before = now
        return out

    def stated(self, runs: list[tuple[int, list[int]]]) -> list[tuple[int, int, str]]:
        """(first word, stop word, label) of the notices that stand whole in no longer notice."""
        out: list[tuple[int, int, str]] = []
        for at, run in runs:
            for stop, step in enumerate(self.notices.steps(run), at + 1):
                found = self.notices.longest_whole(*step)
                if found:
                    first = stop - found[1]
                    while out and out[-1][0] >= first:
                        out.pop()
                    out.append((first, stop, self.notice_labels[found[0]]))
        return out

    def spans(self, runs: list[tuple[int, list[int]]]) -> tuple[list[tuple[int, int, str, int]], float]:
        """(first word, stop word, label, covered) of templates and notices; the largest share."""
        out, share = [], 0.0
        for label, size, found in zip(self.labels, self.sizes, self.stretches(runs), strict=True):
            if found:
                share = max(share, chained(found)[-1] / size)
                out += [(a, b, label, n) for a, b, n in copies(found, LEAST_COVER * size)]
        long: dict[str, list[tuple[int, int]]] = {}
        for a, b, label, _ in out:
            long.setdefault(label, []).append((a, b))
        for a, b, label in self.stated(runs):
            inside = long.get(label, [])
            k = bisect_right(inside, (a, len(inside) and inside[-1][1]))
            if k == 0 or inside[k - 1][1] < b:
                out.append((a, b, label, b - a))
                share = 1.0
        return sorted(out), share

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        get = self.ids.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        places, base = [], set()
        for phrase, label in self.phrases:
            n = len(ids) - len(phrase) + 1
            if n > 0:
                hit = np.logical_and.reduce([ids[k : k + n] == w for k, w in enumerate(phrase)])
                at = np.flatnonzero(hit)
                if len(at):
                    places += at.tolist()
                    base.add(label)
        # only runs of template words can match
        inside = np.r_[False, ids >= 0, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
        runs = [
            (a, ids[a:b].tolist()) for a, b in edges[edges[:, 1] - edges[:, 0] >= self.least].tolist()
        ]
        spans, share = self.spans(runs)
        labels = base | {label for _, _, label, _ in spans}
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            min(1.0, max(share, PHRASE_SCORE if base else 0.0)),
            ",".join(f"{label}:{a}:{b}:{n}" for a, b, label, n in spans),
        )


Chain = tuple[int, int, int]  # first word, stop word, template words covered


def _join(best: dict[int, Chain], first: int, stop: int, places: list[int]) -> None:
    """Adds a stretch to the chains, of which the best is kept for each end place."""
    size = stop - first
    new = {}
    for end in places:
        found = (first, stop, size)
        for e, (a, b, covered) in best.items():
            if e < end:
                total = covered + size - max(0, e - (end - size), b - first)
                if (total, a) > (found[2], found[0]):
                    found = (a, stop, total)
        new[end] = found
    for end, found in new.items():
        if end not in best or (found[2], found[0]) > (best[end][2], best[end][0]):
            best[end] = found


def chained(stretches: list[tuple[int, int, list[int]]]) -> Chain:
    """The best chain: stretches in text order whose template places rise.

    Kept per end place, so a text with any number of matches costs at most the template's size
    for each.
    """
    best: dict[int, Chain] = {}
    for stretch in stretches:
        _join(best, *stretch)
    return max(best.values(), key=lambda c: (c[2], c[0]), default=(0, 0, 0))


def copies(stretches: list[tuple[int, int, list[int]]], least: float) -> list[Chain]:
    """Chains that cover ``least`` words, one after the other.

    One ends where what follows it in the text does not go on in the template.
    """
    out, best = [], {}
    for first, stop, places in stretches:
        if best:
            end, chain = max(best.items(), key=lambda c: (c[1][2], c[1][0]))
            if chain[2] >= least and chain[1] <= first and max(places) <= end:
                out.append(chain)
                best = {}
        _join(best, first, stop, places)
    last = max(best.values(), key=lambda c: (c[2], c[0]), default=(0, 0, 0))
    return [*out, last] if last[2] >= least else out


_kept: list[Licenses] = []


def _scan(texts: pa.Array) -> pa.Array:
    if not _kept:
        _kept.append(Licenses())
    rows = [_kept[0].scan(t) for t in texts.to_pylist()]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    return pa.StructArray.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
    )


def licenses(text: Column) -> Column:
    return per_text(
        _scan,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans string",
    )(text)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key), licenses(F.col(text)).alias("found")).select(key, "found.*")
