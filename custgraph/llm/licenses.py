"""License scan by template markup: token automata with optional and replaceable regions.

A template is text with ``[[ ... ]]`` around wording that may be missing and ``<<n>>`` for up to n
words of any kind. It is compiled to states over words; a text is accepted at a word if the
mandatory wording follows from there exactly. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the
text with A-Z lowered, compared by 64-bit hashes. Automata are started only at words that can be
their first. Notices, identifiers and whole license texts have templates; different licenses never share one.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows give one row
each; texts are scanned whole; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import ALNUM, byte_texts, chunks, hash_texts, hash_words

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Templates of license notices and grants and their labels.
TEMPLATES = (
    ("permission is hereby granted [[free of charge]] to any person obtaining a copy of this <<4>> and associated documentation files", "mit"),
    ("licensed under the apache license [[version 2 0]] [[the license]] you may not use this file except in compliance with the license", "apache-2.0"),
    ("apache license version 2 0", "apache-2.0"),
    ("gnu general public license [[as published by the free software foundation either]] version 3", "gpl-3.0"),
    ("gnu general public license [[as published by the free software foundation either]] version 2", "gpl-2.0"),
    ("gnu lesser general public license [[as published by the free software foundation either]] version 3", "lgpl-3.0"),
    ("gnu lesser general public license [[as published by the free software foundation either]] version 2 1", "lgpl-2.1"),
    ("gnu affero general public license [[as published by the free software foundation either]] version 3", "agpl-3.0"),
    ("mozilla public license [[version]] [[v]] 2 0", "mpl-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc by nd 4 0", "cc-by-nd-4.0"),
    ("this work is licensed under a creative commons attribution [[4 0]] [[international]] license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike [[4 0]] [[international]] license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution share alike [[4 0]] [[international]] license", "cc-by-sa"),
)
#: What follows "SPDX-License-Identifier:" and its label.
IDENTIFIERS = {
    "mit": "mit", "apache 2 0": "apache-2.0", "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3.0",
    "agpl 3 0": "agpl-3.0", "mpl 2 0": "mpl-2.0", "isc": "isc", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause",
    "cc by 4 0": "cc-by-4.0", "cc by sa 4 0": "cc-by-sa-4.0", "cc0 1 0": "cc0-1.0",
}
#: Whole license texts after the copyright line, with what licensors replace or leave out.
MIT_TEXT = """
permission is hereby granted [[free of charge]] to any person obtaining a copy of this software and associated documentation files
[[the software]] to deal in the software without restriction including without limitation the rights to use copy modify merge publish
distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the
following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all
copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including
but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<8>> be
liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
with the software or the use or other dealings in the software
"""
ISC_TEXT = """
permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the
above copyright notice and this permission notice appear in all copies the software is provided as is and <<6>> disclaims all warranties
with regard to this software including all implied warranties of merchantability and fitness in no event shall <<6>> be liable for any
special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an
action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software
"""
BSD_HEAD = """
redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are
met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [[2]]
redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
documentation and or other materials provided with the distribution
"""
BSD_THIRD = """
[[3]] neither the name of <<8>> nor the names of <<4>> contributors may be used to endorse or promote products derived from this software
without specific prior written permission
"""
BSD_TAIL = """
this software is provided by <<8>> as is and any express or implied warranties including but not limited to the implied warranties of
merchantability and fitness for a particular purpose are disclaimed in no event shall <<8>> be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or
profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including
negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage
"""
TEXTS = (
    (MIT_TEXT, "mit-full"), (ISC_TEXT, "isc"), (BSD_HEAD + BSD_TAIL, "bsd-2-clause"), (BSD_HEAD + BSD_THIRD + BSD_TAIL, "bsd-3-clause"),
)

ANY = -1  # stands for a word of any kind


class Automaton:
    """States 0..n of one template; ``steps[state]`` holds (word hash or ANY, next state), empty moves in ``skips``."""

    def __init__(self, template: str, label: str, base: bool):
        self.label, self.base = label, base
        self.steps: list[list[tuple[int, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        opened: list[int] = []
        for part in re.findall(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+", template):
            here = len(self.steps) - 1
            if part == "[[":
                opened.append(here)
            elif part == "]]":
                self.skips[opened.pop()].append(here)
            elif part.startswith("<<"):
                for _ in range(int(part[2:-2])):
                    self._add(ANY)
                for state in range(here, len(self.steps) - 1):
                    self.skips[state].append(len(self.steps) - 1)
            else:
                self._add(int(hash_words(part.encode(), ALNUM)[1][0]))
        self.final = len(self.steps) - 1
        self.first = {w for s in self._closed({0}) for w, _ in self.steps[s]}

    def _add(self, word: int) -> None:
        self.steps[-1].append((word, len(self.steps)))
        self.steps.append([])
        self.skips.append([])

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for other in self.skips[todo.pop()]:
                if other not in states:
                    states.add(other)
                    todo.append(other)
        return states

    def accept(self, words: np.ndarray, at: int, end: int) -> int:
        """Words of the longest acceptance that starts at ``at``, 0 if there is none."""
        states, longest, start = self._closed({0}), 0, at
        while states:
            if self.final in states:
                longest = at - start
            if at == end:
                break
            word = int(words[at])
            states = self._closed({to for s in states for w, to in self.steps[s] if w == word or w == ANY})
            at += 1
        return longest


@lru_cache(maxsize=1)
def automata() -> tuple[list[Automaton], dict[int, list[Automaton]], np.ndarray]:
    """All automata, those that may start at a word, and the sorted first words."""
    named = [(f"spdx license identifier {words}", label) for words, label in IDENTIFIERS.items()]
    every = [Automaton(p, label, True) for p, label in BASE.items()] + [Automaton(p, label, False) for p, label in (*TEMPLATES, *named, *TEXTS)]
    starting: dict[int, list[Automaton]] = {}
    for one in every:
        for word in one.first:
            starting.setdefault(word, []).append(one)
    return every, starting, np.array(sorted(starting), np.uint64)


def matches(words: np.ndarray, start: int, end: int) -> list[tuple[int, int, Automaton]]:
    """(word index, words, automaton) of all acceptances in words[start:end]."""
    _, starting, firsts = automata()
    found = []
    for at in np.flatnonzero(np.isin(words[start:end], firsts)).tolist():
        for one in starting[int(words[start + at])]:
            size = one.accept(words, start + at, end)
            if size:
                found.append((at, size, one))
    return found


def _row(words: np.ndarray, start: int, end: int) -> tuple:
    found = matches(words, start, end)
    base = [at for at, _, one in found if one.base]
    covered = {at + i for at, size, _ in found for i in range(size)}
    join = lambda labels: ",".join(sorted(set(labels)))
    return (
        end - start, len(base), min(base) if base else None, max(base) if base else None,
        join(one.label for _, _, one in found if one.base), join(one.label for _, _, one in found),
        len(covered) / (end - start) if end > start else 0.0,
    )


def scan(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every text; no shuffle.

    ``score`` is the share of words that accepted wording covers.
    """
    kind = docs.schema[identifier].dataType.simpleString()
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def work(batches):
        for batch in batches:
            texts, rows = byte_texts(batch.column(1)), []
            for a, b in chunks(texts):
                words, bounds = hash_texts(texts[a:b], ALNUM)
                rows += [_row(words, int(bounds[i]), int(bounds[i + 1])) for i in range(b - a)]
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=[identifier, *names])

    return docs.select(identifier, text).mapInArrow(
        work,
        f"`{identifier}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
