"""License scans by template markup, compiled into token automata.

A template is a row of words with regions: ``[...]`` may be left out, ``{n}`` stands for
up to ``n`` words of any kind. It compiles into an automaton over words; a text holds the
license where the automaton accepts, that is where the mandatory wording stands exactly,
from the first word to the last, whatever stands in its regions. Of each template's
mandatory words the one that the fewest templates have is its mark; only texts that hold a
mark are cut into words at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sieveline.llm.common import TO_LOWER, only, pieces_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrase and label.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Label and template, of notices and of the full wording of short licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0 [the license]"),
    ("apache-2.0-header", "licensed under the apache license version 2 0 [the license] you may not use this file except in compliance with the license you may obtain a copy of the license at {1} www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [1] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution [[3] neither the name of {12} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission] this software is provided by {10} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {10} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("cc-by-nc", "licensed under [a] [the] cc by nc [sa] [nd] {2}"),
    ("creative-commons", "licensed under [a] [the] creative commons attribution {6} license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3 [or [any] later]"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu [lesser] [affero] general public license as published by the free software foundation either version {2} of the license or at your option any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted [provided that the above copyright notice and this permission notice appear in all copies] the software is provided as is and {6} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {6} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("mit", "[released] [licensed] under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice [including the next paragraph] shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {8} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 [if a copy of the mpl was not distributed with this file you can obtain one at {1} mozilla org mpl 2 0]"),
    ("notice", "copyright [c] {8} all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions [1] the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required [2] altered source versions must be plainly marked as such and must not be misrepresented as being the original software [3] this notice may not be removed or altered from any source distribution"),
)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[c for c in range(128) if not chr(c).isalnum()]] = False


PARTS = re.compile(r"\[|\]|\{\d+\}|[^\s\[\]{}]+")


def mandatory(template: str) -> set[str]:
    """The words that stand in every text which the template accepts."""
    found, depth = set(), 0
    for part in PARTS.findall(template):
        depth += (part == "[") - (part == "]")
        if not depth and part[0] not in "]{":
            found.add(part)
    return found


def marks(templates: Iterable[str]) -> list[str]:
    """For each template the mandatory word that the fewest templates have, of equal ones the longest."""
    words = [mandatory(t) for t in templates]
    if not all(words):
        raise ValueError("a template has no mandatory word")
    return [min(own, key=lambda w: (sum(w in other for other in words), -len(w), w)) for own in words]


class Automaton:
    """States are numbered; ``steps`` has each state's words, ``free`` the states that go on with any word, ``skips`` what is reached without one."""

    def __init__(self, template: str):
        self.steps: list[dict[str, int]] = [{}]
        self.free: dict[int, int] = {}
        self.skips: dict[int, list[int]] = {}
        parts = PARTS.findall(template)
        self.end, used = self._parse(parts, 0, 0)
        if used < len(parts) or parts.count("[") != parts.count("]"):
            raise ValueError(f"brackets don't match: {template}")
        self.closure = [frozenset(self._reach({s})) for s in range(len(self.steps))]
        self.first = sorted({w for s in self.closure[0] for w in self.steps[s]})
        self.open = any(s in self.free for s in self.closure[0])

    def _state(self) -> int:
        self.steps.append({})
        return len(self.steps) - 1

    def _parse(self, parts: list[str], i: int, state: int) -> tuple[int, int]:
        while i < len(parts) and parts[i] != "]":
            if parts[i] == "[":
                inner, i = self._parse(parts, i + 1, state)
                after = self._state()
                self.skips.setdefault(state, []).append(after)
                self.skips.setdefault(inner, []).append(after)
                state = after
            elif parts[i][0] == "{":
                last = state
                chain = [state]
                for _ in range(int(parts[i][1:-1])):
                    self.free[last] = self._state()
                    last = self.free[last]
                    chain.append(last)
                after = self._state()
                for s in chain:
                    self.skips.setdefault(s, []).append(after)
                state = after
            else:
                nxt = self._state()
                self.steps[state][parts[i]] = nxt
                state = nxt
            i += 1
        return state, i

    def _reach(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skips.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accept(self, words: list[str], at: int) -> int | None:
        """Where the longest match from ``at`` ends, or None."""
        now, found = self.closure[0], None
        while now:
            if self.end in now:
                found = at
            if at == len(words):
                break
            w = words[at]
            now = {x for s in now for t in (self.steps[s].get(w), self.free.get(s)) if t is not None for x in self.closure[t]}
            at += 1
        return found


class Scanner:
    def __init__(self, templates: Iterable[tuple[str, str]] = TEMPLATES, phrases: Iterable[tuple[str, str]] = PHRASES):
        self.phrases = [(p.split(" "), label) for p, label in phrases]
        templates = list(templates)
        self.automata = [(label, mark, Automaton(t)) for (label, t), mark in zip(templates, marks(t for _, t in templates))]
        self.rare = sorted({max(p, key=len) for p, _ in self.phrases} | {rare for _, rare, _ in self.automata})
        edge = WORD.pattern[:-1]
        self.short = {w: re.compile(f"(?<!{edge}){re.escape(w)}(?!{edge})") for w in self.rare if len(w) < 5}

    def scan(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
        low = text.translate(TO_LOWER)
        held = [w for w in self.rare if w in low and (w not in self.short or self.short[w].search(low))]
        if not held:
            raw = IS_WORD[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
            n = int(np.count_nonzero(raw[1:] & ~raw[:-1])) + int(raw[0]) if len(raw) else 0
            return n, 0, None, None, "", "", 0.0
        words = WORD.findall(low)
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            places.setdefault(w, []).append(i)
        starts, base = [], set()
        for phrase, label in self.phrases:
            k = max(range(len(phrase)), key=lambda i: len(phrase[i]))
            found = [i - k for i in places.get(phrase[k], ()) if i >= k and words[i - k : i - k + len(phrase)] == phrase]
            if found:
                base.add(label)
                starts += found
        own, covered = set(), set()
        for label, rare, automaton in self.automata:
            if rare not in places:
                continue
            for i in range(len(words)) if automaton.open else sorted(i for w in automaton.first for i in places.get(w, ())):
                end = automaton.accept(words, i)
                if end is not None:
                    own.add(label)
                    covered.update(range(i, end))
        score = 0.0 if not (base or own) else round(0.5 + 0.5 * bool(own) * (0.5 + 0.5 * len(covered) / len(words)), 6)
        join = lambda s: ",".join(sorted(s))
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), join(base), join(base | own), score


def licenses(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, phrases: Iterable[tuple[str, str]] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    ``score`` is 0 without a label, 0.5 with phrases alone, and above that, to 1, the larger
    a share of the text accepted templates cover. A null text counts as empty. Repeated rows
    stay repeated; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    templates, phrases = tuple(templates), tuple(phrases)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for part in pieces_of(batches, 1, 8 << 20):
            rows = [scanner.scan(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names=["doc_id", *names])

    return only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
