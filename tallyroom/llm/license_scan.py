"""License scans by template markup: optional and replaceable regions as token automata.

A template is wording with two kinds of region:

* ``[[ ... ]]`` may be left out as a whole;
* ``{{name:n}}`` stands for up to ``n`` words of any kind (a copyright line, a name).

``compile_template`` turns it into an automaton over words: an exact word, or a span of
free words, each with the places that may follow. A text is accepted where all mandatory
words follow each other exactly; a template may start at any word. The automaton is run as
a set of states (no backtracking), so the time is words times live states.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased: digits,
letters and all characters beyond ASCII; punctuation only separates.

Whole notices are templates from the grant to the end of the disclaimer: a text that holds the first
sentence alone, or changes a word of the rest, is not accepted. Copyright lines, names of holders and
list marks are regions. Shorter templates are the sentences by which a text refers to a licence. Of places
of one template that lie inside each other, the outermost is reported.

Beside the templates the scan reports the base phrases: each place where the words
of a phrase stand consecutively. Score: the share of the text's words that stand in an
accepted place or phrase, 0 for a text without words.

Defined results: a null text is an empty one: no words, no labels, score 0, null positions;
repeated rows and ids are scanned each for itself; long texts are scanned whole; an empty
table gives no rows. Columns of other names are never read, so clashing names cannot matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices, utf8

# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of licence notices, with their optional and replaceable regions. Whole notices
# (grant, conditions, disclaimer) first, then the sentences by which texts refer to a licence.
_BSD_GRANT = (
    "[[copyright {{holder:20}}]] redistribution and use in source and binary forms with or without "
    "modification are permitted provided that the following conditions are met "
    "[[1]] [[a]] redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer "
    "[[2]] [[b]] redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution ")
_BSD_NAMES = (
    "[[3]] [[c]] neither the name of {{holder:12}} nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission ")
_BSD_DISCLAIMER = (
    "this software is provided by {{party:12}} as is and any express or implied warranties including "
    "but not limited to the implied warranties of merchantability and fitness for a particular purpose "
    "are disclaimed in no event shall {{party:12}} be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however "
    "caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised of "
    "the possibility of such damage")
TEMPLATES = {
    "mit": [
        "[[mit license]] [[copyright {{holder:20}}]] permission is hereby granted free of charge to any "
        "person obtaining a copy of this software and associated documentation files the software to "
        "deal in the software without restriction including without limitation the rights to use copy "
        "modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice [[including the next paragraph]] shall be "
        "included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and "
        "[[non infringement]] [[noninfringement]] in no event shall {{party:8}} be liable for any claim "
        "damages or other liability whether in an action of contract tort or otherwise arising from out "
        "of or in connection with the software or the use or other dealings in the software",
        "[[released]] [[licensed]] [[distributed]] under the [[terms of the]] mit license",
    ],
    "apache-2": [
        "[[copyright {{holder:20}}]] licensed under the apache license version 2 0 the license you may not "
        "use this {{object:2}} except in compliance with the license you may obtain a copy of the license "
        "at [[http]] [[https]] www apache org licenses license 2 0 unless required by applicable law or "
        "agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license",
        "licensed under the apache license version 2 [[0]] [[the license]]",
        "you may not use this {{object:2}} except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may not use this {{object:2}} except in compliance with the license "
        "you may obtain a copy of the license at https www apache org licenses license 2 0",
    ],
    "gpl": [
        "free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] "
        "[[affero]] general public license as published by the free software foundation either "
        "version {{version:2}} of the license or at your option any later version {{program:4}} is "
        "distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose see the gnu [[lesser]] "
        "[[affero]] general public license for more details you should have received a copy of the gnu "
        "[[lesser]] [[affero]] general public license along with {{program:4}} if not "
        "[[see [[http]] [[https]] [[www]] gnu org licenses]] [[write to the free software foundation]]",
        "licensed under the gnu [[lesser]] general public license [[as published by the free "
        "software foundation]] [[either]] version {{version:1}} [[of the license]] "
        "[[or at your option any later version]]",
        "under the terms of the gnu [[lesser]] general public license [[as published by the "
        "free software foundation]]",
    ],
    "bsd-2": [_BSD_GRANT + _BSD_DISCLAIMER],
    "bsd-3": [_BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER],
    "isc": [
        "[[isc license]] [[copyright {{holder:20}}]] permission to use copy modify and [[or]] distribute "
        "this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies the software is provided as "
        "is and {{author:8}} disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall {{author:8}} be liable for any "
        "special direct indirect or consequential damages or any damages whatsoever resulting from "
        "loss of use data or profits whether in an action of contract negligence or other tortious "
        "action arising out of or in connection with the use or performance of this software",
    ],
    "mpl-2": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
        "the mpl was not distributed with this file you can obtain one at [[http]] [[https]] [[www]] "
        "mozilla org mpl 2 0",
    ],
    "cc-by-nc": [
        "licensed under [[a]] [[the]] cc by nc [[sa]] [[nd]] {{version:2}}",
        "licensed under [[a]] [[the]] creative commons attribution noncommercial "
        "[[sharealike]] [[{{version:2}} international]] license",
    ],
    "cc-by": [
        "licensed under [[a]] [[the]] creative commons attribution {{version:2}} "
        "[[international]] license",
    ],
}

#: ASCII bytes that are no digit or lower-case letter separate words; A-Z are lowered.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


@dataclass(frozen=True)
class Automaton:
    """States 0..n: state i waits for ``words[i]`` (None: any word). ``after[i]`` are the
    states that may follow a match of state i, ``start`` those that may come first; state
    n accepts."""

    label: str
    words: tuple[bytes | None, ...]
    start: frozenset[int]
    after: tuple[frozenset[int], ...]

    @property
    def accept(self) -> int:
        return len(self.words)


def _parse(template: str) -> list:
    """Nested lists of items: a word, ("any", n), or ("optional", items)."""
    stack: list[list] = [[]]
    for token in re.findall(r"\[\[|\]\]|\{\{\w+:\d+\}\}|[^\s\[\]{}]+", template):
        if token == "[[":
            stack.append([])
        elif token == "]]":
            if len(stack) < 2:
                raise ValueError(f"]] without [[ in: {template}")
            items = stack.pop()
            stack[-1].append(("optional", items))
        elif token.startswith("{{"):
            stack[-1].append(("any", int(token[2:-2].split(":")[1])))
        else:
            stack[-1].append(token)
    if len(stack) != 1:
        raise ValueError(f"[[ without ]] in: {template}")
    return stack[0]


def compile_template(label: str, template: str) -> Automaton:
    words: list[bytes | None] = []
    follows: list[set[int]] = []

    def place(items: list, before: set[int]) -> set[int]:
        """Append the items; ``before`` are the states whose match they follow (-1: none).
        Returns the states after which what comes next may follow."""
        for item in items:
            if isinstance(item, tuple) and item[0] == "optional":
                before = before | place(item[1], before)
            elif isinstance(item, tuple):
                skipped = set(before)
                for _ in range(item[1]):
                    before = add(None, before)
                    skipped |= before
                before = skipped
            else:
                for word in item.encode().translate(_WORD_BYTES).split():
                    before = add(word, before)
        return before

    def add(word: bytes | None, before: set[int]) -> set[int]:
        state = len(words)
        words.append(word)
        follows.append(set())
        for b in before:
            (follows[b] if b >= 0 else first).add(state)
        return {state}

    first: set[int] = set()
    ends = place(_parse(template), {-1})
    if -1 in ends:
        raise ValueError(f"nothing mandatory in: {template}")
    for state in ends:
        follows[state].add(len(words))
    return Automaton(label, tuple(words), frozenset(first), tuple(map(frozenset, follows)))


class Scanner:
    """All automata together, entered by the words they can start with."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES,
                 phrases: dict[str, str] = PHRASES):
        self.automata = [compile_template(label, t) for label, ts in templates.items() for t in ts]
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases.items()]
        self.by_word: dict[bytes, list[tuple[Automaton, int]]] = defaultdict(list)
        for automaton in self.automata:
            for state in automaton.start:
                word = automaton.words[state]
                if word is None:
                    raise ValueError(f"{automaton.label}: a template starts with a free span")
                self.by_word[word].append((automaton, state))
        self.by_phrase: dict[bytes, list] = defaultdict(list)
        for words, label in self.phrases:
            self.by_phrase[words[0]].append((words, label))

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        return text.translate(_WORD_BYTES).split()

    def accepted(self, words: list[bytes], at: int, automaton: Automaton, state: int) -> int:
        """End of the longest accepted place that begins at ``at``, or 0."""
        live, end, i = {state}, 0, at
        while live and i < len(words):
            following: set[int] = set()
            for s in live:
                if automaton.words[s] is None or automaton.words[s] == words[i]:
                    following |= automaton.after[s]
            i += 1
            if automaton.accept in following:
                end = i
                following.discard(automaton.accept)
            live = following
        return end

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]],
                                         list[tuple[int, int, str]]]:
        """Number of words, places of the phrases, accepted places (start, end, label)."""
        words = self.words(text)
        base: list[tuple[int, int, str]] = []
        found: list[tuple[int, int, str]] = []
        starts = self.by_word.keys() | self.by_phrase.keys()
        if not starts.isdisjoint(words):
            reached: dict[int, int] = {}
            for i, word in enumerate(words):
                if word not in starts:
                    continue
                for phrase, label in self.by_phrase.get(word, ()):
                    if tuple(words[i:i + len(phrase)]) == phrase:
                        base.append((i, i + len(phrase), label))
                for automaton, state in self.by_word.get(word, ()):
                    end = self.accepted(words, i, automaton, state)
                    # Places are met by their start, so what ends no later lies inside.
                    if end > reached.get(id(automaton), 0):
                        reached[id(automaton)] = end
                        found.append((i, end, automaton.label))
        return len(words), base, found


def covered(places: list[tuple[int, int, str]]) -> int:
    """Words that stand in at least one place."""
    total, reached = 0, 0
    for start, end, _ in sorted(places):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] = TEMPLATES,
                  phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per document: id, n_words, base places, accepted places, score. Map-only."""
    place = "array<struct<start: bigint, stop: bigint, label: string>>"

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(templates, phrases)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()),
                                   ("label", pa.string())]))
        as_rows = lambda places: [{"start": a, "stop": b, "label": c} for a, b, c in places]
        for keys, texts in slices(batches):
            scanned = [scanner.scan(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([n for n, _, _ in scanned], pa.int64()),
                 pa.array([as_rows(b) for _, b, _ in scanned], kind),
                 pa.array([as_rows(f) for _, _, f in scanned], kind),
                 pa.array([covered(b + f) / n if n else 0.0 for n, b, f in scanned], pa.float64())],
                names=["id", "n_words", "base_places", "template_places", "score"])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, f"id bigint, n_words bigint, base_places {place}, "
                                f"template_places {place}, score double")
