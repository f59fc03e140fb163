"""License scan by template-markup matching.

A template is wording with marked regions: [[...]] may be missing, {{a-b}} stands for a to b words of any kind, {{x|y z}}
for one of the wordings given. Each template is compiled to an automaton over words; a text is accepted where every word
outside the marked regions stands exactly as given. Texts are searched for each template's anchor (its longest fixed run
of words, by hash, a whole batch at once); the automaton runs only around anchors, at a bounded distance.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lowered. A null or empty text has no words, no labels and score 0.
Repeated rows are judged alike; a label is given once however often it is found; a match within a longer one counts for
nothing; very long texts are scanned whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from llm.frames import map_texts
from llm.packed import member
from llm.words import Piece, gram_hashes, lower_word_table, split, word_hashes

# fixed values: phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: paragraphs that two of the notices below share
BSD_START = """redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met [[1]] redistributions of source code must retain the above copyright notice
        this list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above
        copyright notice this list of conditions and the following disclaimer in the documentation and or other materials
        provided with the distribution """
BSD_NAMES = """[[3]] neither the name of {{1-12}} nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission """
BSD_END = """this software is provided by {{1-12}} as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall
        {{1-12}} be liable for any direct indirect incidental special exemplary or consequential damages including but not
        limited to procurement of substitute goods or services loss of use data or profits or business interruption however
        caused and on any theory of liability whether in contract strict liability or tort including negligence or
        otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""

# fixed values: wording of well-known notices to their last mandatory paragraph, with the parts that vary marked; what is
# only a part of one has a label of its own
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[,]] version 2.0 [[the license you may not use this file except in compliance with the license]]",
    "mit-notice": "[[this {{work|software|project}} is]] {{released|licensed|distributed}} under the [[terms of the]] mit license",
    "gpl-notice": "{{licensed|released|distributed}} under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[either]] version {{2|3}} [[of the license]] [[or at your option any later version]]",
    "lgpl-notice": "under the [[terms of the]] gnu {{lesser|library}} general public license [[as published by the free software foundation]] [[either]] version {{2 1|2|3}}",
    "cc-by-4.0": "licensed under [[a]] {{cc by|creative commons attribution}} {{4 0|4 0 international license}}",
    "cc-by-nc": "licensed under [[a]] {{cc by nc|creative commons attribution noncommercial}} [[{{sa|nd|sharealike|noderivatives|noderivs}}]] [[{{1 0|2 0|2 5|3 0|4 0}} [[international]] [[license]]]]",
    "cc-by-sa": "licensed under [[a]] {{cc by sa|creative commons attribution sharealike}} [[{{1 0|2 0|2 5|3 0|4 0}} [[international]] [[license]]]]",
    "cc0-1.0": "{{dedicated|released|placed}} {{to|into}} the public domain [[under]] [[cc0 [[1 0 universal]]]]",
    "reserved-notice": "copyright [[c]] {{1-8}} all rights reserved",
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions the above copyright
        notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial
        portions of the software the software is provided as is without warranty of any kind express or implied including
        but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no
        event shall the {{authors or copyright holders|copyright holders or authors|authors}} be liable for any claim
        damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
        with the software or the use or other dealings in the software""",
    "mit-grant": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so""",
    "isc": """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies the
        software is provided as is and {{1-8}} {{disclaims|disclaim}} all warranties with regard to this software
        including all implied warranties of merchantability and fitness in no event shall {{1-8}} be liable for any special
        direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits
        whether in an action of contract negligence or other tortious action arising out of or in connection with the use
        or performance of this software""",
    "isc-grant": """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies""",
    "bsd-2-clause": BSD_START + BSD_END,
    "bsd-3-clause": BSD_START + BSD_NAMES + BSD_END,
    "bsd-conditions": BSD_START,
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> list[bytes]:
    """The words of a text, as the scan sees them."""
    return text.encode().translate(lower_word_table().tobytes()).split()


@dataclass
class Automaton:
    """steps: per state, (word or None for any, next state); done: the accepting states; all reached without reading are
    included. anchor: fixed words that every match holds; before: most words that can stand in front of them."""

    label: str
    steps: list[list[tuple[bytes | None, int]]]
    start: frozenset[int]
    done: frozenset[int]
    anchor: list[bytes]
    before: int

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match that starts at a word; -1 if none does."""
        states, end = self.start, -1
        for i in range(at, len(words)):
            states = frozenset(t for s in states for w, t in self.steps[s] if w is None or w == words[i])
            if not states:
                break
            if states & self.done:
                end = i + 1
        return end


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template; raises ValueError where brackets do not pair or nothing is fixed."""
    edges: list[list[tuple[bytes | None, int]]] = [[]]
    free: list[set[int]] = [set()]  # states reached without reading a word

    def new() -> int:
        edges.append([]), free.append(set())
        return len(edges) - 1

    def read(state: int, word: bytes | None) -> int:
        edges[state].append((word, target := new()))
        return target

    runs: list[tuple[list[bytes], int]] = [([], 0)]  # fixed runs outside marked regions, and the most words before each
    state, most, opened = 0, 0, []
    for token in re.findall(r"\[\[|\]\]|\{\{.*?\}\}|(?:(?!\[\[|\]\]|\{\{|\}\}).)+", markup, re.S):
        if token == "[[":
            opened.append(state)
            runs.append(([], most))
        elif token == "]]":
            if not opened:
                raise ValueError(f"{label}: ]] without [[")
            free[opened.pop()].add(state)
            runs.append(([], most))
        elif token.startswith("{{"):
            body = token[2:-2]
            if m := re.fullmatch(r"(\d+)-(\d+)", body):
                low, high = int(m[1]), int(m[2])
                ends = [state]
                for _ in range(high):
                    ends.append(read(ends[-1], None))
                join = new()
                for e in ends[low:]:
                    free[e].add(join)
                most += high
            else:
                join, ways = new(), [words_of(w) for w in body.split("|")]
                for way in ways:
                    at = state
                    for word in way:
                        at = read(at, word)
                    free[at].add(join)
                most += max(map(len, ways))
            state = join
            runs.append(([], most))
        else:
            for word in words_of(token):
                state = read(state, word)
                most += 1
                if not opened:
                    runs[-1][0].append(word)
    if opened:
        raise ValueError(f"{label}: [[ without ]]")
    anchor, before = max(runs, key=lambda r: len(r[0]))
    if not anchor:
        raise ValueError(f"{label}: no fixed words")

    def closure(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in free[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return frozenset(seen)

    reach = [closure(s) for s in range(len(edges))]
    steps = [[e for t in reach[s] for e in edges[t]] for s in range(len(edges))]
    done = frozenset(s for s in range(len(edges)) if state in reach[s])
    return Automaton(label, steps, frozenset([0]), done, anchor, before)


def _outermost(matches: set[tuple[int, int, str]]) -> set[tuple[int, int, str]]:
    """Matches but those within a longer one: the longest template that stands in a place names it."""
    return {m for m in matches if not any(o[0] <= m[0] and m[1] <= o[1] and o[1] - o[0] > m[1] - m[0] for o in matches)}


def _hash(words: list[bytes]) -> np.uint64:
    text = pa.array([b" ".join(words).decode()], pa.large_string())
    piece = split(text, lower_word_table())
    return gram_hashes(word_hashes(piece), piece.first, len(words))[0][0]


class Scanner:
    """Phrases and templates, ready for whole batches."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [(words_of(k), v) for k, v in phrases.items()]
        self.automata = [compile_template(k, v) for k, v in templates.items()]
        self.wanted: dict[int, dict[int, list]] = {}
        for what, words in [*((p, p[0]) for p in self.phrases), *((a, a.anchor[:3]) for a in self.automata)]:
            by_hash = self.wanted.setdefault(len(words), {})
            by_hash.setdefault(int(_hash(words)), []).append((what, words))

    def scan(self, texts: pa.Array) -> list[list]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, one list each."""
        piece = split(texts, lower_word_table())
        h = word_hashes(piece)
        base: dict[int, list[tuple[int, int, str]]] = {}
        found: dict[int, set[tuple[int, int, str]]] = {}
        for length, by_hash in self.wanted.items():
            g, ok = gram_hashes(h, piece.first, length)
            keys = np.sort(np.array(list(by_hash), np.uint64))
            for at in np.flatnonzero(ok & member(g, keys)):
                i = int(piece.owner[at])
                for what, words in by_hash[int(g[at])]:
                    if any(piece.word(at + k) != w for k, w in enumerate(words)):
                        continue
                    if isinstance(what, Automaton):
                        found.setdefault(i, set()).update(self._match(what, piece, int(at), i))
                    else:
                        start = int(at - piece.first[i])
                        base.setdefault(i, []).append((start, start + length, what[1]))
        out: list[list] = [[] for _ in range(7)]
        for i, n in enumerate(np.diff(piece.first).tolist()):
            places, more = base.get(i, []), _outermost(found.get(i, set()))
            starts = [a for a, _, _ in places]
            own = sorted({x for _, _, x in places})
            covered = {k for a, b, _ in [*places, *more] for k in range(a, b)}
            row = [
                n, len(places), min(starts, default=None), max(starts, default=None), ",".join(own),
                ",".join(sorted({*own, *(x for _, _, x in more)})), len(covered) / n if n else 0.0,
            ]
            for column, value in zip(out, row):
                column.append(value)
        return out

    @staticmethod
    def _match(a: Automaton, piece: Piece, at: int, i: int):
        """Longest matches that hold the anchor found at a word of text i."""
        low, high = max(int(piece.first[i]), at - a.before), int(piece.first[i + 1])
        words = [piece.word(k) for k in range(low, min(high, at + len(a.steps) + 1))]
        base = low - int(piece.first[i])
        for start in range(at - low + 1):
            end = a.longest(words, start)
            if end >= at - low + len(a.anchor):
                yield base + start, base + end, a.label
                return


def report(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs.

    score: the share of a text's words that phrases and accepted templates cover."""
    scanner = Scanner(phrases, templates)
    longs = [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    texts = [T.StructField(c, T.StringType()) for c in ("base_labels", "labels")]
    fields = [*longs, *texts, T.StructField("score", T.DoubleType())]
    return map_texts(docs, lambda rows, part: scanner.scan(part), fields, ["doc_id"])
