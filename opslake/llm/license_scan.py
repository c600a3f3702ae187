"""Licence scan with a generalised suffix automaton of licence words.

The automaton holds every substring (in words) of all templates. A text is
streamed through it: after each word its state and length are the longest
suffix read so far that occurs in a template (the matching statistics). Long
matches that cannot be extended are chained, template by template, into spans
that cover the template in order with small gaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.textkit import ALNUM, Texts, hash_words, lower_ascii, slices, texts_of, words_of

#: words of a long match (a shorter template: all of it), words a chain may skip
LONG, GAP = 4, 8
#: part of a template that a chain must cover to give its label
COVERED = 0.75

# fixed values: phrases that label a text wherever they stand
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: wording by which licences are granted or named, with the label each gives
TEMPLATES = [
    ("mit", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("proprietary", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    # whole licence texts and notices
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the software the software is "
            "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
            "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
            "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
            "arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
            "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
            "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
            "with the distribution this software is provided by the copyright holders and contributors as is and any express or "
            "implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct "
            "indirect incidental special exemplary or consequential damages including but not limited to procurement of "
            "substitute goods or services loss of use data or profits or business interruption however caused and on any theory "
            "of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out "
            "of the use of this software even if advised of the possibility of such damage"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies the software is provided as "
            "is and the author disclaims all warranties with regard to this software including all implied warranties of "
            "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential "
            "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
            "negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
            "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
            "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
            "restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original "
            "software if you use this software in a product an acknowledgment in the product documentation would be appreciated "
            "but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being "
            "the original software 3 this notice may not be removed or altered from any source distribution"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
            "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
            "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
            "software is furnished to do so all subject to the following"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
            "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
            "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
            "without warranties or conditions of any kind either express or implied see the license for the specific language "
            "governing permissions and limitations under the license"),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version 2 of the license or at your option any later "
            "version this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more "
            "details"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version 3 of the license or at your option any later "
            "version"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
            "use compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
            "commercial or non commercial and by any means"),
]


@dataclass
class Automaton:
    """Suffix automaton over several word sequences."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    #: (template, position after the last word) of the prefixes that end in a state
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _state(self, step: dict[int, int], size: int) -> int:
        self.step.append(step)
        self.link.append(0)
        self.size.append(size)
        self.ends.append([])
        return len(self.step) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of q for strings one longer than p's; p's transitions lead to it."""
        copy = self._state(dict(self.step[q]), self.size[p] + 1)
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        q = self.step[last].get(word)
        if q is not None:  # the prefix already occurs in an earlier sequence
            return q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
        new, p = self._state({}, self.size[last] + 1), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
        return new

    def add(self, words: list[int], number: int) -> None:
        last = 0
        for at, word in enumerate(words):
            last = self._extend(last, word)
            self.ends[last].append((number, at + 1))

    def close(self) -> None:
        """Every state gets the ends of all longer strings it is a suffix of."""
        for v in sorted(range(1, len(self.size)), key=lambda v: -self.size[v]):
            self.ends[self.link[v]].extend(self.ends[v])
        self.ends[0] = []

    def advance(self, state: int, length: int, word: int) -> tuple[int, int]:
        while state and word not in self.step[state]:
            state = self.link[state]
            length = self.size[state]
        if word in self.step[state]:
            return self.step[state][word], length + 1
        return 0, 0


class Scanner:
    """Templates and phrases in one automaton; the phrases are numbered after the templates."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        texts = [t for _, t in templates] + list(phrases)
        self.labels = [label for label, _ in templates] + list(phrases.values())
        self.base = len(templates)
        vocabulary = sorted({w for t in texts for w in t.split()})
        column = pa.array(vocabulary, pa.string())
        t = texts_of(column)
        hashes = hash_words(t.data, words_of(t, ALNUM))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int64)
        number = {w: i for i, w in enumerate(vocabulary)}
        self.words = [[number[w] for w in t.split()] for t in texts]
        self.automaton = Automaton()
        for i, seq in enumerate(self.words):
            self.automaton.add(seq, i)
        self.automaton.close()
        v = len(vocabulary)
        self.pairs = np.unique([a * v + b for seq in self.words for a, b in zip(seq, seq[1:])] or [-1])
        self.short = np.unique([seq[0] * v + seq[1] for seq in self.words if len(seq) == 2] or [-1])
        self.single = np.unique([seq[0] for seq in self.words if len(seq) == 1] or [-1])
        # by state: phrases that are a suffix of its longest string
        self.phrase_ends = [[(n, len(self.words[n])) for n, end in e if n >= self.base and end == len(self.words[n])]
                            for e in self._suffix_ends()]

    def _suffix_ends(self) -> list[list[tuple[int, int]]]:
        """By state: whole sequences among the suffixes of its longest string."""
        a = self.automaton
        own: list[list[tuple[int, int]]] = [[] for _ in a.size]
        for n, seq in enumerate(self.words):
            state = 0
            for w in seq:
                state = a.step[state][w]
            own[state].append((n, len(seq)))
        for v in sorted(range(1, len(a.size)), key=lambda v: a.size[v]):
            own[v] = own[v] + own[a.link[v]]
        return own

    def runs(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of words that can hold a match: each two neighbours stand side
        by side in a template, and there are three words or a whole short one."""
        n = len(words)
        v = len(self.ids)
        known = words >= 0
        code = np.full(n, -2, np.int64)
        code[:-1] = np.where(known[:-1] & known[1:], words[:-1] * v + words[1:], -2)
        code[first[1:][first[1:] > 0] - 1] = -2  # not from one text to the next
        joined = np.isin(code, self.pairs)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype(np.int8)))
        begin, end = edge[::2], edge[1::2] + 1
        keep = (end - begin >= 3) | np.isin(code[begin], self.short)
        out = list(zip(begin[keep].tolist(), end[keep].tolist()))
        if self.single[0] >= 0:
            inside = np.zeros(n + 1, bool)
            for a, b in out:
                inside[a:b] = True
            out += [(i, i + 1) for i in np.flatnonzero(np.isin(words, self.single) & ~inside[:n]).tolist()]
        return out

    def scan(self, words: list[int], at: int):
        """Phrase places and long matches of one run that begins at word ``at``:
        [(phrase, start)], [(template, template start, start, end)]."""
        a = self.automaton
        state = length = 0
        places, matches = [], []
        for i, w in enumerate(words):
            state, length = a.advance(state, length, w)
            places += [(n, at + i + 1 - k) for n, k in self.phrase_ends[state] if k <= length]
            longer = i + 1 < len(words) and words[i + 1] in a.step[state]  # nothing is dropped from its front
            if not longer:
                for n, end in a.ends[state]:
                    if length >= min(LONG, len(self.words[n])):
                        matches.append((n, end - length, at + i + 1 - length, at + i + 1))
        return places, matches

    def chains(self, matches: list[tuple[int, int, int, int]]) -> tuple[list[tuple[str, int, int, float]], float]:
        """Matches of each template in order, with gaps of at most GAP words in the
        text: (label, start, end, part of the template covered) of the chains that cover enough,
        and the largest part covered by any chain. Words by which a match overlaps
        the one before it are trimmed from its front. A chain is done once the
        gap after it has passed, so only those that end in the last GAP words are open."""
        out, most = [], 0.0
        by_template: dict[int, list[tuple[int, int, int, int]]] = {}
        for m in matches:
            by_template.setdefault(m[0], []).append(m)
        for n in sorted(by_template):
            size = len(self.words[n])
            spans: dict[int, tuple[int, float]] = {}
            best: list[tuple[int, int, int, int]] = []  # open chains: template end, text start, text end, covered

            def done(chains):
                for _, start, end, covered in chains:
                    if covered >= COVERED * size:
                        spans[start] = max(spans.get(start, (0, 0.0)), (end, min(1.0, covered / size)))

            for _, t, start, end in sorted(by_template[n], key=lambda m: (m[2], m[1])):
                done(c for c in best if start - c[2] > GAP)
                best = [c for c in best if start - c[2] <= GAP]
                fits = [c for c in best if c[2] < end and c[0] <= t + max(0, c[2] - start)]
                c = max(fits, key=lambda c: c[3] - max(0, c[2] - start), default=None)
                best.append((t + end - start, c[1] if c else start, end, c[3] + end - max(start, c[2]) if c else end - start))
                most = max(most, min(1.0, best[-1][3] / size))
            done(best)
            out += [(self.labels[n], s, e, c) for s, (e, c) in spans.items()]
        return out, most


def _scan_texts(scanner: Scanner, texts: Texts):
    """For each text: number of words, base places [(label, start)], spans, largest part of a template covered."""
    data = lower_ascii(texts.data)
    words = words_of(Texts(data, texts.starts, texts.null), ALNUM)
    hashes = hash_words(data, words)
    near = np.searchsorted(scanner.hashes, hashes) % len(scanner.hashes)
    ids = np.where(scanner.hashes[near] == hashes, scanner.ids[near], -1)
    found: dict[int, tuple[list, list]] = {}
    if len(ids):
        for a, b in scanner.runs(ids, words.first):
            doc = int(np.searchsorted(words.first, a, side="right")) - 1
            places, matches = scanner.scan(ids[a:b].tolist(), a - int(words.first[doc]))
            mine = found.setdefault(doc, ([], []))
            mine[0].extend(places)
            mine[1].extend(matches)
    for i in range(len(texts)):
        places, matches = found.get(i, ((), ()))
        base = sorted({(scanner.labels[n], start) for n, start in places}, key=lambda p: (p[1], p[0]))
        spans, most = scanner.chains(matches)
        yield int(words.first[i + 1] - words.first[i]), base, sorted(spans, key=lambda s: (s[1], s[0], s[2])), most


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, spans array<struct<label:string,first_word:long,end_word:long,covered:double>>")


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None,
                 phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and spans (label, first_word, end_word, covered) for each row of ``docs``.

    Words are the maximal runs of a-z, 0-9 and characters from U+0080, A-Z
    lower-cased. Base: places where a phrase's words stand consecutively.
    labels: base labels and those of chains that cover at least three quarters
    of a template; score: the largest part of a template or phrase covered by a chain
    (0: none), also where it is too small for a label.
    Null and empty texts have no words, empty label strings, null places and
    score 0. Repeated rows each get a row, null doc_ids stay null, other columns
    are ignored; an empty table gives an empty one. Nothing is shuffled.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in slices(batches, 1):
            rows = []
            for n, base, spans, most in _scan_texts(scanner, texts_of(batch.column(1))):
                names = {label for label, _ in base}
                rows.append((n, len(base), base[0][1] if base else None, base[-1][1] if base else None,
                             ",".join(sorted(names)), ",".join(sorted(names | {s[0] for s in spans})),
                             1.0 if base else most,
                             [dict(zip(("label", "first_word", "end_word", "covered"), s)) for s in spans]))
            cols = list(zip(*rows)) or [()] * 8
            span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()),
                                       ("covered", pa.float64())]))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, _SCHEMA))
