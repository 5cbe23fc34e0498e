"""License scans by conditional compression.

1. Texts are read as words (runs of letters and digits, lowered). Where words form a trigram
   of some template, the text may quote it: trigram hits at most ``gap`` words apart make one
   candidate block, with ``margin`` words around them. The gap is at least what the tolerance
   can bring about: with an inserted word after every two, d differences part trigrams by
   3 d + 1 words. Blocks need no line structure, so a notice inside a long line or wrapped
   over many lines is one block.
2. A block is compressed as it is and with each template as a zstandard raw dictionary. What
   the dictionary saves, as a share of the plain size, ranks the templates. All are ranked
   that can have a copy there: n words with d differences keep n - 2 - 3 d trigrams, and so
   many must begin within the words that a copy can take, which may lie around the block.
   (From a tolerance of a third or so, copies without any trigram can be; they go unseen.)
3. All ranked templates are confirmed by their exact wording, copy by copy: a template is
   aligned with the stretch that ends at each of these words, and a copy is where the
   fewest ``missing`` (of the template) and ``extra`` (between the aligned ones) words are at
   most ``tolerance`` per template word. Of overlapping copies the one with the most aligned
   words less differences wins; what is left around the copies is scanned again.

Every whole text is scanned in Spark tasks, row by row; there is no shuffle.

Defined cases: null and empty texts have no findings. Rows are scanned one by one, repeated
or not. Equal reductions go by the template's name. An empty table gives an empty result.
Other columns are not touched.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.llm.common import text_bytes

# --- fixed values: wordings of common notices, by licence and form -----------------------
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT/short": "Released under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."
    ),
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "BSD/short": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "All-rights-reserved/short": "All rights reserved.",
}
# -----------------------------------------------------------------------------------------

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("template", T.StringType()),
        T.StructField("reduction", T.DoubleType()),
        T.StructField("missing", T.ArrayType(T.StringType())),
        T.StructField("extra", T.ArrayType(T.StringType())),
        T.StructField("exact", T.BooleanType()),
        T.StructField("wording", T.StringType()),
    ]
)


class Scanner:
    def __init__(self, templates: Mapping[str, str], gap: int, margin: int, winners: int, tolerance: float, level: int):
        self.margin = margin
        self.word = re.compile(rb"[0-9a-z\x80-\xff]+")
        self.names = sorted(templates)
        self.words = {n: self.word.findall(templates[n].encode().lower()) for n in self.names}
        if any(len(w) < 3 for w in self.words.values()):
            raise ValueError("a template needs three words")
        if not 0 <= margin < 3:
            raise ValueError("a margin is 0 to 2 words")
        self.trigrams: dict[tuple, list[str]] = {}
        for n in self.names:
            for t in set(zip(self.words[n], self.words[n][1:], self.words[n][2:])):
                self.trigrams.setdefault(t, []).append(n)
        self.most = {n: int(tolerance * len(w) + 1e-9) for n, w in self.words.items()}
        # the words of a copy reach 3 d words beyond its trigrams: no copy meets two blocks
        self.gap = max(gap, 3 * max(self.most.values(), default=0) + 3)
        self.places = {n: self._places(w) for n, w in self.words.items()}
        self.places_back = {n: self._places(w[::-1]) for n, w in self.words.items()}
        # a word that is in the middle of no trigram needs no further look
        self.middles = {t[1] for t in self.trigrams}
        how = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**how)
        self.given = {n: zstandard.ZstdCompressor(dict_data=self._dictionary(w), **how) for n, w in self.words.items()}

    @staticmethod
    def _dictionary(words: list[bytes]) -> zstandard.ZstdCompressionDict:
        return zstandard.ZstdCompressionDict(b" ".join(words), dict_type=zstandard.DICT_TYPE_RAWCONTENT)

    @staticmethod
    def _places(words: list[bytes]) -> dict[bytes, np.ndarray]:
        """Where each word is in a template, counted from 1."""
        return {w: np.array([i for i, x in enumerate(words, 1) if x == w]) for w in words}

    def hits(self, words: list[bytes]) -> list[int]:
        """Where trigrams of templates begin."""
        middles, trigrams = self.middles, self.trigrams
        return [i for i, w in enumerate(words[1:-1]) if w in middles and (words[i], w, words[i + 2]) in trigrams]

    def next_block(self, hits: list[int], lo: int, hi: int) -> tuple[int, int] | None:
        """The first block within the words [lo, hi)."""
        at = bisect_left(hits, lo)
        if at == len(hits) or hits[at] + 3 > hi:
            return None
        last = at
        while last + 1 < len(hits) and hits[last + 1] - hits[last] <= self.gap and hits[last + 1] + 3 <= hi:
            last += 1
        return max(lo, hits[at] - self.margin), min(hi, hits[last] + 3 + self.margin)

    def stretches(self, words: list[bytes], hits: list[int], a: int, b: int, lo: int, hi: int) -> dict[str, list[list[int]]]:
        """[start, end) of the words within [lo, hi) that copies of each template with trigrams
        in the block [a, b) can take."""
        begins: dict[str, list[int]] = {}
        for at in hits[bisect_left(hits, a) : bisect_left(hits, b - 2)]:
            for name in self.trigrams[tuple(words[at : at + 3])]:
                begins.setdefault(name, []).append(at)
        out: dict[str, list[list[int]]] = {}
        for name, at in begins.items():
            n, most = len(self.words[name]), self.most[name]
            least, span = max(1, n - 2 - 3 * most), n + most - 3
            for first, last in zip(at, at[least - 1 :]):
                if last - first <= span:
                    start, end = max(lo, last - span), min(hi, first + span + 3)
                    mine = out.setdefault(name, [[start, end]])
                    if start <= mine[-1][1]:
                        mine[-1][1] = end
                    else:
                        mine.append([start, end])
        return out

    def ranked(self, block: bytes, names: Iterable[str]) -> list[tuple[float, str]]:
        """(reduction, template), best first."""
        size = len(self.plain.compress(block))
        saved = [(1 - len(self.given[n].compress(block)) / size, n) for n in names]
        return sorted(saved, key=lambda s: (-s[0], s[1]))

    @staticmethod
    def _column(before: np.ndarray, places: np.ndarray | None, steps: np.ndarray, first: int) -> np.ndarray:
        """Differences of each beginning of a template after one more word of the text."""
        column = before + 1
        column[0] = first
        if places is not None:
            column[places] = np.minimum(column[places], before[places - 1])
        return np.minimum.accumulate(column - steps) + steps

    def aligned(self, name: str, words: list[bytes], end: int) -> tuple[int, list[bytes], list[bytes]]:
        """(start, missing, extra) of the template's copy that ends before the word ``end``."""
        own, places = self.words[name], self.places_back[name]
        n = len(own)
        steps = np.arange(n + 1)
        columns = [steps]
        for j in range(1, min(end, n + self.most[name]) + 1):
            columns.append(self._column(columns[-1], places.get(words[end - j]), steps, j))
        i, j = n, min(range(len(columns)), key=lambda k: (columns[k][n], -k))
        start, missing, extra = end - j, [], []
        while i or j:
            if i and j and own[n - i] == words[end - j] and columns[j][i] == columns[j - 1][i - 1]:
                i, j = i - 1, j - 1
            elif i and columns[j][i] == columns[j][i - 1] + 1:
                missing.append(own[n - i])
                i -= 1
            else:
                extra.append(words[end - j])
                j -= 1
        return start, missing, extra

    def copies(self, name: str, words: list[bytes]) -> list[tuple[int, int, list[bytes], list[bytes]]]:
        """(start, end, missing, extra) of the copies of a template that don't overlap, taken by
        fewest differences; the time grows with the number of words."""
        n, most, places = len(self.words[name]), self.most[name], self.places[name]
        steps = np.arange(n + 1)
        column, fewest = steps, [n]
        for w in words:
            column = self._column(column, places.get(w), steps, 0)
            fewest.append(int(column[n]))
        # a stretch with one difference more than without its last word ends there
        ends = [e for e in range(1, len(fewest)) if fewest[e] <= most and fewest[e] <= fewest[e - 1]]
        found: list[tuple[int, int, list[bytes], list[bytes]]] = []
        for end in sorted(ends, key=lambda e: (fewest[e], -e)):
            before = bisect_left(found, (end,)) - 1
            free = found[before][1] if before >= 0 else 0
            if end - (n - most) >= free:  # a copy has so many words at least
                start, missing, extra = self.aligned(name, words, end)
                if start >= free:
                    insort(found, (start, end, missing, extra))
        return found

    def findings(self, words: list[bytes]) -> Iterator[tuple]:
        hits = self.hits(words)
        todo = [(0, len(words))] if hits else []
        while todo:
            lo, hi = todo.pop()
            if (block := self.next_block(hits, lo, hi)) is None:
                continue
            a, b = block
            stretches = self.stretches(words, hits, a, b, lo, hi)
            won = []
            for reduction, name in self.ranked(b" ".join(words[a:b]), stretches) if stretches else []:
                for at, to in stretches[name]:
                    for start, end, missing, extra in self.copies(name, words[at:to]):
                        kept = len(self.words[name]) - 2 * len(missing) - len(extra)
                        won.append((-kept, -reduction, name, at + start, at + end, missing, extra))
            taken: list[tuple[int, int]] = []
            for _, reduction, name, start, end, missing, extra in sorted(won):
                before = bisect_left(taken, (end,)) - 1
                if before < 0 or taken[before][1] <= start:
                    insort(taken, (start, end))
                    yield start, end - start, name, -reduction, missing, extra, not missing and not extra, b" ".join(words[start:end])
            if taken:
                todo += zip([e for _, e in taken] + [lo], [s for s, _ in taken[1:]] + [hi, taken[0][0]])
            else:
                todo.append((b - self.margin, hi))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    gap: int = 12,
    margin: int = 2,
    winners: int = 3,
    tolerance: float = 0.15,
    level: int = 3,
) -> DataFrame:
    """(id, at, n_words, template, reduction, missing, extra, exact, wording): one row per
    confirmed notice, ``at`` being the number of its first word. ``winners`` is accepted from
    former calls and limits nothing: every template that can have a copy is tried."""
    templates = dict(templates)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, gap, margin, winners, tolerance, level)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(), pa.string()]
        said = lambda words: [w.decode() for w in words]
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                for at, n, name, reduction, missing, extra, exact, wording in scanner.findings(scanner.word.findall(text.lower())):
                    out.append((i, at, n, name, reduction, said(missing), said(extra), exact, wording.decode()))
            cols = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], SCHEMA.names)

    return rows.mapInArrow(run, SCHEMA)
