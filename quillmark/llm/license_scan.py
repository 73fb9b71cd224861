"""Licence scan: a trained paragraph classifier with template comparison.

A paragraph is a run of lines without an empty one. Sums of weights over a text's
word n-grams, kept as running totals, score every line, every run of up to ``RUNS``
lines of a paragraph and every whole paragraph of more, so that wrapped notices are
seen whole whatever their length:

1. A sparse logistic regression on hashed word n-grams tells notices from other
   text. Every line and run is scored; those above the threshold go on.
2. A second one names the family. The notice counts as that family if its
   probability passes a threshold, enough of the n-grams of one of the family's
   templates, or of the notice, agree, those that no other family has are among
   them in proportion (all of them, for a template that is there nearly whole), and the agreement has two words in a row at least (or all of a
   template of one word). Otherwise it is ``unknown``, if it has ``WORDS`` words.
3. Of overlapping runs confirmed ones come first, then shorter ones, then earlier
   ones. A confirmed run that meets its own family only then adds those of its lines
   whose n-grams are mostly the family's. Neighbours of one family are joined to one
   notice.

Training rows are varied copies and fragments of the templates, and a random line of
each of about ``SAMPLE`` documents (expected, by a hash) that agrees with no
template, besides shuffled template words; notices with foreign names teach the
first model what notices have in common. Thresholds come from held-back rows:
``FALSE_SHARE`` of other lines may pass the first, ``LOST_SHARE`` of notices of
known families may fail the second.

Defined results: a text that is null or has no word has no licences; repeated rows
give repeated results; a null ``doc_id`` passes through; extra columns are ignored,
whatever their names; of equal probabilities the family listed first wins; an empty
table gives an empty result; lines are numbered from 0 by line feeds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import fit_softmax, row_sums, softmax
from .textblocks import CHAIN, blocks, lower_ascii, mix, prefix_hash, span_hash, utf8, words

WIDTH, ORDERS, RUNS, SAMPLE, COPIES = 1 << 16, (1, 2, 3), 8, 4000, 40
#: ``MARGIN``: log odds above the first threshold that a notice needs where no template confirms it.
FALSE_SHARE, LOST_SHARE, AGREE, MARGIN = 0.001, 0.02, 0.5, 2.0
#: Share of a template from which on every word of its own must be there, and n-grams of a short one, where that always holds.
WHOLE, SHORT = 0.6, 12
#: Words that a notice needs where no template confirms it.
WORDS = 4

#: Usual notices of public licences, by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0", "License: Apache 2.0", "License: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT License.", "License: MIT", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.", "License: ISC", "SPDX-License-Identifier: ISC",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only", "License: GPLv3", "GPLv3", "License: GPL-3.0", "Licensed under the GNU GPL version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "agpl": ["GNU Affero General Public License v3", "Licensed under the GNU Affero General Public License, version 3.", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-only"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Distributed under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause", "License: BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License 2.0", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released into the public domain under CC0 1.0."],
    "proprietary": ["All rights reserved.", "Copyright (c) All rights reserved. Unauthorized copying of this file is strictly prohibited."],
}


@dataclass
class Lines:
    """Of a block of texts: n-gram codes by order at each word, and by line its first word, paragraph, text and number."""

    codes: list[np.ndarray]
    first: np.ndarray
    paragraph: np.ndarray
    doc: np.ndarray
    number: np.ndarray

    def grams(self, a: int, b: int) -> np.ndarray:
        """Codes of the n-grams of words ``a`` to ``b``."""
        return np.concatenate([c[a : max(a, b - k + 1)] for k, c in zip(ORDERS, self.codes, strict=True)])


def read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    part = lower_ascii(data)
    tops = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(part == 10) + 1)
    tops = tops[tops < len(part)]
    start, end, first = words(part, np.append(tops, len(part)))
    word = span_hash(prefix_hash(part), start, end)
    doc = np.searchsorted(offsets, tops, "right") - 1
    count = np.diff(first)
    new = (count == 0) | np.concatenate([[True], (count[:-1] == 0) | (doc[1:] != doc[:-1])])[: len(count)]
    paragraph = np.cumsum(new)
    of_word = np.repeat(paragraph, count)
    codes, code = [], np.zeros(len(word), np.uint64)
    for k in ORDERS:
        m = max(0, len(word) - k + 1)
        code = mix(code[:m] * np.uint64(CHAIN) + word[k - 1 : k - 1 + m] + np.uint64(k))
        whole = np.zeros(len(word), np.uint64)
        whole[:m] = np.where(of_word[:m] == of_word[k - 1 : k - 1 + m], code, 0)
        codes.append(whole)
    number = np.arange(len(tops)) - np.searchsorted(doc, doc)
    return Lines(codes, first, paragraph, doc, number)


def _grams(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    lines = read_lines(raw, np.array([0, len(raw)]))
    return lines.grams(0, int(lines.first[-1]))


def _singles(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return read_lines(raw, np.array([0, len(raw)])).codes[0]


def _fit(rows: list[np.ndarray], y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    w, b = fit_softmax(np.concatenate([r % np.uint64(WIDTH) for r in rows]).astype(np.int64), ends, y, classes, WIDTH, steps=60)
    return w.astype(np.float32), b


@dataclass
class Scanner:
    names: list[str]
    notice: np.ndarray
    notice_bias: float
    family: np.ndarray
    family_bias: np.ndarray
    templates: list[list[np.ndarray]]
    #: Codes of two words in a row or more in any template, and of templates of one word.
    chains: np.ndarray
    #: For each template, its words without digits that no other family has.
    marks: list[list[np.ndarray]]
    least_notice: float = 0.0
    least_family: float = 0.0

    def notices(self, lines: Lines, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Log odds that words ``a`` to ``b`` are a notice."""
        total, size = np.zeros(len(a)), np.zeros(len(a))
        for k, codes in zip(ORDERS, lines.codes, strict=True):
            sums = np.concatenate([[0.0], np.cumsum(np.where(codes == 0, 0, self.notice[(codes % np.uint64(WIDTH)).astype(np.int64)]), dtype=np.float64)])
            end = np.maximum(a, b - k + 1)
            total += sums[end] - sums[a]
            size += end - a
        return total / np.sqrt(np.maximum(1, size)) + self.notice_bias

    def families(self, rows: list[np.ndarray]) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        slots = np.concatenate([r % np.uint64(WIDTH) for r in rows]).astype(np.int64)
        return softmax(row_sums(self.family[slots], ends) / np.sqrt(np.maximum(1, np.diff(ends)))[:, None] + self.family_bias)

    def agrees(self, row: np.ndarray, family: int) -> bool:
        """Whether a template of the family confirms the notice, and what only this family has is there in proportion."""
        own = np.unique(row)
        others = np.concatenate([np.zeros(0, np.uint64), *(t for k, v in enumerate(self.templates) if k != family for t in v)])
        for t, marks in zip(self.templates[family], self.marks[family], strict=True):
            both = np.intersect1d(own, t, assume_unique=True)
            if (len(both) >= WHOLE * len(t) or len(t) <= SHORT) and len(np.setdiff1d(marks, own)):
                continue  # all of it but what tells it apart: another licence in the same words
            if len(both) >= AGREE * min(len(own), len(t)):
                alone = np.setdiff1d(t, others)
                if len(np.intersect1d(both, alone)) * len(t) >= AGREE * len(both) * len(alone) and len(np.intersect1d(both, self.chains)):
                    return True
        return False

    def mostly(self, row: np.ndarray, name: str) -> bool:
        """Whether at least ``AGREE`` of a line's n-grams are in templates of the family."""
        return len(row) > 0 and bool(np.isin(row, np.concatenate(self.templates[self.names.index(name)])).mean() >= AGREE)

    def classify(self, lines: Lines) -> list[tuple[int, int, int, str]]:
        """Text number, first and last line, and family of each notice."""
        start, stop = [], []
        for n in range(1, RUNS + 1):
            i = np.arange(max(0, len(lines.paragraph) - n + 1))
            i = i[(lines.paragraph[i] == lines.paragraph[i + n - 1]) & (lines.first[i + n] > lines.first[i])]
            start.append(i)
            stop.append(i + n)
        top = np.flatnonzero(np.diff(lines.paragraph, prepend=-1))
        end = np.append(top[1:], len(lines.paragraph))
        long = end - top > RUNS
        start, stop = np.concatenate([*start, top[long]]), np.concatenate([*stop, end[long]])
        odds = self.notices(lines, lines.first[start], lines.first[stop])
        good = np.flatnonzero(odds >= self.least_notice)
        found = []
        for k in range(0, len(good), 1000):
            part = good[k : k + 1000]
            rows = [lines.grams(lines.first[start[i]], lines.first[stop[i]]) for i in part]
            for i, row, p in zip(part, rows, self.families(rows), strict=True):
                best = int(p.argmax())
                sure = p[best] >= self.least_family and self.agrees(row, best)
                if sure or (odds[i] >= self.least_notice + MARGIN and lines.first[stop[i]] - lines.first[start[i]] >= WORDS):
                    found.append((not sure, int(stop[i] - start[i]), int(start[i]), self.names[best] if sure else "unknown"))
        taken: dict[int, str] = {}
        for _, n, i, name in sorted(found):
            if not any(j in taken for j in range(i, i + n)):
                taken |= dict.fromkeys(range(i, i + n), name)
        for unsure, n, i, name in sorted(found):
            if not unsure and {taken[j] for j in range(i, i + n) if j in taken} == {name}:
                taken |= {j: name for j in range(i, i + n) if j not in taken and self.mostly(lines.grams(int(lines.first[j]), int(lines.first[j + 1])), name)}
        out: list[tuple[int, int, int, str]] = []
        for j, name in sorted(taken.items()):
            d, at = int(lines.doc[j]), int(lines.number[j])
            if out and out[-1][0] == d and out[-1][2] == at - 1 and out[-1][3] == name:
                out[-1] = (d, out[-1][1], at, name)
            else:
                out.append((d, at, at, name))
        return out


def train_scanner(docs: DataFrame, sample: int = SAMPLE, known: dict[str, list[str]] = TEMPLATES) -> Scanner:
    rng = np.random.default_rng(7)
    templates = [[np.unique(_grams(x)) for x in v] for v in known.values()]
    rows, y = [], []
    for k, texts in enumerate(known.values()):
        for x in texts:
            for i in range(COPIES):
                w = x.split()
                if i % 2 and len(w) > 8:  # as a wrapped line has it
                    a = int(rng.integers(0, len(w) - 7))
                    w = w[a : a + int(rng.integers(7, len(w) + 1))]
                if i:
                    w = [t for t in w if rng.random() > 0.06] or w
                    w = [f"word{rng.integers(1 << 30)}" for _ in range(rng.integers(0, 3))] + w + [f"word{rng.integers(1 << 30)}" for _ in range(rng.integers(0, 4))]
                rows.append(_grams(" ".join(w)))
                y.append(k)
    # notices of no known family: words that few families share give way to others
    common = {w for w, n in Counter(w for v in known.values() for w in {w.lower() for x in v for w in x.split()}).items() if n > 2}
    foreign = [_grams(" ".join(w if w.lower() in common or rng.random() < 0.3 else f"word{rng.integers(1 << 30)}" for w in x.split())) for v in known.values() for x in v if len({w.lower() for w in x.split()} & common) > 2 for _ in range(COPIES // 4)]
    vocabulary = sorted({w for v in known.values() for x in v for w in x.split()})
    others = [_grams(" ".join(rng.choice(vocabulary, rng.integers(2, 12)))) for _ in range(300)]
    others += [_grams(" ".join(f"word{rng.integers(1 << 30)}" for _ in range(rng.integers(1, 30)))) for _ in range(300)]
    others += [g for g in _other_lines(docs, sample) if max(len(np.intersect1d(g, t, assume_unique=False)) / len(t) for v in templates for t in v) < 0.3]
    held = np.arange(len(rows)) % 5 == 0
    apart = np.arange(len(others)) % 5 == 0
    pick = lambda xs, mask: [x for x, m in zip(xs, mask, strict=True) if m]
    y = np.array(y)
    w, b = _fit([*pick(rows, ~held), *foreign, *pick(others, ~apart)], np.array([1] * (int((~held).sum()) + len(foreign)) + [0] * int((~apart).sum())), 2)
    v, c = _fit(pick(rows, ~held), y[~held], len(known))
    chains = [np.setdiff1d(_grams(x), _singles(x)) if len(x.split()) > 1 else _grams(x) for v in known.values() for x in v]
    singles = [[np.unique(_singles(" ".join(w for w in x.split() if not any(c.isdigit() for c in w)) or x)) for x in v] for v in known.values()]
    marks = [[np.setdiff1d(t, np.concatenate([u for j, other in enumerate(singles) if j != k for u in other])) for t in v] for k, v in enumerate(singles)]
    model = Scanner(list(known), w[:, 1] - w[:, 0], float(b[1] - b[0]), v, c, templates, np.unique(np.concatenate(chains)), marks)
    odds = lambda xs: np.array([(model.notice[(x % np.uint64(WIDTH)).astype(np.int64)].sum() / np.sqrt(max(1, len(x))) + model.notice_bias) for x in xs])
    model.least_notice = max(0.0, float(np.quantile(odds(pick(others, apart)), 1 - FALSE_SHARE)))
    p = model.families(pick(rows, held))
    model.least_family = float(np.quantile(p[np.arange(len(p)), y[held]], LOST_SHARE))
    return model


def _other_lines(docs: DataFrame, sample: int) -> list[np.ndarray]:
    """n-grams of a random line of each sampled text."""
    share = min(1.0, sample / max(1, docs.count()))
    text = F.coalesce("text", F.lit(""))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.octet_length(text), F.lit(19)), F.lit(1_000_000)) < int(share * 1_000_000)).select(F.col("doc_id").cast("long"), text.alias("text"))

    def one_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, x in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                lines = [line for line in x.split("\n") if line.strip()]
                if lines:
                    g = _grams(lines[hash((doc, len(lines))) % len(lines)])
                    if len(g):
                        found.append(g.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["g"])

    return [np.frombuffer(x, np.uint64) for x in sorted(bytes(r["g"]) for r in some.mapInArrow(one_line, "g binary").collect())]


def scan(docs: DataFrame, model: Scanner | None = None) -> DataFrame:
    """``doc_id, n_licenses`` (notices), ``families`` (sorted, distinct, comma-joined) and ``lines`` (``first:family`` or ``first-last:family``)."""
    model = model or train_scanner(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, families, lines = [0] * batch.num_rows, [""] * batch.num_rows, [""] * batch.num_rows
            data, offsets = utf8(batch.column("text"))
            for first, last in blocks(offsets):
                of: dict[int, list] = {}
                for d, a, b, family in model.classify(read_lines(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])):
                    of.setdefault(d, []).append((a, b, family))
                for d, found in of.items():
                    n[first + d] = len(found)
                    families[first + d] = ",".join(sorted({f for _, _, f in found}))
                    lines[first + d] = ",".join(f"{a}:{f}" if a == b else f"{a}-{b}:{f}" for a, b, f in found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(families, pa.string()), pa.array(lines, pa.string())], ["doc_id", "n_licenses", "families", "lines"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_licenses long, families string, lines string")
