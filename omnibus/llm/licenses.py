"""License scan: winnowed template fingerprints pick candidates, banded alignment reports coverage and spans.

The templates' word k-grams are hashed, and the smallest hash of every window of
k-grams is kept with its place: an inverted index from hash to (template,
place).  It goes with the plan, at most ``MAX_FINGERPRINTS`` at a time; more
templates are scanned in parts.  Every k-gram of every text is looked up; texts with
a hit, their words and hits go on to the alignment.

k and the window are each template's own (``plan``).  Of a template of n words,
m = floor((1 - coverage) n) may be missing or replaced, which leaves a run of at
least (n - m) / (m + 1) words in a row; for templates of up to ``SHORT`` words, m
added words are allowed for as well: (n - m) / (2 m + 1).  k + window - 1 is at
most that run, so a text with so many changes always shares a fingerprint.

Hits give diagonals (place in text minus place in template).  Around each bundle
of diagonals the template is aligned to the text in a band, locally; matched words
over all template words is the coverage.  Bands whose longest common subsequence
is too short for the coverage wanted are not aligned.  Where that finds nothing,
bands that reach over half a template's length of added words are tried.

Defined cases: NULL and short texts hit nothing.  A template of fewer than
``GRAM`` words is refused.  Of overlapping finds of one template the one around
more hits stays, then the first.  Equal rows are reported each.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.llm.common import shingle_hashes, words

#: Words of the longest k-gram, and the widest window.
GRAM = 4
WINDOW = 4
COVERAGE = 0.8
MAX_FINGERPRINTS = 100_000
_START, _PAIRED, _SKIPPED, _ADDED = range(4)
#: Templates of at most so many words have k-grams of three words at most.
SHORT = 20

# License notices and texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
}


def library() -> dict[str, str]:
    """``TEMPLATES`` and the full texts, headers and notices of ``license_texts``, by name."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return TEMPLATES | {f.stem: f.read_text(encoding="utf-8") for f in files}


def winnow(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Places of the fingerprints: the last smallest hash of each window, of the whole list if that is shorter."""
    places: list[int] = []
    for start in range(max(1, len(hashes) - window + 1)):
        stop = min(start + window, len(hashes))
        best = min(range(start, stop), key=lambda i: (hashes[i], -i))
        if not places or places[-1] != best:
            places.append(best)
    return places


def plan(n: int, coverage: float) -> tuple[int, int]:
    """(k, window) for a template of ``n`` words."""
    m = math.floor((1 - coverage) * n + 1e-9)
    run = max(1, math.ceil((n - m) / (2 * m + 1 if n <= SHORT else m + 1)))
    k = min(run, 3 if n <= SHORT else GRAM)
    return k, min(run - k + 1, WINDOW)


def index(
    spark: SparkSession, templates: dict[str, str], coverage: float = COVERAGE
) -> tuple[dict[str, list[str]], dict[tuple[int, int], list[tuple[str, int]]]]:
    """Words of each template, and (k, hash) -> [(template, place)]. Hashed by Spark, as the texts are."""
    split = spark.createDataFrame(list(templates.items()), "name string, text string").select(
        "name", words(F.col("text")).alias("words")
    )
    rows = split.select(
        "name", "words", *[shingle_hashes(F.col("words"), k).alias(f"hashes{k}") for k in range(1, GRAM + 1)]
    ).collect()
    places = defaultdict(list)
    for row in rows:
        if len(row["words"]) < GRAM:
            raise ValueError(f"template {row['name']} has fewer than {GRAM} words")
        k, window = plan(len(row["words"]), coverage)
        hashes = row[f"hashes{k}"]
        for at in winnow(hashes, window):
            places[k, hashes[at]].append((row["name"], at))
    return {row["name"]: row["words"] for row in rows}, dict(places)


def align(template: list[str], text: list[str], low: int, high: int) -> list[int]:
    """Places in ``text`` of the matched words of the best local alignment with the template.

    Only cells on diagonals ``low`` to ``high`` (place in text minus place in template) are filled.  A
    match counts 1, a replaced, missing or added word -1; both ends of either side are free, so a part
    of the template is found, too.  Of equally good steps a match or replacement goes first, then the
    start of the alignment, then a missing word.
    """
    width, number = high - low + 1, {}
    wanted = [number.setdefault(w, len(number)) for w in template]
    # Cell d of row i: i template words used, i + low + d text words used; none is beyond the text's ends.
    numbers = np.full(len(template) + width + 1, -1, np.int32)
    inside = np.zeros(len(numbers), bool)
    first, last = max(0, low), min(len(text), low + len(numbers))
    if first < last:
        numbers[first - low : last - low] = [number.get(w, -1) for w in text[first:last]]
        inside[first - low : last - low] = True
    reach = np.arange(width, dtype=np.int32)
    score = np.zeros(width, np.int32)
    came = np.zeros((len(template), width), np.int8)
    best = (0, 0, 0)
    for i, word in enumerate(wanted):
        diagonal = score + np.where(numbers[i : i + width] == word, 1, -1).astype(np.int32)
        above = np.full(width, -1, np.int32)
        above[:-1] = score[1:] - 1
        row = np.maximum(np.maximum(diagonal, above), 0)
        # A run of added words loses one for each: the running maximum of what remains of the cells before.
        row = np.maximum.accumulate(row + reach) - reach
        row[~inside[i : i + width]] = 0
        steps = np.where(row == diagonal, _PAIRED, np.where(row == above, _SKIPPED, _ADDED))
        came[i] = np.where((row == 0) & (steps != _PAIRED) | ~inside[i : i + width], _START, steps)
        score, at = row, int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), i + 1, at)
    _, i, d = best
    matched = []
    while i > 0 and (step := came[i - 1, d]) != _START:
        if step == _PAIRED:
            i -= 1
            if numbers[i + d] == wanted[i]:
                matched.append(i + low + d)
        elif step == _SKIPPED:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return matched[::-1]


def common(template: list[str], text: list[str], low: int, high: int) -> int:
    """Length of the longest common subsequence on diagonals ``low`` to ``high``: no alignment there matches more.

    One bit stands for each template word, so a text word is one step on a wide integer.
    """
    places: dict[str, int] = defaultdict(int)
    for i, word in enumerate(template):
        places[word] |= 1 << i
    full, band = (1 << len(template)) - 1, (1 << (high - low + 1)) - 1
    unmatched = full
    for used in range(max(0, low), min(len(text), len(template) + high)):
        if at := places.get(text[used], 0) & unmatched:
            # Template places that this text place meets on the diagonals.
            if at := at & (band << used - high if used >= high else band >> high - used):
                unmatched = ((unmatched + at) | (unmatched - at)) & full
    return len(template) - unmatched.bit_count()


def _bundles(diagonals: list[int], gap: int):
    """Neighbouring diagonals, cut where one is more than ``gap`` from the bundle's first."""
    bundle: list[int] = []
    for diagonal in diagonals:
        if bundle and diagonal - bundle[0] > gap:
            yield bundle
            bundle = []
        bundle.append(diagonal)
    if bundle:
        yield bundle


def _best_in(template: list[str], text: list[str], low: int, high: int, least: float) -> list[int]:
    """Matched places of the best alignment on diagonals ``low`` to ``high``; none where they are fewer than ``least``."""
    n = len(template)
    for d in range(max(0, low), min(len(text) - n, high) + 1):
        if text[d] == template[0] and text[d : d + n] == template:
            return list(range(d, d + n))  # nothing scores more
    near = text[max(0, low) : high + n]
    if (Counter(template) & Counter(near)).total() < least or common(template, text, low, high) < least:
        return []
    matched = align(template, text, low, high)
    return matched if len(matched) >= least else []


class _Taken:
    """Stretches of a text, none overlapping another, by place."""

    def __init__(self):
        self.firsts: list[int] = []
        self.finds: list[list[int]] = []

    def _overlapping(self, start: int, stop: int) -> list[list[int]]:
        low = bisect_right(self.firsts, start)
        low -= bool(low and self.finds[low - 1][-1] >= start)
        return self.finds[low : bisect_left(self.firsts, stop)]

    def room(self, start: int, stop: int, least: float) -> bool:
        """Whether some stretch of [start, stop) that no find covers holds ``least`` words."""
        for matched in self._overlapping(start, stop):
            if matched[0] - start >= least:
                return True
            start = matched[-1] + 1
        return stop - start >= least

    def add(self, matched: list[int]) -> None:
        if matched and not self._overlapping(matched[0], matched[-1] + 1):
            at = bisect_left(self.firsts, matched[0])
            self.firsts.insert(at, matched[0])
            self.finds.insert(at, matched)


def _aligned(template: list[str], text: list[str], diagonals: list[int], least: float) -> list[list[int]]:
    """Matched places of the finds of one template, none overlapping another, by place."""
    n, taken = len(template), _Taken()
    band, step = max(2, n // 10), max(1, n // 4)
    # Where hits are dense, first.
    bundles = sorted(_bundles(diagonals, band), key=lambda b: (-len(b), b[0]))
    tries = [(b[0], b[-1]) for b in bundles]
    # What no find covers is searched again in bands that reach across long insertions.
    at = 0
    while at < len(diagonals):
        first, last = diagonals[at], diagonals[bisect_right(diagonals, diagonals[at] + 2 * step) - 1]
        if last - first > band:
            tries.append((first, last))
        at = bisect_left(diagonals, first + step)
    for first, last in tries:
        if taken.room(max(0, first - band), min(len(text), last + band + n), least):
            taken.add(_best_in(template, text, first - band, last + band, least))
    return taken.finds


def finds(text: list[str], hits: list[tuple[int, int, int]], templates, places, coverage: float) -> list[tuple]:
    """(template, matched words, coverage, spans) of each template found in the words of a text."""
    diagonals = defaultdict(list)
    for at, k, value in hits:
        for name, place in places[k, value]:
            diagonals[name].append(at - place)
    out = []
    for name in sorted(diagonals):
        template = templates[name]
        for matched in _aligned(template, text, sorted(diagonals[name]), coverage * len(template) - 1e-9):
            spans = [[matched[0], matched[0] + 1]]
            for at in matched[1:]:
                if at == spans[-1][1]:
                    spans[-1][1] = at + 1
                else:
                    spans.append([at, at + 1])
            out.append((name, len(matched), round(len(matched) / len(template), 6), spans))
    return out


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, doc_id="doc_id", text="text"
) -> DataFrame:
    """(doc_id, license, matched_words, coverage, first_word, last_word, spans, matched_text), one row per find.

    ``templates`` is a table of license texts by name.  Spans are word places from 0, ends exclusive.
    """
    wanted, places = index(docs.sparkSession, templates, coverage)
    if len(places) > MAX_FINGERPRINTS and len(templates) > 1:
        items, half = list(templates.items()), len(templates) // 2
        parts = [scan(docs, dict(part), coverage, doc_id, text) for part in (items[:half], items[half:])]
        return parts[0].union(parts[1])

    sizes = sorted({k for k, _ in places})

    def hits(k: int):
        # Parsed as one text, as a call for each literal takes far longer.
        known = ", ".join(f"{h}L" for size, h in places if size == k)
        hit = f"CASE WHEN h IN ({known}) THEN named_struct('at', i, 'k', {k}, 'hash', h) END"
        return F.expr(f"filter(transform(hashes{k}, (h, i) -> {hit}), h -> h IS NOT NULL)")

    looked_up = (
        docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words"))
        .select("doc_id", "words", *[shingle_hashes(F.col("words"), k).alias(f"hashes{k}") for k in sizes])
        .select("doc_id", "words", F.concat(*map(hits, sizes)).alias("hits"))
        .where(F.size("hits") > 0)
    )

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                hits = [(h["at"], h["k"], h["hash"]) for h in row["hits"]]
                for name, matched, share, spans in finds(row["words"], hits, wanted, places, coverage):
                    low, high = spans[0][0], spans[-1][1]
                    rows.append((row["doc_id"], name, matched, share, low, high, spans, " ".join(row["words"][low:high])))
            if rows:
                kinds = [
                    batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(),
                    pa.list_(pa.list_(pa.int32())), pa.string(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=NAMES)

    kind = docs.schema[doc_id].dataType.simpleString()
    return looked_up.mapInArrow(
        run,
        f"doc_id {kind}, license string, matched_words int, coverage double, first_word int, last_word int, "
        "spans array<array<int>>, matched_text string",
    )


NAMES = ["doc_id", "license", "matched_words", "coverage", "first_word", "last_word", "spans", "matched_text"]
