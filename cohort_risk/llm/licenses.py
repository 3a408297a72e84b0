"""License scans: word pairs pick candidates, banded alignment confirms them.

Templates and texts are compared as folded words. An inverted index leads from every pair of
consecutive words to its places in templates. A text with enough of a template's words, in order
and within the band, shares at least a known number of pairs with it on neighbouring diagonals;
places with as many are candidates, so none is lost to the index. There a local alignment in a
band around the diagonals counts the words that match and gives the span. Words that tell a
license or its version from its siblings have to be there, and words of siblings must not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk.llm.bpe import slices
from cohort_risk.llm.license_texts import REQUIRED, TEMPLATES, VARIANTS
from cohort_risk.llm.words import Words, shingles, words

#: Words of an index entry.
GRAM = 2
#: Words that the alignment may drift from its diagonals, a quarter of the template at most.
BAND = 8
#: Share of a template's words that must match.
LEAST_COVERAGE = 0.75
SLICE = 2_000_000

_MATCH, _MISS = 2, -1


def _hashes(text: str) -> list[int]:
    return words([text], fold=True).hashes.tolist()


def _holds(span: list[int], phrase: list[int]) -> bool:
    n = len(phrase)
    return any(span[i:i + n] == phrase for i in range(len(span) - n + 1))


class Index:
    """Templates with the inverted index of their word pairs."""

    def __init__(self, templates: dict[str, str], least: float = LEAST_COVERAGE):
        self.names = list(templates)
        found = words(list(templates.values()), fold=True)
        self.words = [found.hashes[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
        hashes, bounds = shingles(found, GRAM)
        template = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.argsort(hashes, kind="stable")
        place = np.arange(len(hashes)) - bounds[:-1][template]
        self.keys, self.template, self.place = hashes[order], template[order], place[order]
        size = np.diff(found.bounds)
        self.band = np.minimum(BAND, size // 4)
        # of ``matched`` words in order, each missing word and each word put in between breaks one pair
        matched = np.ceil(least * size - 1e-9).astype(np.int64)
        self.pairs = np.maximum(1, matched - 1 - (size - matched) - self.band)
        self.required = [[_hashes(x) for x in REQUIRED.get(name, ())] for name in self.names]
        variants = frozenset(_hashes(VARIANTS))
        self.foreign = [variants - set(w.tolist()) if r else frozenset()
                        for w, r in zip(self.words, self.required)]

    def candidates(self, found: Words) -> list[tuple[int, int, int, int]]:
        """Text, template, first and last diagonal (word of text - word of template) of candidates."""
        hashes, bounds = shingles(found, GRAM)
        low, high = (np.searchsorted(self.keys, hashes, side) for side in ("left", "right"))
        hit = np.flatnonzero(high > low)
        times = (high - low)[hit]
        if not len(hit):
            return []
        at = np.repeat(low[hit] - np.cumsum(times) + times, times) + np.arange(times.sum())
        text = np.searchsorted(bounds, hit, "right") - 1
        place = np.repeat(hit - bounds[:-1][text], times)
        text, template, diagonal = np.repeat(text, times), self.template[at], place - self.place[at]
        order = np.lexsort((diagonal, template, text))
        text, template, diagonal = text[order], template[order], diagonal[order]
        # hits of one alignment lie within two bands: keep hits in a window with enough of them
        pair = text * len(self.names) + template
        gap = int(diagonal.max() - diagonal.min()) + 2 * BAND + 2
        line = pair * gap + diagonal - diagonal.min()
        upto = np.searchsorted(line, line + 2 * self.band[template], "right")
        full = upto - np.arange(len(line)) >= self.pairs[template]
        cover = np.zeros(len(line) + 1, np.int64)
        np.add.at(cover, np.flatnonzero(full), 1)
        np.add.at(cover, upto[full], -1)
        kept = np.cumsum(cover[:-1]) > 0
        text, template, diagonal, line = text[kept], template[kept], diagonal[kept], line[kept]
        if not len(line):
            return []
        cut = np.flatnonzero(np.diff(line) > self.band[template[1:]]) + 1
        first, last = np.r_[0, cut], np.r_[cut, len(line)] - 1
        return list(zip(text[first].tolist(), template[first].tolist(),
                        diagonal[first].tolist(), diagonal[last].tolist()))


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment on diagonals low..high: matched words, first and last word of the text."""
    width = high - low + 1
    best, answer = 0, (0, 0, 0)
    above = [(0, 0, 0)] * (width + 1)
    expected, actual = template.tolist(), text.tolist()
    for i, word in enumerate(expected):
        row, left = [], (0, 0, 0)
        for d in range(width):
            j = i + low + d
            if 0 <= j < len(actual):
                score, n, first = above[d]
                if actual[j] == word:
                    cell = (score + _MATCH, n + 1, first if score else j)
                else:
                    cell = (score + _MISS, n, first)
                for gap in (above[d + 1], left):
                    if gap[0] + _MISS > cell[0]:
                        cell = (gap[0] + _MISS, gap[1], gap[2])
                if cell[0] <= 0:
                    cell = (0, 0, 0)
                elif cell[0] > best:
                    best, answer = cell[0], (cell[1], cell[2], j)
            else:
                cell = (0, 0, 0)
            row.append(cell)
            left = cell
        above = [*row, (0, 0, 0)]
    return answer


def alignments(template: np.ndarray, text: np.ndarray, low: int, high: int, least: float):
    """The best local alignment with at least ``least`` words, then those before and after it."""
    if len(text) < least:
        return
    n, first, last = align(template, text, low, high)
    if n < least:
        return
    yield n, first, last
    yield from alignments(template, text[:first], low, high, least)
    for m, a, b in alignments(template, text[last + 1:], low - last - 1, high - last - 1, least):
        yield m, a + last + 1, b + last + 1


def find(texts: list[str], index: Index, least: float = LEAST_COVERAGE) -> list[list[dict]]:
    """Licenses in each text: name, start and end in code points, matched words, coverage."""
    found = words(texts, fold=True)
    out: list[list[dict]] = [[] for _ in texts]
    for t, k, low, high in index.candidates(found):
        mine = slice(found.bounds[t], found.bounds[t + 1])
        size, band = len(index.words[k]), int(index.band[k])
        low, high = low - band, high + band
        begin = max(0, low)
        window = found.hashes[mine][begin:high + size]
        for n, first, last in alignments(index.words[k], window, low - begin, high - begin, least * size):
            span = window[first:last + 1].tolist()
            if all(_holds(span, x) for x in index.required[k]) and not index.foreign[k].intersection(span):
                raw = texts[t].encode("utf-8", "replace")
                start, end = (len(raw[:at].decode()) for at in (
                    found.starts[mine][begin + first], found.ends[mine][begin + last]))
                out[t].append({"license": index.names[k], "start": start, "end": end,
                               "matched": n, "coverage": n / size})
    return [_best(hits) for hits in out]


def _best(hits: list[dict]) -> list[dict]:
    """Of hits that overlap, the one with the most matched words."""
    kept: list[dict] = []
    for hit in sorted(hits, key=lambda h: (-h["matched"], -h["coverage"], h["start"], h["license"])):
        if not any(h["start"] < hit["end"] and hit["start"] < h["end"] for h in kept):
            kept.append(hit)
    return sorted(kept, key=lambda h: h["start"])


def scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, text_col: str = "text",
         keep: tuple[str, ...] = ("doc_id",), least: float = LEAST_COVERAGE) -> DataFrame:
    """The columns ``keep`` with ``found``: license, start, end, matched, coverage of each hit.

    A null text counts as empty. Up to ``BAND`` words, a quarter of the template at most, may be put
    in between. Words of REQUIRED have to be in the span as they are, in any order.
    Of overlapping hits the one with the most matched words is given; ties go to the higher
    coverage, then by place and name.
    """
    source = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    hit = "struct<license:string,start:int,end:int,matched:int,coverage:double>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]),
                        f"found array<{hit}>"])
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("matched", pa.int32()), ("coverage", pa.float64())]))

    def run(batches):
        index = Index(templates, least)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(batch.num_columns - 1).to_pylist(), SLICE):
                part, at = batch.slice(at, len(texts)), at + len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(find(texts, index, least), kind)],
                    [*part.schema.names[:-1], "found"])

    return source.mapInArrow(run, schema)
