"""Language identification by cross-parsing entropy.

Each language is known by a piece of labelled text, held as a suffix automaton. A text is
parsed from left to right into the longest phrases that occur in that piece; the fewer phrases,
the closer the language. The count is normalised by the length of the text and the size of the
piece: phrases * log2(piece) / letters, an estimate of the bits per letter (Ziv and Merhav).

The texts of a batch are cut into pieces that are parsed in step, one letter of all pieces at
a time, as array lookups. A phrase therefore ends at the end of a piece.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_risk.llm.bpe import slices

#: Labelled rows per language that are learned from, and characters of each of them.
SAMPLE_ROWS, ROW_CHARS = 64, 600
#: Different letters of a language that its automaton tells apart.
LETTERS = 63
#: Letters of a text that are parsed in one go, and characters parsed at a time.
PIECE, SLICE = 1_024, 3_000_000

UNKNOWN = "und"


def fit(labelled: DataFrame, label_col: str = "lang", text_col: str = "text",
        id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS,
        row_chars: int = ROW_CHARS) -> dict[str, str]:
    """Text of each language, from a bounded sample of the labelled rows.

    Of each label the ``sample_rows`` rows are taken whose ids have the smallest hashes, and
    ``row_chars`` characters of each. Rows without label, text or letters teach nothing.
    """
    rows = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    order = Window.partitionBy("label").orderBy("place", "text")
    sample = (rows.select(F.col(label_col).alias("label"), F.xxhash64(F.col(id_col)).alias("place"),
                          F.substring(F.col(text_col), 1, row_chars).alias("text"))
              .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_rows))
    found: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["label"], r["n"])):
        found.setdefault(row["label"], []).append(row["text"])
    return {label: " ".join(texts) for label, texts in found.items()}


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, one space for what isn't a letter, and bounds."""
    lower = [text.lower() + " " for text in texts]
    code = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in lower], out=bounds[1:])
    kept = np.zeros(len(code) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return np.where(letter, code, 32)[keep].astype(np.uint32), kept[bounds]


class Automaton:
    """Suffix automaton of a text as one table: the next state, and whether a phrase begins."""

    def __init__(self, text: str):
        codes = letters([text])[0]
        self.size = len(codes)
        kinds, count = np.unique(codes, return_counts=True)
        common = kinds[np.argsort(-count, kind="stable")[:LETTERS]]
        self.kind = np.full(0x110000, LETTERS, np.uint8)
        self.kind[common] = np.arange(len(common))
        after, link, length, last = [{}], [-1], [0], 0
        for c in self.kind[codes].tolist():
            state = len(after)
            after.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in after[at]:
                after[at][c] = state
                at = link[at]
            if at >= 0:
                other = after[at][c]
                if length[at] + 1 == length[other]:
                    link[state] = other
                else:
                    copy = len(after)
                    after.append(dict(after[other]))
                    length.append(length[at] + 1)
                    link.append(link[other])
                    while at >= 0 and after[at].get(c) == other:
                        after[at][c] = copy
                        at = link[at]
                    link[other] = link[state] = copy
            last = state
        # letters of the rare kind occur nowhere, so each is a phrase of its own
        for below in after:
            below.pop(LETTERS, None)
        start = np.zeros(LETTERS + 1, np.int32)
        start[list(after[0])] = list(after[0].values())
        table = np.tile(2 * start + 1, (len(after), 1))
        for state, below in enumerate(after):
            if below:
                table[state, list(below)] = 2 * np.fromiter(below.values(), np.int32)
        table[0] |= 1  # what leaves the start begins a phrase
        self.table = table.reshape(-1)

    def phrases(self, grid: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each column; row t of the grid has code point t of the first active[t]."""
        count = np.zeros(grid.shape[1], np.int32)
        state = np.zeros(grid.shape[1], np.int32)
        kinds = self.kind[grid]
        for t, n in enumerate(active):
            step = self.table.take((state[:n] << 6) + kinds[t, :n])
            count[:n] += step & 1
            state[:n] = step >> 1
        return count


@lru_cache(maxsize=2)
def _automata(samples: tuple[tuple[str, str], ...]) -> list[Automaton]:
    return [Automaton(text) for _, text in samples]


def rates(texts: list[str], samples: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per letter of each text under each language, and the letters of each text."""
    codes, bounds = letters(texts)
    n_letters = np.add.reduceat(np.append(codes != 32, False), bounds[:-1]) * (np.diff(bounds) > 0)
    pieces = -(-np.diff(bounds) // PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = bounds[owner] + nth * PIECE
    length = np.minimum(begin + PIECE, bounds[owner + 1]) - begin
    order = np.argsort(-length, kind="stable")
    begin, length, owner = begin[order], length[order], owner[order]
    longest = int(length.max(initial=0))
    active = np.searchsorted(-length, -np.arange(longest), side="left")
    place = np.minimum(begin[None, :] + np.arange(longest)[:, None], max(len(codes) - 1, 0))
    grid = codes[place] if len(codes) else np.zeros((0, 0), np.uint32)
    out = np.zeros((len(texts), len(samples)))
    for i, automaton in enumerate(_automata(samples)):
        phrases = np.bincount(owner, automaton.phrases(grid, active), len(texts))
        out[:, i] = phrases * np.log2(automaton.size + 1) / np.maximum(np.diff(bounds), 1)
    return out, n_letters


def predict(df: DataFrame, samples: dict[str, str], text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` for every whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing
    was learned. The score is the share of the best language among all, by how far their rates
    lie above its rate; of equal rates the first language in alphabetical order wins.
    """
    source = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]),
                        "lang_pred string, score double"])
    known = tuple(sorted(samples.items()))
    shared = df.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        languages = np.array([name for name, _ in shared.value] or [UNKNOWN], object)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(batch.num_columns - 1).to_pylist(), SLICE):
                part, at = batch.slice(at, len(texts)), at + len(texts)
                if shared.value:
                    rate, n = rates(texts, shared.value)
                    best = rate.argmin(axis=1)
                    low = np.maximum(rate.min(axis=1), 1e-9)
                    score = 1 / np.exp(-8 * (rate / low[:, None] - 1)).sum(axis=1)
                    found, score = np.where(n > 0, languages[best], UNKNOWN), np.where(n > 0, score, 0.0)
                else:
                    found, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    [*part.schema.names[:-1], "lang_pred", "score"])

    return source.mapInArrow(run, schema)
