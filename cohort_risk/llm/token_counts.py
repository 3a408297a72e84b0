"""Token counts by lookup, without moving any pre-token between tasks.

Texts are cut at single spaces; what lies between, with the space before it, has the same
tokens wherever it stands. Two tables on the worker answer for such a pre-token: a compact
one of frequent pre-tokens and their lengths, broadcast to all, and a bounded cache of those
that the worker has met. Only what neither knows goes to the tokenizer. The tables decide
speed alone, so frequent pre-tokens are taken from a bounded sample of rows.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk.llm.bpe import slices
from cohort_risk.llm.vocab import SPACE

#: Rows that frequent pre-tokens are taken from, about.
SAMPLE_ROWS = 2_000
#: Frequent pre-tokens that are broadcast at most, and the longest of them.
TABLE_SIZE, TABLE_CHARS = 20_000, 32
#: Pre-tokens that a worker remembers; then it starts anew.
CACHE_WORDS = 500_000

_DEPENDS = re.compile(rf" (?:[{SPACE}]|\Z)").search


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, without truncation and padding, read once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def lengths(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text by the library itself."""
    return [len(e.ids) for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def frequent(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
             sample_rows: int = SAMPLE_ROWS, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """Lengths of pre-tokens that tasks have met often; at most ``table_size`` entries.

    What the tasks have met is added up by word, from the bounded sample alone.
    """
    rows = df.count()
    share = min(1.0, sample_rows / max(rows, 1))
    sample = df.filter(
        # steps of 2**-40: the expected sample is sample_rows rows up to 10**15 rows
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(w for w in text.split(" ")[1:] if 0 < len(w) <= TABLE_CHARS)
        top = [(w, n) for w, n in found.most_common(table_size) if n > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["word", "n"])

    best = (sample.select(text_col).mapInArrow(count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "word").limit(table_size))
    words = [row["word"] for row in best.collect()]
    return dict(zip(words, lengths(path, [" " + w for w in words]))) if words else {}


class Counts:
    """Token counts of texts from the two tables."""

    def __init__(self, path: str, table: dict[str, int], cache_words: int = CACHE_WORDS):
        self.path, self.table, self.cache_words = path, table, cache_words
        self.special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}

    def of(self, texts: list[str]) -> list[int]:
        cut = [None if _DEPENDS(t) or any(s in t for s in self.special) else t.split(" ")
               for t in texts]
        heads = lengths(self.path, [c[0] if c else t for c, t in zip(cut, texts)])
        missing = set().union(*(c[1:] for c in cut if c)).difference(self.table)
        fresh = missing.difference(self.cache)
        if len(self.cache) + len(fresh) > self.cache_words:
            self.cache, fresh = {}, missing
        fresh = list(fresh)
        for at in range(0, len(fresh), 50_000):
            part = fresh[at:at + 50_000]
            self.cache.update(zip(part, lengths(self.path, [" " + w for w in part])))
        table, cache = self.table.get, self.cache
        return [head + (sum([table(w) or cache[w] for w in c[1:]]) if c else 0)
                for head, c in zip(heads, cut)]


def count_tokens(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                 keep: tuple[str, ...] = ("doc_id",), **table) -> DataFrame:
    """The columns ``keep`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text.

    A null text counts as empty, with no token. Special tokens that a text holds count as one
    each, and no others are added. Repeated rows are each counted; other columns don't matter.
    """
    known = df.sparkSession.sparkContext.broadcast(frequent(df, path, text_col, id_col, **table))
    source = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]),
                        "n_bytes bigint, n_tokens bigint"])

    def run(batches):
        counts = Counts(path, known.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(batch.num_columns - 1).to_pylist()):
                part, at = batch.slice(at, len(texts)), at + len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1],
                     pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(counts.of(texts), pa.int64())],
                    [*part.schema.names[:-1], "n_bytes", "n_tokens"])

    return source.mapInArrow(run, schema)
