"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score from its words, and the
document's probability is the noisy-or of the sentence scores. Only documents carry labels;
the gradient of their likelihood shares the blame among the sentences, so that the model also
learns which ones offend. The score of a sentence without evidence is subtracted from all, so
that a long document isn't suspect for its length.

A word counts through itself and its first three to six letters, which carry over to forms
that were not seen. Weights are sparse and not negative.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_risk.llm.bpe import slices

#: Labelled documents of each class that are learned from, and the longest of them. Up to 1,000
#: rows Spark limits each task's share before the shuffle.
SAMPLE_ROWS, ROW_CHARS = 1_000, 8_000
#: Documents of the sample that a feature must occur in.
LEAST_DOCS = 6
#: Logit of a sentence without evidence; steps, step size and sparsity of the fit.
EMPTY, STEPS, RATE, SPARSITY = -5.0, 300, 1.0, 2e-4
#: Words whose weight a worker remembers.
CACHE_WORDS = 500_000

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_STOPS = frozenset(".!?\n")


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in range(3, 7) if len(word) >= n)]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def sentences(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """Start, end (code points) and probability of the sentences that offend."""
        found = []
        for m in _SENTENCE.finditer(text):
            z = EMPTY + sum(self.word(w) for w in _WORD.findall(m.group().lower()))
            p = float(-np.expm1(_soft(EMPTY) - _soft(z)))
            if p >= least:
                found.append((*m.span(), p))
        return found


def _soft(z):
    return np.logaddexp(0.0, z)


def train(texts: list[str], toxic: list[int], share: float = 0.5) -> Model:
    """Fit on labelled texts; ``share`` is the share of toxic ones among all documents."""
    label = np.array(toxic, bool)
    if label.all() or not label.any():
        return Model()
    names: dict[str, int] = {}
    word_of, sentence_of, doc_of = [], [], []
    for doc, text in enumerate(texts):
        doc_of.append(doc)
        for token in _TOKEN.findall(text.lower()):
            if token in _STOPS:
                doc_of.append(doc)
            else:
                word_of.append(names.setdefault(token, len(names)))
                sentence_of.append(len(doc_of) - 1)
    word_of, sentence_of = np.array(word_of, np.int64), np.array(sentence_of, np.int64)
    doc_of = np.array(doc_of, np.int64)
    kinds: dict[str, int] = {}
    pairs = [(i, kinds.setdefault(f, len(kinds))) for w, i in names.items() for f in features(w)]
    of_word, feature = np.array(pairs, np.int64).T if pairs else np.zeros((2, 0), np.int64)
    # documents of each feature, counted once each
    by_doc = np.unique(word_of * len(texts) + doc_of[sentence_of])
    begin = np.searchsorted(by_doc, np.arange(len(names) + 1) * len(texts))
    docs = np.zeros(len(kinds), np.int64)
    np.add.at(docs, feature, np.diff(begin)[of_word])
    use = docs[feature] >= LEAST_DOCS
    of_word, feature = of_word[use], feature[use]
    weight = np.zeros(len(kinds))
    cost = np.where(label, share / label.mean(), (1 - share) / (1 - label.mean())) / len(label)
    square = np.full(len(kinds), 1e-12)
    for _ in range(STEPS):
        by_word = np.bincount(of_word, weight[feature], len(names))
        z = EMPTY + np.bincount(sentence_of, by_word[word_of], len(doc_of))
        total = np.bincount(doc_of, _soft(z) - _soft(EMPTY), len(texts)) + 1e-3
        blame = cost * np.where(label, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        pull = blame[doc_of] / (1 + np.exp(-z))
        slope = np.bincount(feature, np.bincount(word_of, pull[sentence_of], len(names))[of_word],
                            len(kinds))
        square += slope ** 2
        weight = np.maximum(0.0, weight - RATE * (slope + SPARSITY * share) / np.sqrt(square))
    chosen = np.flatnonzero(weight > 1e-3)
    by_number = list(kinds)
    return Model({by_number[i]: float(weight[i]) for i in chosen})


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", text_col: str = "text",
        id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, row_chars: int = ROW_CHARS) -> Model:
    """Fit on a bounded sample: the labelled rows of each class whose ids hash lowest.

    Of these, documents of more than ``row_chars`` characters are left out. Without labels of
    both classes nothing is learned, and every score is 0.
    """
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).alias("toxic")))
    counts = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Model()
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id")
    chosen = {row["id"]: int(row["toxic"]) for row in
              known.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_rows).collect()}
    rows = (docs.filter(F.col(id_col).isin(list(chosen)) & (F.length(text_col) <= row_chars))
            .select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).collect())
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return train([r["text"] for r in rows], [chosen[r["id"]] for r in rows],
                 counts[True] / sum(counts.values()))


class _Weights(dict):
    """Weights of words that were met, none for the ends of sentences."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[token] = np.nan if token in _STOPS else self.model.word(token)
        return value


def scores(texts: list[str], weights: _Weights) -> np.ndarray:
    """Noisy-or of the sentences of each text; 0 without evidence."""
    cut = [_TOKEN.findall(text.lower()) for text in texts]
    sizes = np.array([len(tokens) + 1 for tokens in cut], np.int64)
    get = weights.__getitem__
    values = np.fromiter((x for tokens in cut for x in (np.nan, *map(get, tokens))), float, sizes.sum())
    stop = np.isnan(values)
    values[stop] = 0.0
    sentence = np.cumsum(stop) - 1
    z = EMPTY + np.bincount(sentence, values)
    first = np.cumsum(sizes) - sizes
    total = np.add.reduceat(_soft(z) - _soft(EMPTY), sentence[first])
    return -np.expm1(-np.maximum(total, 0.0))


def score(df: DataFrame, model: Model, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",), spans: bool = False) -> DataFrame:
    """The columns ``keep`` with ``score`` of every whole text.

    Null and empty texts, and texts without a learned word, have score 0. With ``spans`` there
    is also ``offending``, the start, end and probability of sentences that offend on their own.
    """
    source = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), "score double"]
                       + ["offending array<struct<start:int,end:int,score:double>>"] * spans)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights = _Weights(shared.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(batch.num_columns - 1).to_pylist()):
                part, at = batch.slice(at, len(texts)), at + len(texts)
                more = [pa.array(scores(texts, weights), pa.float64())]
                if spans:
                    more.append(pa.array([[dict(zip(("start", "end", "score"), s)) for s in
                                           shared.value.sentences(t)] for t in texts], span))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *more], [*part.schema.names[:-1], *(["score", "offending"][:len(more)])])

    return source.mapInArrow(run, schema)
