"""Byte-pair encoding and decoding with shared prefixes.

The distinct words of a batch that the worker doesn't know yet form a trie. A walk over it,
depth first (the words in sorted order), keeps for every prefix the last token of its encoding: of the tokens that
end the prefix, it is the one that stays apart from the last token of what stands before it.
A prefix that many words share is thus encoded once: the encoding of what stands before its
last token, and that token. Words are independent of each other, so there is no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk.llm.vocab import SPACE, Vocabulary, load

#: Words whose encoding a worker remembers; then it keeps those that its current texts use.
CACHE_WORDS = 300_000
#: The same where no ids and texts go back to Spark, which leaves room for more.
DIGEST_WORDS = 500_000
#: Longest prefix whose whole encoding is kept; that of a longer one is read backwards.
SHORT_BYTES = 64
#: Characters of text in a slice of a list.
SLICE_CHARS = 4_000_000
#: Bytes of text that are encoded at a time; likewise.
SLICE_BYTES, DIGEST_BYTES = 2_000_000, 4_000_000

_END = -1
#: A space that white space follows, or that ends the text.
_RUN = re.compile(rf" (?:[{SPACE}]|\Z)").search


def encode_packed(vocabulary: Vocabulary, words: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Each distinct non-empty word with its packed ids.

    Sorted words pass the trie depth first: what a word shares with the one before it is kept,
    and only the path below is walked.
    """
    size, ending, shorter, goto = vocabulary.size, vocabulary.ending, vocabulary.shorter, vocabulary.goto
    step, apart, joined = vocabulary.step, vocabulary.stays_apart, vocabulary.joined
    tokens = vocabulary.packed_ids
    last, state = [0], [0]  # by depth along the path from the root
    packed = [b""]  # likewise, down to SHORT_BYTES
    before = b""
    for word in sorted(words):
        depth = 0
        for a, b in zip(before, word):
            if a != b:
                break
            depth += 1
        del last[depth + 1:], state[depth + 1:], packed[depth + 1:]
        at = state[depth]
        for byte in word[depth:]:
            depth += 1
            below = goto.get(at << 8 | byte)
            at = step(at, byte) if below is None else below
            token = ending[at]
            start = depth - size[token]
            while start:
                pair = last[start], token
                known = joined.get(pair)
                if apart(*pair) if known is None else known:
                    break
                token = shorter[token]
                start = depth - size[token]
            last.append(token)
            state.append(at)
            if depth <= SHORT_BYTES:
                packed.append(packed[start] + tokens[token])
        before, tail = word, []
        while depth > SHORT_BYTES:
            tail.append(tokens[last[depth]])
            depth -= size[last[depth]]
        yield word, packed[depth] + b"".join(tail[::-1])


def encode_words(vocabulary: Vocabulary, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
    """Each distinct non-empty word with the ids of its tokens."""
    for word, packed in encode_packed(vocabulary, words):
        yield word, np.frombuffer(packed, dtype="<u4").tolist()


class Encoder:
    """Encodes texts with a bounded memory of words.

    A text is first cut at single spaces. Such a chunk, together with the space before it, has
    the same words wherever it stands, so whole chunks are remembered. Only where white space
    follows a space do words depend on more than the chunk; these texts are cut into words.
    """

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.vocabulary, self.cache_words = vocabulary, cache_words
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special, split = self.vocabulary.special, self.vocabulary.special_split
        parts = [split(t) if any(name in t for name in special) else [t] for t in texts]
        plain = iter(self._plain([p for ps in parts for p in ps if p not in special]))
        return [b"".join([_pack([special[p]]) if p in special else next(plain) for p in ps])
                if len(ps) != 1 or ps[0] in special else next(plain) for ps in parts]

    def _plain(self, texts: list[str]) -> list[bytes]:
        words = self.vocabulary.words
        cut = [None if _RUN(text) else text.split(" ") for text in texts]
        heads = [words(text) if chunks is None else words(chunks[0])
                 for text, chunks in zip(texts, cut)]
        needed = set().union(*(chunks[1:] for chunks in cut if chunks))
        fresh = needed.difference(self.chunks)
        if len(self.chunks) + len(fresh) > self.cache_words:
            self.chunks = {c: self.chunks[c] for c in needed.difference(fresh)}
        # letters alone are one word, whose encoding needs no second entry
        plain = {chunk for chunk in fresh if chunk.isascii() and chunk.isalpha()}
        found = encode_packed(self.vocabulary, (f" {chunk}".encode() for chunk in plain))
        self.chunks.update((word[1:].decode(), packed) for word, packed in found)
        inner = [(chunk, words(" " + chunk)) for chunk in fresh - plain]
        self._learn(set().union(*heads, *(found for _, found in inner)))
        get = self.known.__getitem__
        self.chunks.update((chunk, b"".join(map(get, found))) for chunk, found in inner)
        whole = self.chunks.__getitem__
        return [b"".join(map(get, head)) + (b"".join(map(whole, chunks[1:])) if chunks else b"")
                for head, chunks in zip(heads, cut)]

    def _learn(self, words: set[str]) -> None:
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > self.cache_words:
            self.known = {w: self.known[w] for w in words.difference(missing)}
        found = encode_packed(self.vocabulary, (w.encode() for w in missing))
        self.known.update((w.decode(), packed) for w, packed in found)


def _pack(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def decode(vocabulary: Vocabulary, packed: bytes) -> str:
    """The text of packed ids; bytes that aren't UTF-8 become replacement characters."""
    ids = np.frombuffer(packed, dtype="<u4").tolist()
    return b"".join(map(vocabulary.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _byte_table(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes in one array, with each id's start and length."""
    top = max(vocabulary.token_bytes) + 1
    lengths = np.zeros(top, dtype=np.int64)
    for i, data in vocabulary.token_bytes.items():
        lengths[i] = len(data)
    starts = np.zeros(top, dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    flat = np.frombuffer(b"".join(vocabulary.token_bytes.get(i, b"") for i in range(top)), dtype=np.uint8)
    return flat, starts, lengths


def decode_gathered(table: tuple[np.ndarray, np.ndarray, np.ndarray], packed: bytes) -> str:
    """As ``decode``, by one gather from the flat byte table."""
    flat, starts, lengths = table
    ids = np.frombuffer(packed, dtype="<u4")
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    at = np.repeat(starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    return flat[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _worker(path: str, cache_words: int = CACHE_WORDS) -> tuple[Vocabulary, Encoder, tuple]:
    """Vocabulary, encoder and byte table of ``path``, once per worker process.

    The encoder's memory of words thus outlives a task; it stays bounded by ``cache_words``.
    """
    vocabulary = load(path)
    return vocabulary, Encoder(vocabulary, cache_words), _byte_table(vocabulary)


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Cut a list into runs of about ``chars`` characters, one text at least."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > chars:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def encode(df: DataFrame, vocabulary_path: str, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``ids`` and ``decoded`` of every whole text.

    A null text counts as empty: no ids. Special tokens that a text holds become their ids.
    Rows are neither joined nor compared, so repeated ids and rows stay as they are.
    """
    source, text_at = _source(df, text_col, keep)
    fields = source.schema.fields[:len(keep)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                        "ids array<int>", "decoded string"])

    def run(batches):
        _, encoder, table = _worker(vocabulary_path)
        for batch in batches:
            for at, texts in _cut(batch, text_at):
                packed = encoder.packed(texts)
                ids = [np.frombuffer(p, dtype="<i4") for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [*at.columns[:len(fields)], pa.array(ids, pa.list_(pa.int32())),
                     pa.array([decode_gathered(table, p) for p in packed], pa.string())],
                    [*at.schema.names[:len(fields)], "ids", "decoded"])

    return source.mapInArrow(run, schema)


def digests(df: DataFrame, vocabulary_path: str, text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``encode``, with the number of tokens and SHA-256 digests of ids and decoded text.

    For readers that only compare: the ids themselves don't leave the worker.
    """
    source, text_at = _source(df, text_col, keep)
    fields = source.schema.fields[:len(keep)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                        "n_tokens bigint, ids_sha256 string, decoded_sha256 string"])

    def run(batches):
        _, encoder, table = _worker(vocabulary_path, DIGEST_WORDS)
        for batch in batches:
            for at, texts in _cut(batch, text_at, DIGEST_BYTES):
                packed = encoder.packed(texts)
                yield pa.RecordBatch.from_arrays(
                    [*at.columns[:len(fields)],
                     pa.array([len(p) // 4 for p in packed], pa.int64()),
                     pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                     pa.array([hashlib.sha256(decode_gathered(table, p).encode()).hexdigest()
                               for p in packed])],
                    [*at.schema.names[:len(fields)], "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, schema)


def _source(df: DataFrame, text_col: str, keep: tuple[str, ...]) -> tuple[DataFrame, int]:
    """The columns ``keep`` and the text, and the text's place; a kept text is not sent twice."""
    if text_col in keep and dict(df.dtypes)[text_col] == "string":
        return df.select(*keep), keep.index(text_col)
    return df.select(*keep, F.col(text_col).cast("string").alias("_text")), len(keep)


def _cut(batch: pa.RecordBatch, text_at: int, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of about ``size`` bytes of text, one row at least, with their texts."""
    column = batch.column(text_at)
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, upto - at), [text or "" for text in column.slice(at, upto - at).to_pylist()]
        at, before = upto, int(ends[upto - 1])
