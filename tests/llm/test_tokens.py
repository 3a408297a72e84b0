import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohort_risk.llm import bpe, token_counts
from cohort_risk.llm.vocab import load

from .conftest import long_text

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  ", "\n", "a", "a  b", "a   b\n\n c \n", "x \n y", "tail ", "it's I'LL we've 's",
    "<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endoftext|>", "x\n <|endoftext|> y", "<|endoftext",
    "Ünïcode 日本語 🎉🎉 ٣٤ ½", "\x1c\x1d\x85\xa0　 z", "a" * 3000, "!?" * 700, "0123456789" * 50,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_of_a_trie(library):
    rng = random.Random(2)
    words = {"".join(rng.choices("etaoin shrdlu'.,\né1", k=rng.randrange(1, 25))) for _ in range(3000)}
    encoder = bpe.Encoder(load(PATH), cache_words=500)  # less than there are words
    for part in bpe.slices(sorted(words), 9_000):
        for text, packed in zip(part, encoder.packed(part)):
            assert packed == b"".join(i.to_bytes(4, "little") for i in expected(library, text))
            assert bpe.decode(encoder.vocabulary, packed) == text


def test_a_full_memory_keeps_the_words_in_use(monkeypatch, library):
    encoded, encode_packed = [], bpe.encode_packed
    monkeypatch.setattr(bpe, "encode_packed",
                        lambda v, words: encode_packed(v, [encoded.append(w) or w for w in words]))
    encoder = bpe.Encoder(load(PATH), cache_words=20)
    for i in range(12):
        text = "the common words 7th it's " + " ".join(f"{chr(97 + i)}{chr(97 + k)}q" for k in range(8))
        assert encoder.packed([text]) == [b"".join(i.to_bytes(4, "little") for i in expected(library, text))]
        assert len(encoder.chunks) <= 20
    assert encoded.count(b" common") == encoded.count(b" 7") == 1


def test_a_kept_text_reaches_the_workers_once(docs, library):
    table = docs([(1, "a  b"), (2, None), (3, "")])
    source, at = bpe._source(table, "text", ("doc_id", "text"))
    assert (source.columns, at) == (["doc_id", "text"], 1)
    rows = {r["doc_id"]: r for r in bpe.encode(table, PATH, keep=("doc_id", "text")).collect()}
    assert [rows[i]["text"] for i in (1, 2, 3)] == ["a  b", None, ""]
    assert [(rows[i]["ids"], rows[i]["decoded"]) for i in (1, 2, 3)] == [(expected(library, "a  b"), "a  b"), ([], ""), ([], "")]


def test_batches_are_cut_by_bytes_of_text():
    texts = ["é" * 40, None, "", "x" * 500, "y", "z" * 99, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts, pa.string())], ["doc_id", "text"])
    parts = list(bpe._cut(batch, 1, size=100))
    assert [p.column(0).to_pylist() for p, _ in parts] == [[0, 1, 2], [3], [4, 5, 6]]
    assert [t for _, part in parts for t in part] == [t or "" for t in texts]
    assert list(bpe._cut(batch.slice(0, 0), 1)) == []


def test_every_token_is_its_own_encoding():
    vocabulary = load(PATH)
    assert all(len(ids) == 1 for _, ids in bpe.encode_words(vocabulary, vocabulary.by_bytes))


def test_encode_and_digests(docs, odd, library):
    table = docs([(100 + i, t) for i, t in enumerate([*TEXTS, long_text(1, 3000)])] + odd)
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    rows = bpe.encode(table, PATH).collect()
    sums = bpe.digests(table, PATH).collect()
    for (i, text), row, digest in zip(texts, rows, sums):
        ids = expected(library, text)
        assert (row["doc_id"], row["ids"], row["decoded"]) == (i, ids, text or "")
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
        packed = b"".join(n.to_bytes(4, "little") for n in ids)
        assert digest["n_tokens"] == len(ids)
        assert digest["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert digest["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digests(docs([]), PATH).count() == 0


@pytest.mark.parametrize("table_size", [0, 3, 20_000])
def test_counts(docs, odd, library, table_size):
    table = docs([(100 + i, t) for i, t in enumerate([*TEXTS, long_text(1, 2000), long_text(1, 2000)])] + odd)
    texts = [r["text"] or "" for r in table.collect()]
    rows = token_counts.count_tokens(table, PATH, table_size=table_size).collect()
    assert [r["n_tokens"] for r in rows] == [len(expected(library, t)) for t in texts]
    assert [r["n_bytes"] for r in rows] == [len(t.encode()) for t in texts]


def test_counts_of_nothing(docs):
    assert token_counts.count_tokens(docs([]), PATH).count() == 0
    counts = token_counts.Counts(PATH, {}, cache_words=2)
    assert counts.of(["a b c d e", "a b c d e"]) == [5, 5]


def test_gathered_decode_equals_joined_decode():
    import public_tokenizers
    import numpy as np

    from cohort_risk.llm import bpe
    from cohort_risk.llm.vocab import load
    vocabulary = load(public_tokenizers.path("byte_bpe_50k.json"))
    table = bpe._byte_table(vocabulary)
    rng = np.random.default_rng(0)
    top = max(vocabulary.token_bytes)
    for n in (0, 1, 7, 5000):
        packed = rng.integers(0, top + 1, n).astype("<u4").tobytes()
        assert bpe.decode_gathered(table, packed) == bpe.decode(vocabulary, packed)


def test_packed_words_share_prefixes_and_plain_chunks_are_kept_once(library):
    vocabulary = load(PATH)
    rng = random.Random(4)
    stem = "".join(rng.choices("etaoinshrdlu", k=90))
    words = {stem[:n] + end for n in (1, 3, 62, 63, 64, 65, 66, 90) for end in ("", "s", "ing", "é")}
    words |= {"a" * 200_000}  # its prefixes' encodings together would not fit in memory
    found = dict(bpe.encode_packed(vocabulary, {w.encode() for w in words}))
    assert {w: found[w.encode()] for w in words} == {
        w: b"".join(i.to_bytes(4, "little") for i in expected(library, w)) for w in words}
    encoder = bpe.Encoder(vocabulary)
    encoder.packed(["ab cd ef it's"])
    assert set(encoder.known) == {"ab", " it", "'s"} and set(encoder.chunks) == {"cd", "ef", "it's"}
