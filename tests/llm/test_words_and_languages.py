import numpy as np

from cohort_risk.llm import langid
from cohort_risk.llm.words import shingles, words

from .conftest import PROSE


def test_words_hash_alike_in_any_batch():
    alone = words(["b  a\nc"])
    batch = words(["", "zz b", "b  a\nc", "A"])
    assert alone.bounds.tolist() == [0, 3]
    assert (batch.hashes[batch.bounds[2]:batch.bounds[3]] == alone.hashes).all()
    assert alone.starts.tolist() == [0, 3, 5] and alone.ends.tolist() == [1, 4, 6]
    assert len(set(batch.hashes.tolist())) == 5
    folded = words(["One-two, ONE"], fold=True)
    assert folded.hashes[0] == folded.hashes[2] != folded.hashes[1]


def test_shingles_stay_inside_texts_and_depend_on_order():
    hashes, bounds = shingles(words(["a b c d e f", "a b c", "", "a b c d e", "b a c"]), 5)
    assert bounds.tolist() == [0, 2, 3, 3, 4, 5]
    assert hashes[0] == hashes[3] and hashes[2] != hashes[4]


def brute_phrases(text: str, known: str) -> int:
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in known:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_equal_a_search_by_hand():
    known = "abracadabra banana " * 3
    automaton = langid.Automaton(known)
    texts = ["banana split", "cadabra", "xyz", "a", "nanabra ab" * 40]
    for text in texts:
        codes, _ = langid.letters([text])
        grid = codes.reshape(-1, 1)
        got = automaton.phrases(grid, np.ones(len(codes), int))[0]
        assert got == brute_phrases("".join(map(chr, codes)), "".join(map(chr, langid.letters([known])[0])))


def test_languages_and_odd_rows(docs, odd):
    table = docs([(10 + i, PROSE[lang], lang) for i, lang in enumerate(["en", "de"] * 3)]
                 + [(20, PROSE["de"][:60] * 300), (21, "12345 !!")] + odd)
    rows = {r["doc_id"]: r for r in langid.predict(table, langid.fit(table)).collect()}
    assert [rows[10 + i]["lang_pred"] for i in range(6)] == ["en", "de"] * 3
    assert rows[20]["lang_pred"] == "de"
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3, 21))
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_nothing_learned_and_empty(docs):
    unlabelled = docs([(1, "some text")])
    assert langid.predict(unlabelled, langid.fit(unlabelled)).first()["lang_pred"] == "und"
    assert langid.predict(docs([]), {}).count() == 0
