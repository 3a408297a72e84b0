import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from cohort_risk.llm import filter_audit, fingerprints, whitening
from tests.llm.conftest import ODD, long_text


# ---- op11: Lempel-Ziv phrase fingerprints

def _lz_strings(text):
    """LZ78 phrases as strings, the plain way."""
    seen, phrase = set(), ""
    for ch in text:
        phrase += ch
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def test_phrases_of_a_known_parse():
    # a | b | ab | aba | b: the last phrase repeats one and is not new
    assert len(fingerprints.phrases("abababab")) == 4
    assert _lz_strings("abababab") == {"a", "b", "ab", "aba"}
    assert fingerprints.phrases("") == []
    assert fingerprints.fingerprint("") == fingerprints.EMPTY


@pytest.mark.parametrize("a, b", [("", ""), ("abc", ""), ("", "xyz"), ("abababab", "cdcd"),
                                  (long_text(5, 2000), long_text(6, 10)), ("x" * 999, "y" * 9999)])
def test_shared_parse_equals_two_parses(a, b):
    edited = fingerprints.edit(a, b)
    assert fingerprints.pair(a, b) == (fingerprints.fingerprint(a), edited, fingerprints.fingerprint(edited))


def _lz_hashes(text):
    """Phrase hashes from the definition, as Python integers."""
    hash_of, phrase = {"": 0}, ""
    for ch in text:
        if phrase + ch in hash_of:
            phrase += ch
        else:
            hash_of[phrase + ch] = (hash_of[phrase] * fingerprints.BASE + ord(ch) + 1) % fingerprints.PRIME
            phrase = ""
    return list(hash_of.values())[1:]


def test_hashes_follow_their_definition():
    for text in ("", "abababab", "x" * 3000, "Zürich 日本 \U0010ffff" * 40, long_text(3, 2000)):
        assert fingerprints.phrases(text) == _lz_hashes(text)


def test_pairs_of_many_texts_in_small_slices():
    texts = ["", "abc", "x" * 999, long_text(5, 300), "", "Zürich " * 40, "日本語" * 30]
    following = texts[1:] + texts[:1]
    assert list(fingerprints.pairs(texts, following, chars=50)) == [
        fingerprints.pair(a, b) for a, b in zip(texts, following)]


def test_the_shared_start_is_mixed_once(monkeypatch):
    mixed, mix = [], fingerprints._mix
    monkeypatch.setattr(fingerprints, "_mix", lambda x: mixed.append(len(x)) or mix(x))
    a, b = long_text(5, 2000), long_text(6, 2000)
    fingerprints.pair(a, b)
    start = a[:len(a) - len(a) // 4]
    own, edited = len(_lz_strings(a)), len(_lz_strings(fingerprints.edit(a, b)))
    assert sum(mixed) == own + edited - len(_lz_strings(start))


def test_likeness_estimates_jaccard_of_phrase_sets():
    for seed in range(4):
        a = long_text(seed, 400)
        b = fingerprints.edit(a, long_text(seed + 9, 400))
        sa, sb = _lz_strings(a), _lz_strings(b)
        jaccard = len(sa & sb) / len(sa | sb)
        assert len(sa) == len(fingerprints.phrases(a))
        assert abs(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - jaccard) < 0.2


def _brute(rows):
    """The whole query in plain Python: order by id (nulls last), next row cyclic."""
    items = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(items):
        following = items[(k + 1) % len(items)][1]
        e = fingerprints.edit(t, following)
        fp, efp, nfp = (fingerprints.fingerprint(x) for x in (t, e, following))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp, efp,
                    fingerprints.likeness(fp, efp), fingerprints.likeness(fp, nfp)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_edited_equals_brute_force_over_task_boundaries(docs, partitions):
    rows = [*ODD, (9, long_text(1, 3000)), (10, long_text(1, 3000)), (11, "x" * 50), (12, "Zürich " * 9)]
    got = fingerprints.edited(docs(rows), partitions=partitions).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute([(r[0], r[1]) for r in rows])


def test_equal_texts_equal_fingerprints_and_empty_table(docs, spark):
    got = {r.doc_id: r for r in fingerprints.edited(docs([(1, "same text"), (2, "same text"), (3, "")])).collect()}
    assert got[1].fingerprint == got[2].fingerprint
    assert got[3].fingerprint == fingerprints.EMPTY and got[3].n_chars == 0
    assert got[2].near_next == 0.0 and got[1].near_next == 1.0
    assert fingerprints.edited(docs([(1, "x")]).limit(0)).count() == 0


# ---- op12: whitening

EMB = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("x", T.StringType()), T.StructField("n", T.StringType())])


def _emb(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], EMB)


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(v) for v in base[i]]) for i in range(300)]
    rows += [(1, rows[1][1]), (1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002, [float("nan")] * 6),
             (1003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (None, rows[5][1])]
    df = _emb(spark, rows)
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    x = np.floor(np.float32(base).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    assert model["n"] == n and [int(t) for t in model["sums"]] == list(s)
    assert np.allclose(model["values"], e, rtol=1e-9)
    assert np.allclose(np.abs((model["vectors"] * u).sum(axis=0)), 1, atol=1e-9)
    assert model["identity_error"] < 1e-9
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == 6 * 302  # 300 rows, the repeated one and the null id
    signs = np.sign((model["vectors"] * u).sum(axis=0))
    w = ((x - s / n) @ u) / np.sqrt(e) * signs
    for i in (0, 7, 299):
        for c in range(6):
            r = by[(i, c + 1)]
            assert r.whitened == pytest.approx(w[i, c], abs=1e-9)
            assert r.deviation == int(((n * x[i] - s) ** 2).sum())
            assert r.explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
            assert r.n == n


def test_whitening_rank_deficient_and_empty(spark):
    rows = [(i, [float(i % 5) / 8, float(i % 5) / 8, 0.5]) for i in range(40)]
    model = whitening.fit(_emb(spark, rows))
    assert len(model["values"]) == 1 and model["identity_error"] < 1e-9
    assert whitening.whiten(_emb(spark, rows), model).count() == 40
    empty = _emb(spark, [(1, None)])
    model = whitening.fit(empty)
    assert model["n"] == 0 and whitening.whiten(empty, model).count() == 0


def test_pivoted_cholesky_and_jacobi():
    a = np.random.default_rng(1).normal(size=(8, 5))
    c = a @ a.T
    low, perm = whitening.pivoted_cholesky(c)
    assert low.shape == (8, 5)
    assert np.allclose(c[perm][:, perm], low @ low.T)
    e, u = whitening.eigen(c)
    assert np.allclose(np.sort(e)[::-1], np.linalg.eigvalsh(c)[::-1][:5], rtol=1e-10)
    assert np.allclose(u.T @ u, np.eye(5), atol=1e-12)


# ---- op13: filter audit

def _mask(text, i, rows):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", t) if w]
    bits = [len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * sum("A" <= ch <= "Z" for ch in t) > 10 * len(t), any(ch in "#$%&*|" for ch in t),
            i is not None and any(j is not None and j < i and (u or "") == t for j, u in rows)]
    return {f for f, b in zip("ABCDE", bits) if b}


def _brute_audit(rows, labels):
    # a null id has no labels
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = [((lang or ""), _mask(t, i, [(j, u) for j, u, *_ in rows]), i in good, i in toxic)
            for i, t, lang, *_ in rows]
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in ("".join(p) for p in itertools.permutations("ABCDE")):
            gone = set()
            for step, f in enumerate(order, 1):
                here = [k for k, d in enumerate(mine) if f in d[1] and k not in gone]
                shap = sum(120 // len(d[1]) for d in mine if f in d[1])
                out[(part, order, step)] = (
                    f, len(mine) - len(gone) - len(here), len(here),
                    sum(1 for k, d in enumerate(mine) if f in d[1] and k in gone),
                    sum(1 for d in mine if d[1] == {f}), sum(mine[k][2] for k in here),
                    sum(mine[k][3] for k in here), shap)
                gone |= set(here)
    return out


def test_audit_equals_brute_force(docs, spark):
    prose = long_text(2, 120)
    rows = [(1, prose, "en"), (2, prose, "en"), (3, prose.upper(), "en"), (4, prose + " #", None),
            (5, "short text", "de"), (None, prose, "en"), (6, None, "de"), (7, "", "de"), (7, "", "de"),
            (8, " ".join(["same"] * 150), "en"), (9, long_text(3, 5000), "en"), *ODD]
    rows = [(r + (None,))[:3] for r in rows]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, 1, 1), (None, 1, 1), (99, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs(rows), lab).collect()
    want = _brute_audit(rows, labels)
    assert len(got) == len(want) == 600 * len({(r[2] or "") for r in rows})
    for r in got:
        assert (r.letter, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                r.shapley) == want[(r.part, r.filter_order, r.step)]


def test_potential_gives_shapley_and_empty_table(docs, spark):
    counts = {0b00001: (3, 0, 0), 0b00011: (2, 1, 0), 0b11111: (5, 0, 5), 0: (7, 7, 0)}
    rows = filter_audit.audit_part("p", counts)
    shap = {r["letter"]: r["shapley"] for r in rows}
    assert shap == {"A": 3 * 120 + 2 * 60 + 5 * 24, "B": 2 * 60 + 5 * 24, "C": 120, "D": 120, "E": 120}
    assert sum(r["removed"] for r in rows if r["filter_order"] == "EDCBA") == 10
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs([(1, "x")]).limit(0), lab).count() == 0
