import base64
import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohort_risk.llm import licenses, quality, secrets, toxicity
from cohort_risk.llm.license_texts import TEMPLATES

from .conftest import PROSE, long_text


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        covered |= {i, i + 1, i + 2} if often[w] > 1 else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_counts(docs, odd):
    texts = ["a b c a b c", "a a a a", "x y", "one\none\n \n \none", "#a *b $c", "a b c d a b c e b c d", long_text(1, 400),
             "p q r " * 60 + long_text(2, 20), "\x1c\x85 wörd"]
    table = docs([(100 + i, t, "en") for i, t in enumerate(texts)] + odd)
    for row in quality.assess(table).select("row.text", *COUNTS, "base_failed", "kept").collect():
        want = base(row["text"])
        assert tuple(row[c] for c in COUNTS) == want
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_quality_verdicts(docs):
    def prose(seed, n=150):
        words = PROSE["en"].split() + ["houses", "walking", "yellow", "morning"] * 3
        return " ".join(words[(i * i + seed * i + i // 7) % len(words)] + ("." if i % 9 == 8 else "") for i in range(n))

    good = [(i, prose(i), "en") for i in range(2, 30)]
    bad = [(90, " ".join(w.upper() + "!!" for w in prose(3).split()), "en"),
           (91, "### ".join(prose(4).split()), "en"),
           (92, " ".join(f"{i}7{i}4" for i in range(150)), None)]
    rows = quality.assess(docs(good + bad + [(93, prose(5), None)])).select("row.doc_id", "base_failed", "kept").collect()
    for row in rows:
        if not row["base_failed"]:
            assert row["kept"] == (row["doc_id"] not in (90, 91, 92)), row
    assert quality.assess(docs([])).count() == 0
    assert quality.assess(docs([(1, None), (1, None)])).filter("kept").count() == 0


def test_distance(spark):
    frame = spark.createDataFrame([([1, 1],), ([2, 0],), ([0, 0],)], "h array<bigint>")
    same, other, none = (r[0] for r in frame.select(quality.distance(F.col("h"), [5, 5])).collect())
    assert same == 0 and other == pytest.approx(0.5579, abs=1e-4) and none is None
    assert frame.select(quality.distance(F.col("h"), [0, 0])).first()[0] is None


def brute_spans(text):
    names = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in names.finditer(text) if len(m[2]) >= 12]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(found)


SECRETS = [
    "é password='hunter2hunter2' and token: short, API_KEY = abcdefghijklmnop",
    "token: secret=\"abcdefghijklmnop\"", "AKIAAKIAAKIAAKIAAK AKIA12", "0123456789abcdef0 0123456789abcde",
    "token=" + "a" * 500, "secret = 🎉 passwd:0123456789abcdef", "paſſword=abcdefghijklmnop", "no\nsecret:\n here",
]


def test_secrets(docs, odd):
    table = docs([(100 + i, t) for i, t in enumerate(SECRETS)] + odd)
    model = secrets.train(secrets.labelled_samples(table))
    for row in secrets.scan(table, model, keep=("text",)).collect():
        want = brute_spans(row["text"] or "")
        assert [tuple(s) for s in row["base"]] == want
        assert [tuple(s) for s in row["spans"] if s["kind"] < 3] == want
        assert list(row["spans"]) == sorted(row["spans"])
    shown = secrets.scan(table, model).select("doc_id", secrets.joined(F.col("base"))).filter("doc_id = 102").first()[1]
    assert shown == "access:0:18"
    assert hashlib.sha256(b"").hexdigest() == table.select(F.sha2(F.lit(""), 256)).first()[0]


def test_character_models(docs, spark):
    random_text = " ".join("token=" + base64.b64encode(hashlib.sha512(str(i).encode()).digest()).decode() for i in range(300))
    words = docs([(i, long_text(i, 300) + " informationalMessage customerAddressList " * 9) for i in range(4)] + [(9, random_text)])
    model = secrets.train(secrets.labelled_samples(words))
    table = docs([(1, "say x9Kq7Lw2Zr8Vt3Bn0Pm5 now"), (2, "say informationalAddressMessage now")])
    rows = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(table, model).collect()}
    assert rows == {1: [(4, 3, 24)], 2: []}
    nothing = secrets.train(secrets.labelled_samples(docs([])))
    assert set(nothing) == {0.0}
    assert secrets.scan(docs([]), nothing).count() == 0


def test_licenses(docs, odd):
    mit = TEMPLATES["MIT"].replace("sublicense", "sublicence")
    text = f"é Intro. {mit} middle {TEMPLATES['BSD-3-Clause']} x {TEMPLATES['Apache-2.0 header'].upper()}"
    plain = "We released the MIT study under a license of the general public."
    table = docs([(100, text), (101, plain), (102, "Released under the MIT License. " * 3),
                  (103, long_text(1, 5000) + " Licensed under CC BY-NC 4.0."), (104, "the MIT")] + odd)
    found = {r["doc_id"]: r["found"] for r in licenses.scan(table).collect()}
    assert [h["license"] for h in found[100]] == ["MIT", "BSD-3-Clause", "Apache-2.0 header"]
    assert 0.98 < found[100][0]["coverage"] < 1 and text[found[100][0]["start"]:].startswith("Permission is hereby")
    assert found[101] == [] and found[104] == [] and all(found[i] == [] for i in (1, 2, 3, None))
    assert [(h["start"], h["end"]) for h in found[102]] == [(i * 32, i * 32 + 30) for i in range(3)]
    assert [h["license"] for h in found[103]] == ["CC-BY-NC-4.0 notice"]
    assert licenses.scan(docs([])).count() == 0


def test_every_template_is_found_in_noise():
    index = licenses.Index(TEMPLATES)
    for name, text in TEMPLATES.items():
        found = licenses.find([long_text(1, 40) + "\n" + text + "\n" + long_text(2, 40)], index)[0]
        assert [h["license"] for h in found] == [name] and found[0]["coverage"] == 1


def test_toxicity_learns_sentences_from_documents(docs, spark, odd):
    def text(i, toxic):
        sentences = [long_text(i * 7 + j, 8) for j in range(6)]
        if toxic:
            sentences[i % 6] += f" you {['scumbag', 'blighter'][i % 2]}{'s' * (i % 3 == 0)}"
        return ". ".join(sentences) + "."

    rows = [(i, text(i, i % 4 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    table = docs(rows + [(1000 + (r[0] or 0), r[1]) for r in odd])
    model = toxicity.fit(table, labels)
    scored = {r["doc_id"]: r for r in toxicity.score(table, model, spans=True).collect()}
    for i, body in rows[300:]:
        row = scored[i]
        assert (row["score"] >= 0.5) == (i % 4 == 0)
        if i % 4 == 0:
            assert [body[s["start"]:s["end"]].find("you ") >= 0 for s in row["offending"]] == [True]
    assert all(scored[1000 + i]["score"] == 0 for i in (1, 2, 3))
    long_clean = docs([(1, ". ".join(long_text(i, 8) for i in range(1, 3000, 2)))])
    assert toxicity.score(long_clean, model).first()["score"] < 0.5


def test_toxicity_without_labels(docs, spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs([(1, "x")]), empty)
    assert toxicity.score(docs([(1, "x"), (2, None)]), model).filter("score = 0").count() == 2
    assert toxicity.score(docs([]), model).count() == 0
