import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from cohort_risk.llm import dedup, near_dedup
from cohort_risk.session import stored

from .conftest import long_text


def test_exact_groups(docs, odd):
    table = docs(odd + [(8, "a \t b"), (9, "a b"), (10, "a  b "), (11, "a\x0bb")])
    rows = {(r["doc_id"], r["text_sha256"]): r for r in dedup.mark(table).collect()}
    by_id = {k[0]: r for k, r in rows.items()}
    assert by_id[2]["keep_id"] == by_id[1]["keep_id"] == 1 and by_id[1]["group_size"] == 2
    assert by_id[3]["group_size"] == 1  # one space isn't empty
    assert by_id[5]["keep_id"] == 4 and by_id[5]["group_size"] == 3 and not by_id[5]["kept"]
    assert {i for i in (8, 9, 11) if by_id[i]["keep_id"] == 8} == {8, 9, 11} and by_id[10]["kept"]
    assert by_id[None]["kept"]
    kept = dedup.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 7, 8, 10]


def test_exact_keep_one_equals_the_verdicts_row_by_row(docs):
    rows = [(1, "x"), (None, "x"), (None, "y"), (3, "b"), (5, "a"), (5, "b"), (6, "z"), (6, "z"),
            (7, long_text(1, 20_000)), (8, long_text(1, 20_000)), (9, None), (10, "")]
    table = docs(rows)
    kept = dedup.keep_one(table)
    assert kept.columns == table.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "x"), (None, "y"), (3, "b"), (5, "a"), (6, "z"), (6, "z"),
                          (7, long_text(1, 20_000)), (9, None)], key=repr)
    verdicts = [(r["doc_id"], r["text_sha256"]) for r in dedup.mark(table).collect() if r["kept"]]
    assert len(verdicts) == len(got)


def test_exact_hot_text_over_many_partitions(docs):
    table = docs([(i, "same" if i % 3 else f"own {i}") for i in range(600)]).repartition(40)
    found = dedup.mark(table, salts=4).collect()
    assert sum(r["kept"] for r in found) == 201
    assert {r["group_size"] for r in found} == {1, 400}
    assert dedup.mark(docs([])).count() == 0


def test_exact_keep_one_frees_the_content_shuffles_first(docs, monkeypatch):
    steps, stored, freed = [], dedup.stored, dedup.free_shuffles
    monkeypatch.setattr(dedup, "stored", lambda df, name: (stored(df, name), steps.append(name))[0])
    monkeypatch.setattr(dedup, "free_shuffles", lambda spark: (freed(spark), steps.append("freed"))[0])
    kept = dedup.keep_one(docs([(1, "x"), (2, "x"), (3, "y")]))
    assert steps == ["exact-kept", "freed"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_stored_frames_leave_no_shuffle(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*")}

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    kept = stored(df, "shuffled")
    deadline = time.time() + 10
    while files() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not files() - before
    assert sorted(kept.collect()) == sorted(df.collect())  # the frame itself can still be read


def test_exact_groups_combine_only_contents_that_repeat(docs, monkeypatch):
    joined, digests = [], dedup._digests
    monkeypatch.setattr(dedup, "_digests", lambda: joined.append(1) or digests())
    table = docs([(i, f"own {i}") for i in range(300)] + [(300 + i, "same") for i in range(40)])
    found = dedup.groups(table)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # contents meet the repeated digests before they are combined
    assert sorted((r["keep_id"], r["group_size"]) for r in found.collect()) == [
        *((i, 1) for i in range(300)), (300, 40)]
    assert len(joined) == 2


def test_near_keep_one_looks_up_the_dropped_ids(docs, monkeypatch):
    tables, stored = {}, near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, name, *tasks: tables.setdefault(
        (name, len(tables)), stored(df, name, *tasks)))
    text = long_text(1, 100)
    rows = [(1, text), (2, text), (2, "z"), (3, f"{text} more"), (4, long_text(2, 100)), (None, text), (None, text)]
    kept = near_dedup.keep_one(docs(rows)).collect()
    assert sorted((r["doc_id"] or 0 for r in kept)) == [0, 0, 1, 4]
    gone = [t for (name, _), t in tables.items() if name == "near-dropped"]
    assert len(gone) == 1 and sorted(r[0] for r in gone[0].collect()) == [2, 2, 3]


def test_small_tables_of_the_rounds_are_few_files(docs, spark):
    words = long_text(3, 200).split()
    table = docs([(i, " ".join([*words[:i % 190], f"v{i}", *words[i % 190 + 1:]])) for i in range(60)])
    most, kept = near_dedup.WAVES * spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    files, before = [], near_dedup.stored
    spark.conf.set("spark.sql.shuffle.partitions", str(8 * most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        near_dedup.stored = lambda df, name, *tasks: (
            out := before(df, name, *tasks), files.append(len(out.inputFiles())) if tasks else None)[0]
        found = near_dedup.classes(table).collect()
    finally:
        near_dedup.stored = before
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert {r["class_id"] for r in found} == {0}
    assert len(files) > 5 and max(files) <= most
    assert near_dedup.few_tasks(spark.range(200 * most * near_dedup.DOCUMENTS_PER_TASK)) == 200 * most


def similarity(a: str, b: str) -> float:
    def units(t):
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    x, y = units(a), units(b)
    return (x & y).total() / (x | y).total()


def test_signatures_agree_as_often_as_texts_are_similar():
    a, b = long_text(1, 300), " ".join(long_text(1, 300).split()[:260])
    sketch = near_dedup.signatures(*near_dedup.elements([a, b, a]), k=2000)
    assert (sketch[0] == sketch[2]).all()
    assert abs((sketch[0] == sketch[1]).mean() - similarity(a, b)) < 0.05
    heavy = ["x y z u v " * 50, "x y z u v " * 30]
    sketch = near_dedup.signatures(*near_dedup.elements(heavy), k=2000)
    assert abs((sketch[0] == sketch[1]).mean() - similarity(*heavy)) < 0.05


def brute_classes(rows):
    above = {i: i for i, _ in rows}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i
    for i, a in rows:
        for j, b in rows:
            if i < j and a.split() and b.split() and similarity(a, b) >= 0.8:
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in rows}


def test_classes_equal_all_pairs(docs):
    rng = random.Random(5)
    rows = []
    for seed in range(12):
        words = long_text(seed, 120 + 40 * (seed % 4)).split()
        for _ in range(1 + seed % 5):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(len(words))] = f"new{rng.random()}"  # a chain: ends may differ more
            words[rng.randrange(len(words))] = f"new{rng.random()}"
    passage = long_text(99, 60)
    rows += [(100 + i, passage + " " + long_text(200 + i, 60)) for i in range(15)]  # share half, not alike
    rows += [(200, "a b c"), (201, "a  b\nc"), (202, "a b d"), (203, "z " * 400), (204, "z " * 401)]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs(rows)).collect()}
    assert found == brute_classes(rows)


def test_large_group_of_near_copies(docs):
    words = long_text(3, 200).split()
    rows = [(i, " ".join([*words[:i % 190], f"v{i}", *words[i % 190 + 1:]])) for i in range(300)]
    found = near_dedup.classes(docs(rows)).collect()
    assert {r["class_id"] for r in found} == {0} and {r["class_size"] for r in found} == {300}
    assert [r["doc_id"] for r in found if r["kept"]] == [0]


def test_copies_with_many_and_few_changes(docs):
    rng = random.Random(9)
    words, rows = long_text(3, 150).split(), []
    for i in range(120):
        copy = list(words)
        for j in rng.sample(range(len(copy)), rng.randrange(1, 9)):
            copy[j] = f"w{i}x{j}" if rng.random() < 0.7 else f"shared{j % 3}"
        rows.append((i, " ".join(copy)))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs(rows)).collect()}
    assert found == brute_classes(rows)
    assert 2 < len(set(found.values())) < 118


def test_near_odd_rows(docs, odd):
    found = near_dedup.classes(docs(odd)).collect()
    assert len(found) == len(odd)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["class_id"] == 1 and by_id[2]["class_id"] == 2 and by_id[5]["class_id"] == 4
    assert by_id[None]["kept"] and by_id[None]["class_id"] is None
    assert near_dedup.classes(docs([])).count() == 0
    kept = near_dedup.keep_one(docs(odd))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7]


def test_darts_do_not_depend_on_the_batch():
    texts = [long_text(i, 50 + i) for i in range(20)]
    together = near_dedup.band_hashes(near_dedup.signatures(*near_dedup.elements(texts)))
    for i in (0, 7, 19):
        alone = near_dedup.band_hashes(near_dedup.signatures(*near_dedup.elements([texts[i]])))
        assert np.array_equal(alone[0], together[i])
