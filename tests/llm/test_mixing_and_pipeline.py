import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohort_risk.llm import mixing, queries

from .conftest import long_text


def test_totals_meet_their_targets(spark):
    cells = spark.createDataFrame(
        [(s, g, t, 100 * (1 + i * 3) * (2 + j) * (1 + k)) for i, s in enumerate("abc") for j, g in enumerate(["x", "y"])
         for k, t in enumerate("pq")] + [("a", "x", "r", 0)], "source string, lang string, topic string, tokens long")
    goal = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("unused", 9.0)], "source string, goal double")
    raked = mixing.rake(cells, {"source": goal, "lang": mixing.tempered(cells, "lang", 0.0),
                                "topic": mixing.tempered(cells, "topic", 1.0)}, rounds=8)
    w = F.sum(F.col("tokens") * F.col("multiplier"))
    total = cells.agg(F.sum("tokens")).first()[0]
    share = {r[0]: r[1] / total for r in raked.groupBy("source").agg(w).collect()}
    assert share == pytest.approx({"a": 0.25, "b": 0.25, "c": 0.5}, rel=1e-6)
    share = {r[0]: r[1] / total for r in raked.groupBy("lang").agg(w).collect()}
    assert share == pytest.approx({"x": 0.5, "y": 0.5}, rel=1e-6)
    assert raked.count() == 13


def test_draws_follow_probabilities(docs, odd):
    rows = [(i, long_text(i % 5, 40 if i % 2 else 150), "en", "big" if i % 10 else f"s{i % 3}") for i in range(1000)]
    found = mixing.weigh(docs(rows)).select("row.doc_id", "p", "sampled", "source").collect()
    for source in ("big", "s0", "s1", "s2"):
        mine = [r for r in found if r["source"] == source]
        kept, due = sum(r["sampled"] for r in mine), sum(r["p"] for r in mine)
        assert abs(kept - due) <= 4 * (sum(r["p"] * (1 - r["p"]) for r in mine) + 0.1) ** 0.5
    assert max(r["p"] for r in found) <= 1
    again = {r["doc_id"]: r["sampled"] for r in mixing.weigh(docs(rows[::-1])).select("row.doc_id", "sampled").collect()}
    assert again == {r["doc_id"]: r["sampled"] for r in found}
    odd_rows = mixing.weigh(docs(odd)).collect()
    assert len(odd_rows) == len(odd) and all(0 < r["p"] <= 1 for r in odd_rows)
    assert mixing.weigh(docs([])).count() == 0


@pytest.mark.parametrize("rows", ["some", "none"])
def test_stages_over_odd_tables(docs, odd, spark, tmp_path, rows):
    english = [(100 + i, long_text(i, 120 + i), "en", "web") for i in range(12)]
    english += [(200, english[0][1] + " "), (201, english[1][1].replace("stone", "rock", 1), "en"), (202, english[2][1])]
    table = docs((english + odd) if rows == "some" else [])
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    read = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, read, folder)
        assert out.columns == table.columns, name
        counts.append(out.count())
    result = corpus_pipeline.run(spark, folder)
    left = {r["doc_id"]: r for r in result.collect()}
    assert all(r["round_trip"] for r in left.values())
    if rows == "none":
        assert not left
    else:
        assert not {200, 202, 1, 2, 3, 4, 5} & left.keys()
        texts = {r["doc_id"]: r["text"] for r in read.collect()}
        assert all(len(r["ids"]) == r["n_tokens"] > 0 and texts[i] for i, r in left.items())


def test_sql_of_mixing_and_quality_runs(docs, tmp_path, odd):
    rows = [r for r in odd if r[0] is not None and r[0] != 5] + [(100 + i, long_text(i, 60 + 20 * i), "en", "a" if i % 3 else None) for i in range(9)]
    table = docs(rows)
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text", "lang", "source").toArrow())
    for name in ("op4_quality_rules", "op9_mixing", "op2_exact_dedup"):
        path = tmp_path / name
        table.write.parquet(str(path / "documents.parquet"))
        got = sorted(map(tuple, queries.QUERIES[name](table.sparkSession, str(path)).collect()), key=str)
        columns = ", ".join(queries.QUERIES[name](table.sparkSession, str(path)).columns)
        want = sorted(con.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall(), key=str)
        assert got == want, name
