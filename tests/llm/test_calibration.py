import pytest
from pyspark.sql import functions as F

from cohort_risk.llm import mixing

from .conftest import long_text


def off(found, dimension, goal):
    """Largest relative distance of expected sample shares from their targets."""
    due, whole = {}, 0.0
    for r in found:
        due[r[dimension]] = due.get(r[dimension], 0) + r["p"] * r["n_tokens"]
        whole += r["p"] * r["n_tokens"]
    return max(abs(due[k] / whole / (g / sum(goal.values())) - 1) for k, g in goal.items())


@pytest.mark.parametrize("calibrated", [False, True])
def test_expected_sample_meets_its_targets(docs, spark, calibrated):
    rows = [(i, long_text(i, 40 + 90 * (i % 3 > 0)), "en" if i % 4 else "de", f"s{i % 10 // 4}") for i in range(600)]
    goal = {"source": {"s0": 1.0, "s1": 1.0, "s2": 1.5}, "lang": {"en": 2.0, "de": 1.0}, "topic": {"brief": 1.0, "article": 4.0}}
    targets = {d: spark.createDataFrame(list(g.items()), f"{d} string, goal double") for d, g in goal.items()}
    found = mixing.weigh(docs(rows), targets=targets, calibrated=calibrated).select(
        *mixing.DIMENSIONS, "n_tokens", "p", "weight").collect()
    worst = max(off(found, d, g) for d, g in goal.items())
    assert all(0 < r["p"] <= 1 for r in found)
    assert worst < 3 * mixing.TOLERANCE if calibrated else worst > 0.02  # probabilities cut at 1 miss them


def test_calibration_of_tables_without_tokens(docs, odd):
    assert mixing.weigh(docs([]), calibrated=True).count() == 0
    assert all(0 < r["p"] <= 1 for r in mixing.weigh(docs(odd), calibrated=True).collect())
    assert mixing.weigh(docs([(1, None), (2, "")]), calibrated=True).filter(F.col("p") > 0).count() == 2
