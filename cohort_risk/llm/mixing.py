"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The token weights of the cells are
raked: multiplied, one dimension after the other, so that the totals of each dimension meet
their targets, in a fixed number of rounds. The multiplier of its cell, times the share to keep,
is the probability that a document is sampled with, and at most 1. ``calibrate`` rakes these
bounded probabilities themselves, until the sample is expected to meet all targets. The draw is
a hash of the document's id.

Cells, totals and factors stay tables, as sources may be many; only documents are joined to
their cell, on keys that adaptive execution can split.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.session import stored

#: Share of all tokens to keep, exponent of a total's target, rounds of raking.
KEEP, EXPONENT, ROUNDS = 0.75, 0.8, 6
#: Relative error of a total that calibration may leave, its rounds at most, and after how many
#: rounds that did not halve the error the share to keep is lowered by what factor.
TOLERANCE, MOST_ROUNDS, PATIENCE, LOWER = 1e-3, 90, 6, 0.9
NONE = "(none)"
SALT = "mix"

DIMENSIONS = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space, as the token weight; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def form(text: Column, tokens: Column) -> Column:
    """A topic where documents carry none: tables, and prose by length."""
    return (F.when(F.coalesce(F.contains(text, F.lit(" | ")), F.lit(False)), "table")
            .when(tokens < 100, "brief").when(tokens < 1000, "article").otherwise("book"))


def tempered(cells: DataFrame, dimension: str, exponent: float = EXPONENT) -> DataFrame:
    """Targets of a dimension: its totals to a power, so that large values give way to small."""
    return (cells.groupBy(dimension).agg(F.sum("tokens").alias("goal"))
            .withColumn("goal", F.pow(F.col("goal").cast("double"), F.lit(exponent))))


def _in_tokens(cells: DataFrame, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Targets of the values that occur, scaled to the tokens of all cells."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = {}
    for dimension, goal in targets.items():
        present = cells.select(dimension).distinct().join(goal, dimension)
        whole = present.agg(F.sum("goal")).first()[0]
        goals[dimension] = stored(
            present.select(dimension, (F.col("goal") / (whole or 1.0) * total).alias("goal")), "goals")
    return goals


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens) with the ``multiplier`` that meets the targets.

    Targets are tables (value, goal) by dimension, in any unit. A value without a goal, and a
    cell without tokens, keep their weight in that dimension.
    """
    cells = stored(cells.withColumn("multiplier", F.lit(1.0)), "cells")
    goals = _in_tokens(cells, targets)
    for _ in range(rounds):
        for dimension, goal in goals.items():
            now = cells.groupBy(dimension).agg(F.sum(F.col("tokens") * F.col("multiplier")).alias("now"))
            factor = now.join(goal, dimension, "left").select(
                dimension, F.when((F.col("now") > 0) & (F.col("goal") > 0), F.col("goal") / F.col("now"))
                .otherwise(F.lit(1.0)).alias("factor"))
            cells = cells.join(factor, dimension).withColumn(
                "multiplier", F.col("multiplier") * F.col("factor")).drop("factor")
        cells = stored(cells, "cells")
    return cells


def calibrate(cells: DataFrame, targets: dict[str, DataFrame], keep: float = KEEP,
              tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS) -> DataFrame:
    """``cells`` with the probability ``p`` that makes the expected sample meet the targets.

    Cells at p = 1 are held, and the others of a value take up what is left of its goal. The
    sample is ``keep`` of all tokens, or less where a value, or values that meet in the same cells,
    have too few tokens for their goals. ``weight`` is p by the share that was kept.
    """
    cells = stored(cells.withColumns({"u": F.lit(keep), "off": F.lit(0.0)}), "cells")
    goals, share = _in_tokens(cells, targets), keep
    for dimension, goal in goals.items():  # no value can give more than it has
        has = cells.groupBy(dimension).agg(F.sum("tokens").alias("has")).filter("has > 0").join(goal, dimension)
        least = has.filter("goal > 0").agg(F.min(F.col("has") / F.col("goal"))).first()[0]
        share = min(share, least or share)
    p, tokens, errors = F.least(F.lit(1.0), F.col("u")), F.col("tokens"), []
    for _ in range(rounds):
        cells = cells.withColumn("off", F.lit(0.0))
        for dimension, goal in goals.items():
            now = cells.groupBy(dimension).agg(
                F.sum(tokens * p).alias("now"),
                F.sum(F.when(F.col("u") >= 1, tokens).otherwise(0)).alias("held"))
            due, free = F.col("goal") * share, F.col("now") - F.col("held")
            asked = (F.col("now") > 0) & (due > 0)
            factor = now.join(goal, dimension, "left").select(
                dimension,
                F.when(asked & (due <= F.col("now")), due / F.col("now"))
                .when(asked & (free > 1e-9 * F.col("now")), (due - F.col("held")) / free)
                .otherwise(1.0).alias("factor"),
                F.when(asked, F.abs(F.col("now") / due - 1)).otherwise(0.0).alias("miss"))
            cells = cells.join(factor, dimension).withColumns({
                "u": F.col("u") * F.col("factor"), "off": F.greatest("off", "miss")}).drop("factor", "miss")
        cells = stored(cells, "cells")
        errors.append(cells.agg(F.max("off")).first()[0] or 0.0)
        if errors[-1] <= tolerance:
            break
        if len(errors) > PATIENCE and errors[-1] > errors[-1 - PATIENCE] / 2:
            share, errors = share * LOWER, []
    else:
        warnings.warn(f"calibration left a relative error of {(errors or [float('nan')])[-1]:.2g}")
    return cells.withColumns({"p": p, "weight": p / share}).drop("u", "off")


def draw(id_col: Column, salt: str = SALT) -> Column:
    """A number in [0, 1) from the hash of an id, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** 13))


def weigh(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", topic: Column | None = None,
          targets: dict[str, DataFrame] | None = None, keep: float = KEEP,
          calibrated: bool = False) -> DataFrame:
    """Each row as the struct ``row`` with its cell, ``n_tokens``, ``weight``, ``p`` and ``sampled``.

    Targets default to tempered totals. A null source, language or topic is a value of its own.
    ``p`` is at most 1: cells that would have to be repeated are kept whole, and the sample misses
    its targets by what they lack, unless ``calibrated``. Rows that repeat an id are drawn alike.
    """
    tokens = n_tokens(F.col(text_col))
    named = {"source": F.col("source"), "lang": F.col("lang"),
             "topic": topic if topic is not None else form(F.col(text_col), tokens)}
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), tokens.alias("n_tokens"), *(
        F.coalesce(c.cast("string"), F.lit(NONE)).alias(name) for name, c in named.items()))
    cells = stored(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = targets or {d: tempered(cells, d) for d in DIMENSIONS}
    if calibrated:
        weights = calibrate(cells, goals, keep)
    else:
        weights = rake(cells, goals).select(*DIMENSIONS, F.col("multiplier").alias("weight"))
        weights = weights.withColumn("p", F.least(F.lit(1.0), F.col("weight") * keep))
    weights = weights.select(*DIMENSIONS, "weight", "p")
    return rows.join(weights, list(DIMENSIONS)).select(
        "row", *DIMENSIONS, "n_tokens", "weight", "p", (draw(F.col("_id")) < F.col("p")).alias("sampled"))


def oracle() -> str:
    """The same in SQL, with one view for each step of raking."""
    steps = []
    for i, dimension in enumerate(DIMENSIONS * ROUNDS):
        steps.append(f"""s{i + 1} AS (SELECT source, lang, topic, tokens, multiplier *
            CASE WHEN now > 0 AND goal > 0 THEN goal / now ELSE 1.0 END AS multiplier
            FROM (SELECT *, sum(tokens * multiplier) OVER (PARTITION BY {dimension}) AS now FROM s{i}) c
            JOIN g_{dimension} USING ({dimension}))""")
    goals = [f"""g_{d} AS (SELECT {d}, pow(t, {EXPONENT}) / (sum(pow(t, {EXPONENT})) OVER ()) * (sum(t) OVER ()) AS goal
        FROM (SELECT {d}, sum(tokens) AS t FROM s0 GROUP BY {d}))""" for d in DIMENSIONS]
    last = f"SELECT {', '.join(DIMENSIONS)}, multiplier AS weight FROM s{len(DIMENSIONS) * ROUNDS}"
    return rf"""
WITH n AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
r AS (SELECT *, CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN n_tokens < 100 THEN 'brief'
    WHEN n_tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM n),
s0 AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens, 1.0::DOUBLE AS multiplier FROM r GROUP BY ALL),
{", ".join(goals)},
{", ".join(steps)},
w AS ({last})
SELECT doc_id, source, lang, topic, n_tokens::BIGINT AS n_tokens, round(weight, 6) AS weight,
    round(least(1.0, weight * {KEEP}), 6) AS p,
    ('0x' || substr(md5('{SALT}' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {16 ** 13}
        < least(1.0, weight * {KEEP}) AS sampled
FROM r JOIN w USING (source, lang, topic)"""
