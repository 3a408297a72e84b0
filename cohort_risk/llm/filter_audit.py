"""How five document filters interact, by the potential of the removal game.

Each document gets a mask of the filters it fails, in Spark expressions over its whole text.
The corpus then shrinks to counts per (part, mask, good, toxic): at most 32 masks times
four label pairs a part, however many documents there are. For a set T of filters, the
removal game's worth v(T) is the number of documents that fail at least one filter of T
(and likewise the good and the toxic ones among them).

Per part, the Hart and Mas-Colell potential is computed over the 32 coalitions, smallest
first: ``P(empty) = 0`` and ``P(T) = (v(T) + sum over i in T of P(T - i)) / |T|``. The
Shapley value of filter i is ``P(all) - P(all - i)``; ``shapley`` reports it times 5! = 120,
the filter's removals summed over all orders, an integer. Every step of every order is a
difference of two coalitions: the filter removes ``v(before + i) - v(before)`` there.

Fixed values of the contract, stated plainly:
  A: fewer than 100 words; B: 100 * distinct words < 80 * words;
  C: 100 * characters of [A-Z] > 10 * code points; D: holds one of # $ % & * |;
  E: the same text as a row of a smaller id, anywhere in the table.
Words are maximal runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return; case counts.
"""

from __future__ import annotations

import itertools
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = "#$%&*|"


def failures(docs: DataFrame, labels: DataFrame | None = None, text_col: str = "text",
             id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """Per row: part, mask (bit k for filter k of ABCDE), good, toxic.

    Null texts are empty (they fail A, and E when a smaller id has an empty or null text);
    a null part is the empty string. A null id never fails E, since no id is smaller than
    it, and has no labels. Labels count if any row of the id says 1.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    trimmed = F.trim(F.col("t"), F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
    n = F.size(words)
    upper = F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    bits = [n < MIN_WORDS,
            100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
            100 * upper > UPPER_PERCENT * F.length("t"),
            F.length("t") != F.length(F.translate("t", SYMBOLS, ""))]
    flagged = rows.select("id", "part", F.sha2("t", 256).alias("digest"), F.length("t").alias("len"),
                          sum(F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)).alias("mask"))
    # the smallest id of each text; partial aggregation meets copies in their own tasks first
    first = flagged.groupBy("digest", "len").agg(F.min("id").alias("first_id"))
    out = flagged.join(first, ["digest", "len"]).select(
        "id", "part", (F.col("mask") + F.when(F.col("id") > F.col("first_id"), 1 << 4).otherwise(0)).alias("mask"))
    if labels is None:
        return out.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return out.join(marks, "id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def worth(counts: dict[int, tuple[int, int, int]], coalition: int) -> tuple[int, int, int]:
    """Documents, good ones and toxic ones that fail a filter of ``coalition`` (a bit set)."""
    hit = [c for mask, c in counts.items() if mask & coalition]
    return tuple(sum(c[k] for c in hit) for k in range(3))


def potentials(values: list[int]) -> list[Fraction]:
    """The Hart and Mas-Colell potential of each of the 32 coalitions of a game."""
    p = [Fraction(0)] * 32
    for t in sorted(range(1, 32), key=lambda s: bin(s).count("1")):
        members = [i for i in range(5) if t >> i & 1]
        p[t] = (values[t] + sum(p[t & ~(1 << i)] for i in members)) / len(members)
    return p


def audit_part(part: str, counts: dict[int, tuple[int, int, int]]) -> list[dict]:
    """600 rows of one part: each order and step of it."""
    worths = [worth(counts, t) for t in range(32)]
    p = potentials([w[0] for w in worths])
    total = sum(c[0] for c in counts.values())
    shapley = [(p[31] - p[31 & ~(1 << i)]) * 120 for i in range(5)]
    fails = [worths[1 << i][0] for i in range(5)]
    unique = [counts.get(1 << i, (0, 0, 0))[0] for i in range(5)]
    out = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            i = FILTERS.index(letter)
            after = before | 1 << i
            removed = worths[after][0] - worths[before][0]
            out.append({"part": part, "filter_order": order, "step": step, "letter": letter,
                        "kept": total - worths[after][0], "removed": removed,
                        "redundant": fails[i] - removed, "unique_fails": unique[i],
                        "good_lost": worths[after][1] - worths[before][1],
                        "toxic_lost": worths[after][2] - worths[before][2],
                        "shapley": int(shapley[i])})
            before = after
    return out


_OUT = ("part string, filter_order string, step int, letter string, kept long, removed long, "
        "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def _audit(rows: pd.DataFrame) -> pd.DataFrame:
    counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in
              zip(rows["mask"], rows["n"], rows["n_good"], rows["n_toxic"])}
    return pd.DataFrame(audit_part(rows["part"].iloc[0], counts))


def audit(docs: DataFrame, labels: DataFrame | None = None, **names: str) -> DataFrame:
    """Per part, order of ABCDE and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Every part with a document gets all 600 rows, zeros included; an empty table gives none.
    """
    counts = (failures(docs, labels, **names).groupBy("part", "mask")
              .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"),
                   F.count_if("toxic").alias("n_toxic")))
    return counts.groupBy("part").applyInPandas(_audit, _OUT)
