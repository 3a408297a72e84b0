"""Secret scans: fixed patterns, and character Markov models for what they miss.

Patterns are matched by cutting a text at its matches: the pieces between them and the matches
in turn give every start and end, in code points. Assignments are matched whatever the length
of their value, and short ones are dropped afterwards: they still use up their characters. For
the other kinds a least length in the pattern comes to the same.

Other long runs of key characters are scored by two first-order Markov models over characters,
one of random strings, one of ordinary identifiers. The mean log-likelihood ratio per step
decides. Both are trained from labelled samples. Column expressions only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns in the order of their kinds.
NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""(?i:({NAMES}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters that the models tell apart, and the runs that they judge.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = "[A-Za-z0-9+/_=-]{8,}"
#: Steps that a model expects of each character before it has seen any.
PRIOR = 10
#: Bits per step from which a run counts as random.
THRESHOLD = 1.0
#: Rows that labelled samples are taken from, about.
SAMPLE_ROWS = 5_000

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_N = len(ALPHABET) + 1


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, kind: int, group: int = 0,
            accept: Callable[[Column], Column] = lambda found: F.lit(True)) -> Column:
    """Spans of leftmost matches that don't overlap, with the matched text.

    Only those are kept whose ``group`` is accepted.
    """
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + F.length(row["piece"])
        end = begin + F.length(row["found"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), row["found"].alias("found"))
        return F.struct(end.alias("at"), F.when(
            accept(row["group"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("found"), groups.alias("group"))
    spans = F.aggregate(F.filter(rows, lambda row: row["found"].isNotNull()), start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, kind by kind."""
    assigned = matches(text, ASSIGN, 0, 2, lambda value: F.length(value) >= ASSIGN_LEAST)
    return F.concat(assigned, matches(text, ACCESS, 1), matches(text, HEX, 2))


def _apart(runs: Column, spans: Column) -> Column:
    """The runs that overlap no span."""
    return F.filter(runs, lambda r: ~F.exists(
        spans, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))


def _letters(value: Column) -> Column:
    """Numbers of the characters in the alphabet; 0 for any other."""
    return F.transform(F.array_remove(F.split(value, ""), ""), lambda c: F.instr(F.lit(ALPHABET), c))


def labelled_samples(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Strings with the label ``random``, from a bounded sample of rows.

    Values that the fixed patterns find are random; identifiers apart from them are ordinary.
    About ``sample_rows`` rows are read, chosen by the hash of their ids.
    """
    share = min(1.0, sample_rows / max(df.count(), 1))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a hash threshold of 2**-40 steps: the expected sample is sample_rows rows up to 10**15 rows
    rows = (df.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
            .select(base_spans(text).alias("base"), F.regexp_extract_all(
                F.regexp_replace(text, f"{ASSIGN}|{ACCESS}|{HEX}", " "), F.lit(IDENTIFIER), F.lit(0)).alias("runs")))
    strings = F.concat(
        F.transform("base", lambda s: F.struct(
            F.when(s["kind"] == 0, F.regexp_extract(s["found"], ASSIGN, 2)).otherwise(s["found"]).alias("value"),
            F.lit(True).alias("random"))),
        F.transform("runs", lambda s: F.struct(s.alias("value"), F.lit(False).alias("random"))))
    return rows.select(F.inline(strings))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio in bits of each step between two characters.

    A character that a model has seldom stepped from is followed by what it steps to at all.
    Models without samples are even, and their ratio is 0. What is collected is one number per
    model and pair of characters.
    """
    steps = samples.select("random", _letters(F.col("value")).alias("c")).filter(F.size("c") > 1).select(
        "random", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1),
                                       lambda a, b: a * _N + b)).alias("step"))
    count = {True: [0] * _N ** 2, False: [0] * _N ** 2}
    for row in steps.groupBy("random", "step").count().collect():
        count[row["random"]][row["step"]] += row["count"]
    rates = {}
    for label, c in count.items():
        to = [(1 + sum(c[b::_N])) / (_N + sum(c)) for b in range(_N)]
        rates[label] = [(n + PRIOR * to[i % _N]) / (sum(c[i - i % _N:i - i % _N + _N]) + PRIOR)
                        for i, n in enumerate(c)]
    return [math.log2(a / b) for a, b in zip(rates[True], rates[False])]


def ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per step of a string."""
    steps = F.from_json(F.lit(json.dumps(table)), "array<double>")  # folded into one constant
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        more = F.when(acc["last"] < 0, 0.0).otherwise(F.get(steps, acc["last"] * _N + c))
        return F.struct(c.alias("last"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(_letters(value), start, step, lambda acc: acc["sum"]) / (F.length(value) - 1)


def scan(df: DataFrame, table: list[float], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` with ``base`` and ``spans`` of every whole text.

    Both are arrays of (start, kind, end), sorted, in code points with the end exclusive; kind
    is a place in ``KINDS``. ``spans`` adds the runs that the models find apart from the base
    ones. A null text counts as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = lambda s: F.struct(s["start"], s["kind"], s["end"])
    found = _let(base_spans(text), lambda base: F.struct(
        F.array_sort(F.transform(base, plain)).cast(_SPAN).alias("base"),
        F.array_sort(F.concat(F.transform(base, plain), F.transform(_apart(
            matches(text, RUN, 3, accept=lambda run: ratio(run, table) >= threshold), base), plain)))
        .cast(_SPAN).alias("spans")))
    return df.select(*keep, found.alias("_found")).select(*keep, "_found.base", "_found.spans")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, separated by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
