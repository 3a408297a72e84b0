"""Quality rules by distribution divergence.

A text is compared with its language: the Jensen-Shannon distances of its character classes
and of its common words to the language's own distributions must stay within bounds. The
references are totals over all documents of the language that pass the base rules. Texts that
are too short for a distribution are judged by the base rules alone.

Column expressions only. Per-text counts are stored once; references and verdicts then read
the counts, never the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.session import stored

#: Base rules: fewest words, and the highest percentage of words in repeated three-word windows.
LEAST_WORDS, REPEATED = 50, 50
#: Highest distances, and the lengths from which they count.
CHAR_DISTANCE, WORD_DISTANCE = 0.28, 0.32
LEAST_CHARS, LEAST_COMMON = 200, 100

# Twenty frequent words of each language.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in a is that for it was on with as by at this from are be",
    "es": "de la que el en y los del se las por un para con no una su al lo como",
    "fr": "de la le et les des en un une du que est pour dans qui par sur au pas avec",
}
COMMON = {lang: words.split() for lang, words in COMMON.items()}

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Character classes besides white space, symbols and the rest.
CLASSES = (r"\p{Lu}", r"\p{L}", "[0-9]", "[.,;:!?'\"()-]")

ANY = "*"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeated(words: Column) -> Column:
    """Words in three-word windows that occur twice or more; windows compare by 64-bit hash."""
    windows = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))) \
        .otherwise(F.array().cast("array<bigint>"))

    def covered(sorted_windows: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            same = [F.coalesce(F.get(sorted_windows, i + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
            return same[0] | same[1]

        places = F.array_sort(F.transform(F.filter(sorted_windows, again), lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(places, start, lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")))["n"]

    return _let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered),
    ).otherwise(F.lit(0).cast("bigint")))


def _common(words: Column, listed: list[str]) -> Column:
    """How often each listed word occurs, and at last all other words."""
    return _let(F.array_remove(words, ""), lambda w: _let(
        F.filter(w, lambda x: x.isin(listed)),
        lambda c: F.array(*[(F.size(c) - F.size(F.array_remove(c, x))).cast("bigint") for x in listed],
                          (F.size(w) - F.size(c)).cast("bigint"))))


def counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
           keep: tuple[str, ...] = ("*",), common: dict[str, list[str]] = COMMON) -> DataFrame:
    """The columns ``keep`` of each row as the struct ``row``, with language key, base counts and histograms, stored.

    A null text has no words and no characters. A language without listed words, or null, has
    the key ``*``: it is compared by characters with all languages together.
    """
    rows = df.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                     F.when(F.col(lang_col).isin(list(common)), F.col(lang_col)).otherwise(F.lit(ANY)).alias("key"))
    t = F.col("t")
    words = F.array_remove(F.split(t, BLANK + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                                          _repeated(w).alias("n_repeat_words")))
    listed = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for lang, found in sorted(common.items()):
        listed = listed.when(F.col("key") == lang, _common(F.split(F.lower(t), r"[^\p{L}]+"), found))
    counted = rows.select(
        "row", "key", base.alias("base"), F.length(t).cast("bigint").alias("length"),
        F.length(F.regexp_replace(t, BLANK + "+", "")).cast("bigint").alias("word_chars"),
        _without(t, SYMBOLS).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        *[_without(t, c).cast("bigint").alias(f"c{i}") for i, c in enumerate(CLASSES)],
        listed.alias("common"))
    upper, letters, digits, marks = (F.col(f"c{i}") for i in range(4))
    blank = F.col("length") - F.col("word_chars")
    n_words, n_repeat = F.col("base.n_words"), F.col("base.n_repeat_words")
    return stored(counted.select(
        "row", "key", n_words.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        n_repeat.alias("n_repeat_words"),
        ((n_words < LEAST_WORDS) | (100 * n_repeat > REPEATED * n_words)).alias("base_failed"),
        F.array(upper, letters - upper, digits, marks, F.col("n_symbols"), blank,
                F.col("length") - letters - digits - marks - F.col("n_symbols") - blank).alias("chars"),
        "common"), "quality-counts")


def references(counted: DataFrame) -> dict[str, tuple[list[int], list[int] | None]]:
    """Totals of both histograms by language key, over rows that pass the base rules.

    One row per listed language is collected. ``*`` has the characters of all languages.
    """
    sums = [F.sum(F.col("chars")[i]).alias(f"h{i}") for i in range(len(CLASSES) + 3)]
    width = max(map(len, COMMON.values())) + 1
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(width)]
    found, total = {}, [0] * (len(CLASSES) + 3)
    for row in counted.filter("not base_failed").groupBy("key").agg(*sums).collect():
        chars = [row[f"h{i}"] for i in range(len(total))]
        total = [a + b for a, b in zip(total, chars)]
        words = [row[f"w{i}"] for i in range(width) if row[f"w{i}"] is not None]
        found[row["key"]] = (chars, words or None)
    return {**found, ANY: (total, None)}


def distance(histogram: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance (base 2) of counts to the counts of a reference; null if empty."""
    whole = sum(reference)
    expected = F.array(*[F.lit(n / whole if whole else 0.0) for n in reference])
    size = F.aggregate(histogram, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = _let(size, lambda n: F.zip_with(
        histogram, expected, lambda x, q: _let(x / n, lambda p: part(p, q) + part(q, p))))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.when((size > 0) & F.lit(whole > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judge(counted: DataFrame, refs: dict[str, tuple[list[int], list[int] | None]]) -> DataFrame:
    """Add ``char_distance``, ``word_distance`` and ``kept`` to the counts.

    A distance is null where there is nothing to compare, and a null one never rejects.
    """
    chars = distance(F.col("chars"), refs[ANY][0])
    words = F.lit(None).cast("double")
    for key, (by_class, by_word) in sorted(refs.items()):
        if key != ANY:
            chars = F.when(F.col("key") == key, distance(F.col("chars"), by_class)).otherwise(chars)
            if by_word:
                words = F.when(F.col("key") == key, distance(F.col("common"), by_word)).otherwise(words)
    judged = counted.withColumns({"char_distance": chars, "word_distance": words})
    length = F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(
        ((F.col("char_distance") > CHAR_DISTANCE) & (length >= LEAST_CHARS))
        | (F.coalesce("word_distance", F.lit(0.0)) > WORD_DISTANCE) & (F.col("n_words") >= LEAST_COMMON),
        F.lit(False)))


def assess(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
           keep: tuple[str, ...] = ("*",)) -> DataFrame:
    """``row`` with counts, distances and verdict for every row of ``df``."""
    counted = counts(df, text_col, lang_col, keep)
    return judge(counted, references(counted))


def oracle() -> str:
    """The same in SQL, text by text."""
    quote = "'"
    shape = [f"len(regexp_extract_all(t, '{c.replace(quote, 2 * quote)}'))" for c in CLASSES]
    listed = " ".join(f"WHEN '{k}' THEN {words}" for k, words in sorted(COMMON.items()))
    symbols = SYMBOLS

    def js(counts: str, totals: str) -> str:
        share = f"list_transform({totals}, lambda y: y / list_sum({totals}))"
        terms = " + ".join(
            f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / (z[1] + z[2])) ELSE 0 END" for a in ("z[1]", "z[2]"))
        return (f"CASE WHEN list_sum({counts}) > 0 AND list_sum({totals}) > 0 THEN sqrt(greatest(list_sum(list_transform("
                f"list_zip(list_transform({counts}, lambda x: x / list_sum({counts})), {share}), "
                f"lambda z: {terms})) / 2, 0)) END")

    def total(column: str, width: int) -> str:
        return "[" + ", ".join(f"sum({column}[{i + 1}])::DOUBLE" for i in range(width)) + "]"

    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    CASE WHEN lang IN ({", ".join(f"'{k}'" for k in sorted(COMMON))}) THEN lang ELSE '{ANY}' END AS key FROM documents),
s AS (SELECT *, list_filter(string_split_regex(t, '{BLANK}+'), lambda x: x <> '') AS w,
    list_filter(string_split_regex(lower(t), '[^\p{{L}}]+'), lambda x: x <> '') AS lw,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines,
    CASE key {listed} END AS listed FROM d),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM s)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1) GROUP BY doc_id),
c AS (SELECT s.doc_id, key, len(w)::BIGINT AS n_words, list_sum([0] || list_transform(w, lambda x: length(x)))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{symbols}'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(t) AS length, [{", ".join(shape)}] AS k,
    list_transform(listed, lambda x: len(list_filter(lw, lambda y: y = x)))
        || [len(lw) - len(list_filter(lw, lambda y: list_contains(listed, y)))] AS common
    FROM s LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
    [k[1], k[2] - k[1], k[3], k[4], n_symbols, length - word_chars,
     length - k[2] - k[3] - k[4] - n_symbols - (length - word_chars)]::DOUBLE[] AS chars FROM c),
r AS (SELECT key, {total("chars", len(CLASSES) + 3)} AS rc, {total("common", len(COMMON["en"]) + 1)} AS rw
    FROM b WHERE NOT base_failed GROUP BY key),
a AS (SELECT {total("chars", len(CLASSES) + 3)} AS rc FROM b WHERE NOT base_failed),
j AS (SELECT b.*, CASE WHEN key = '{ANY}' THEN a.rc ELSE coalesce(r.rc, a.rc) END AS rc,
    CASE WHEN key <> '{ANY}' THEN r.rw END AS rw FROM b LEFT JOIN r USING (key) CROSS JOIN a),
v AS (SELECT *, {js("chars", "rc")} AS char_distance, {js("common::DOUBLE[]", "rw")} AS word_distance FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(char_distance > {CHAR_DISTANCE} AND length >= {LEAST_CHARS}
        OR coalesce(word_distance, 0) > {WORD_DISTANCE} AND n_words >= {LEAST_COMMON}, false) AS kept,
    round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance FROM v"""
