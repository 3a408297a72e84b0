"""Column expressions: lenient casts, text normalisers, clinical scores.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_risk import config as C

_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


# --- casts ------------------------------------------------------------------------


def text_to_double(c: Column | str) -> Column:
    """Text to double; unparsable text and NaN become NULL."""
    c = _col(c)
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def text_to_int(c: Column | str) -> Column:
    """Text to int by way of double, truncating toward zero."""
    return text_to_double(c).try_cast("int")


def scrub_nan(c: Column | str) -> Column:
    return F.nanvl(_col(c), null("double"))


def lenient_double(df: DataFrame, name: str) -> Column:
    """``name`` of ``df`` as double, by its type: text is parsed, NaN scrubbed."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return text_to_double(F.col(name))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return scrub_nan(F.col(name).cast("double"))
    return F.col(name).cast("double")


def lenient_int(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.IntegerType):
        return F.col(name)
    return lenient_double(df, name).try_cast("int")


def utc_timestamp(c: Column | str) -> Column:
    """``2024-05-01T10:00:00Z``, the same with ``+00:00``, or a bare date; else NULL."""
    c = _col(c)
    text = (F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.concat(c, F.lit("T0:0:0Z")))
            .when(c.rlike(r"(Z|\+00:00)$"), c))
    return F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:sXXX"))


# --- text -------------------------------------------------------------------------


def strip(c: Column | str) -> Column:
    """Remove all white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def folded(c: Column | str) -> Column:
    return F.lower(strip(c))


def lookup(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Value of a literal map, or ``default`` for unknown and NULL keys."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    value = F.create_map(*pairs)[_col(c)]
    return value if default is None else F.coalesce(value, F.lit(default))


def first_present(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-null of the listed columns that exist in ``df``, as text."""
    present = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*present) if present else null("string")


def normal_sex(c: Column | str, extra_male: Sequence[str] = (),
               extra_female: Sequence[str] = ()) -> Column:
    word = folded(c)
    return (F.when(word.isin(*C.FEMALE_WORDS, *extra_female), "Female")
            .when(word.isin(*C.MALE_WORDS, *extra_male), "Male")
            .otherwise("Both"))


def population_sex(c: Column | str) -> Column:
    return normal_sex(c, extra_male=["mle"], extra_female=["fmle"])


def yes_no(c: Column | str) -> Column:
    word = folded(_col(c).cast("string"))
    return F.when(word.isin(C.YES_WORDS), "yes").when(word.isin(C.NO_WORDS), "no")


def yes_no_flag(c: Column | str) -> Column:
    return yes_no(c) == "yes"


def synonym(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Mapped word, or the folded input when there is no mapping for it."""
    word = folded(c)
    return F.coalesce(lookup(word, mapping), word)


# --- bands ------------------------------------------------------------------------


def banded(c: Column | str, edges: Sequence[float], labels: Sequence[str],
           other: str = "nan") -> Column:
    """Label of the half-open interval ``[edge, next edge)`` that holds ``c``."""
    c = _col(c)
    out = F.when(c < edges[0], other)
    for high, label in zip(edges[1:], labels):
        out = out.when(c < high, label)
    return out.otherwise(other)


def age_band(c: Column | str) -> Column:
    return banded(c, C.AGE_EDGES, C.AGE_LABELS)


def age_text_band(c: Column | str) -> Column:
    """Age band of free text such as ``30-34 years`` by its first number."""
    c = _col(c)
    digits = F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit(""))
    years = digits.try_cast("bigint")
    band = F.when(years < C.AGE_EDGES[1], C.AGE_LABELS[0])
    for high, label in zip(C.AGE_EDGES[2:-1], C.AGE_LABELS[1:-1]):
        band = band.when(years < high, label)
    return (F.when(c.isNull() | folded(c).isin("all ages", "all", "total", "")
                   | digits.isNull(), "All ages")
            .otherwise(band.otherwise(C.AGE_LABELS[-1])))


def risk_tier(c: Column | str) -> Column:
    edges = [gate[0] for gate in C.WARNING_GATES] + [C.WARNING_GATES[-1][1]]
    return banded(c, edges, [gate[3] for gate in C.WARNING_GATES])


# --- clinical measures ------------------------------------------------------------


def truth(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def bp_stage(systolic: Column | str, diastolic: Column | str) -> Column:
    s, d = _col(systolic), _col(diastolic)
    return (F.when(s.isNull() | d.isNull(), null("int"))
            .when((s >= 140) | (d >= 90), 3)
            .when((s >= 130) | (d >= 80), 2)
            .when(s >= 120, 1)
            .otherwise(0))


def bmi_category(c: Column | str) -> Column:
    c = _col(c)
    return (F.when(c.isNull(), null("int")).when(c < 18.5, 0).when(c < 25, 1)
            .when(c < 30, 2).when(c < 35, 3).otherwise(4))


def glucose_category(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isNull(), null("int")).when(c < 5.6, 0).when(c < 7.0, 1).otherwise(2)


def feature_of_indicator(feature: Column, code: Column, name: Column) -> Column:
    """Feature an indicator feeds: given, by code, or by a code inside the name."""
    lowered = F.lower(F.coalesce(name, F.lit("")))
    by_name = F.when(F.lit(False), null("string"))
    for key, value in C.INDICATOR_FEATURES.items():
        by_name = by_name.when(lowered.contains(key.lower()), value)
    return F.coalesce(F.nullif(feature, F.lit("")),
                      lookup(code, C.INDICATOR_FEATURES), by_name)


def clinical_group(c: Column | str) -> Column:
    groups = {f: g for g, members in C.CLINICAL_GROUPS.items() for f in members}
    return lookup(c, groups, "other")
