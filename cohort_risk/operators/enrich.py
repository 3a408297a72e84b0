"""Enrichment of individuals with population and environment context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators.ranks import exact_quantiles, value_counts

TIER1_KEYS = ["country_iso3", "year", "sex", "age_group_bin"]


def _matching(columns: Sequence[str], prefixes: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c.startswith(prefixes)]


def _unique(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in features])


@dataclass(frozen=True)
class Tiers:
    """What of a population table decides about a match; found once, when a model is fitted."""

    lead: str | None
    overall: bool

    @classmethod
    def of(cls, pop_wide: DataFrame) -> Tiers:
        """The first feature that has data, and whether there are rows over all people."""
        features = population_features(pop_wide)
        row = pop_wide.agg(*[F.count(c).alias(c) for c in features],
                           F.count_if(_overall(pop_wide)).alias("__overall")).first()
        return cls(next((c for c in features if row[c]), None), row["__overall"] > 0)


def population_features(pop_wide: DataFrame) -> list[str]:
    return sorted(_matching(pop_wide.columns, C.POPULATION_PREFIXES))


def _overall(pop_wide: DataFrame) -> Column:
    cond = F.lit(True)
    if "sex" in pop_wide.columns:
        cond = cond & F.col("sex").isin(C.TIER2_SEXES)
    if "age_group_bin" in pop_wide.columns:
        cond = cond & F.col("age_group_bin").isin(C.TIER2_BANDS)
    return cond


def _resolve(strata: DataFrame, pop_wide: DataFrame, tiers: Tiers, tier: str | None) -> DataFrame:
    """Population features of each stratum by the closest match."""
    features = population_features(pop_wide)
    lookups = {}
    if set(TIER1_KEYS) <= set(pop_wide.columns):
        lookups["t1"] = (TIER1_KEYS, _unique(pop_wide, TIER1_KEYS, features))
    by_year = pop_wide.filter(_overall(pop_wide)) if tiers.overall else pop_wide
    if "year" in pop_wide.columns:
        by_year = _unique(by_year, ["country_iso3", "year"], features)
        lookups["t2"] = (["country_iso3", "year"], by_year)
        latest = by_year.groupBy("country_iso3").agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("year"))).alias(c)
              for c in features])
    else:
        latest = _unique(by_year, ["country_iso3"], features)
    lookups["t3"] = (["country_iso3"], latest)

    out = strata
    for name, (keys, table) in lookups.items():
        out = out.join(table.select(*keys, *[F.col(c).alias(f"__{name}_{c}") for c in features]),
                       keys, "left")
    names = list(lookups)
    lead = tiers.lead or features[0]

    def chosen(value):
        expr = None
        for name in names[:-1]:
            cond = F.col(f"__{name}_{lead}").isNotNull()
            expr = F.when(cond, value(name)) if expr is None else expr.when(cond, value(name))
        return value(names[-1]) if expr is None else expr.otherwise(value(names[-1]))

    columns = {c: chosen(lambda t, c=c: F.col(f"__{t}_{c}")) for c in features}
    if tier:
        number = {t: F.lit(int(t[1])) for t in names[:-1]}
        last = names[-1]
        number[last] = F.when(F.col(f"__{last}_{lead}").isNotNull(), int(last[1])).otherwise(0)
        columns[tier] = chosen(lambda t: number[t])
    return out.select(*strata.columns, *[e.alias(c) for c, e in columns.items()])


def join_context(ind: DataFrame, pop_wide: DataFrame | None, env_wide: DataFrame | None = None,
                 tiers: Tiers | None = None, tier: str | None = None) -> DataFrame:
    """Population and environment columns of every individual.

    Both depend on country, year, sex and age band alone. They are looked up once per
    distinct stratum, and the individuals are joined to that table once.
    """
    if pop_wide is not None and not population_features(pop_wide):
        pop_wide = None
    if pop_wide is None and env_wide is None:
        return ind
    keys = [c for c in TIER1_KEYS if c in ind.columns]
    if ind.isStreaming:  # a stream can't be made distinct before a join: look up every row
        out = ind if pop_wide is None else _resolve(
            ind.drop(*population_features(pop_wide)), pop_wide, tiers or Tiers.of(pop_wide), tier)
        return out if env_wide is None else out.join(env_wide, "country_iso3", "left")
    found = ind.select(*keys).distinct()
    if pop_wide is not None:
        found = _resolve(found, pop_wide, tiers or Tiers.of(pop_wide), tier)
    if env_wide is not None:
        found = found.join(env_wide, "country_iso3", "left")
    new = [c for c in found.columns if c not in keys]
    found = found.select(*[F.col(c).alias(f"__of_{c}") for c in keys], *new)
    same = reduce(lambda a, b: a & b, (ind[c].eqNullSafe(found[f"__of_{c}"]) for c in keys))
    return ind.drop(*new).join(found, same, "left").drop(*[f"__of_{c}" for c in keys])


def tiered_join(ind: DataFrame, pop_wide: DataFrame, tier: str | None = None,
                tiers: Tiers | None = None) -> DataFrame:
    """Population features by the closest match.

    1. country, year, sex and age band; 2. country and year over both sexes and all
    ages; 3. country, latest known value per feature. A tier counts as matched when
    it gives the alphabetically first feature that has data at all; a later tier then
    replaces all features. The number of rows stays.
    """
    return join_context(ind, pop_wide, None, tiers, tier)


def environment_wide(env: DataFrame,
                     parameters: Sequence[str] = tuple(C.ENVIRONMENT_PARAMETERS)) -> DataFrame:
    """Mean reading per country, one column per parameter."""
    return env.filter(F.col("country_iso3").isNotNull()).groupBy("country_iso3").agg(
        *[F.avg(F.when(F.col("parameter") == p, F.col("value")))
          .alias(C.ENVIRONMENT_RENAMES.get(p, f"env_{p}")) for p in parameters])


def join_environment(df: DataFrame, env: DataFrame, **kwargs) -> DataFrame:
    if "parameter" not in env.columns or "value" not in env.columns:
        return df
    return df.join(environment_wide(env, **kwargs), "country_iso3", "left")


def context_counts(df: DataFrame, prefixes: tuple[str, ...] = C.FILL_PREFIXES,
                   weight: str | None = None) -> DataFrame:
    """(feature, value, n) of the context columns."""
    columns = _matching(df.columns, prefixes)
    w = F.col(weight) if weight else F.lit(1)
    long = df.select(w.alias("__w"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ["__w"], columns, "feature", "value")
    return value_counts(long, ["feature"], weights={"n": F.col("__w")})


def fill_stats(counts: DataFrame) -> DataFrame:
    """Median, minimum and maximum per context feature, in long form."""
    extremes = counts.groupBy("feature").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    median = exact_quantiles(counts, ["feature"], {"value": 0.5})
    return (extremes.unpivot(["feature"], ["min", "max"], "stat", "value")
            .unionByName(median.select("feature", F.lit("median").alias("stat"), "value")))


def add_risk_multiplier(df: DataFrame) -> DataFrame:
    if "age_group_bin" not in df.columns:
        return df
    return df.withColumn("age_group_risk_multiplier",
                         S.lookup("age_group_bin", C.AGE_RISK_MULTIPLIER, 1.0))


def burden_columns(columns: Sequence[str], bounds: Mapping[str, tuple[float, float]]) -> list[str]:
    return [c for c in _matching(columns, C.BURDEN_PREFIXES) if c in bounds]


def add_burden_index(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Mean of the min-max scaled burden indicators, over those that are known."""
    columns = burden_columns(df.columns, bounds)
    if not columns:
        return df
    scaled = [(F.col(c) - bounds[c][0]) / (bounds[c][1] - bounds[c][0] + 1e-9) for c in columns]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in scaled[1:]), F.coalesce(scaled[0], F.lit(0.0)))
    known = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]),
                F.col(columns[0]).isNotNull().cast("int"))
    return df.withColumn("country_ncd_burden_index", F.try_divide(total, known))


def branch_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Ids, strata, target and the listed features, those present, in order."""
    wanted = [*C.ID_COLUMNS, "sex", "age_group_bin", C.TARGET, *features]
    return df.select(*[c for c in wanted if c in df.columns])
