"""Feature tables: fit on training data, transform any data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_risk import config as C
from cohort_risk.operators import enrich, individual
from cohort_risk.session import stored

_STATS = T.StructType().add("kind", "string").add("feature", "string").add("value", "double")


@dataclass
class FeatureModel:
    """Fitted fill values and bounds plus the lookup tables they were fitted with."""

    as_of_year: int
    imputer: dict[str, float]
    fills: dict[str, float]
    bounds: dict[str, tuple[float, float]]
    pop_wide: DataFrame | None = None
    env_wide: DataFrame | None = None
    clamp_target: bool = field(default=True)
    tiers: enrich.Tiers | None = None

    def base(self, ind: DataFrame) -> DataFrame:
        """Encoded, derived, imputed and banded individuals."""
        out = individual.impute(individual.prepare(ind, self.as_of_year), self.imputer)
        out = individual.add_age_band(out)
        return out if "sex" in out.columns else out.withColumn("sex", F.lit("Both"))

    def context(self, df: DataFrame) -> DataFrame:
        """Population and environment columns by country, year, sex and age band."""
        return enrich.join_context(df, self.pop_wide, self.env_wide, self.tiers)

    def transform(self, ind: DataFrame, with_target: bool = False) -> DataFrame:
        """Enriched individuals. Scoring leaves the target out and reuses all statistics."""
        out = self.base(ind)
        if with_target:
            out = individual.encode_target(out, self.clamp_target)
        out = individual.impute(self.context(out), self.fills)
        return enrich.add_burden_index(enrich.add_risk_multiplier(out), self.bounds)

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [("year", "as_of_year", float(self.as_of_year)),
                ("clamp", "clamp_target", float(self.clamp_target))]
        rows += [("imputer", k, v) for k, v in self.imputer.items()]
        rows += [("fill", k, v) for k, v in self.fills.items()]
        if self.tiers:
            rows += [("overall", self.tiers.lead or "", float(self.tiers.overall))]
        for k, (low, high) in self.bounds.items():
            rows += [("min", k, low), ("max", k, high)]
        spark.createDataFrame(rows, _STATS).coalesce(1).write.parquet(f"{path}/stats")
        for name, table in [("pop_wide", self.pop_wide), ("env_wide", self.env_wide)]:
            if table is not None:
                table.write.parquet(f"{path}/{name}")

    @classmethod
    def load(cls, path: str, spark: SparkSession, with_population: bool = True,
             with_environment: bool = True) -> FeatureModel:
        stats: dict[str, dict[str, float]] = {}
        for row in spark.read.schema(_STATS).parquet(f"{path}/stats").collect():
            stats.setdefault(row["kind"], {})[row["feature"]] = row["value"]
        high = stats.get("max", {})
        tiers = [enrich.Tiers(k or None, bool(v)) for k, v in stats.get("overall", {}).items()]
        return cls(
            as_of_year=int(stats["year"]["as_of_year"]),
            imputer=stats.get("imputer", {}), fills=stats.get("fill", {}),
            bounds={k: (low, high[k]) for k, low in stats.get("min", {}).items()},
            pop_wide=spark.read.parquet(f"{path}/pop_wide") if with_population else None,
            env_wide=spark.read.parquet(f"{path}/env_wide") if with_environment else None,
            clamp_target=bool(stats["clamp"]["clamp_target"]),
            tiers=tiers[0] if tiers and with_population else None)


def fit(ind: DataFrame, pop_wide: DataFrame | None, env: DataFrame | None,
        as_of_year: int) -> FeatureModel:
    """Fit all statistics on validated individuals.

    Context columns depend on country, year, sex and age band only, so their
    statistics come from the counts of these strata, not from the joined rows.
    """
    model = FeatureModel(as_of_year, {}, {}, {})
    prepared = individual.prepare(ind, as_of_year)
    model.imputer = individual.stats_dict(individual.imputer_stats(prepared))
    # each lookup serves several joins here and in every later transform
    if pop_wide is not None:
        model.pop_wide = stored(pop_wide, "pop_wide")
        model.tiers = enrich.Tiers.of(model.pop_wide)
    if env is not None:
        model.env_wide = stored(enrich.environment_wide(env), "env_wide")
    strata = (model.base(ind).groupBy("country_iso3", "year", "sex", "age_group_bin")
              .agg(F.count("*").alias("__weight")))
    joined = model.context(strata)
    if any(c.startswith(C.FILL_PREFIXES) for c in joined.columns):
        stats: dict[str, dict[str, float]] = {}
        # bounded by the strata, and read by several statistics
        counts = stored(enrich.context_counts(joined, weight="__weight"), "context_counts")
        for row in enrich.fill_stats(counts).collect():  # three rows per context column
            stats.setdefault(row["stat"], {})[row["feature"]] = row["value"]
        model.fills = stats.get("median", {})
        model.bounds = {k: (v, stats["max"][k]) for k, v in stats.get("min", {}).items()}
    return model


def branch_tables(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (enrich.branch_table(enriched, C.BRANCH_A_FEATURES),
            enrich.branch_table(enriched, C.BRANCH_B_FEATURES))
