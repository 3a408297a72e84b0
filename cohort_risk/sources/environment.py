"""Air-quality payloads to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk import schemas
from cohort_risk.functions import scalars as S
from cohort_risk.sources.population import canonical


def air_records(payloads: DataFrame, country: Column | None = None,
                ingested_at: Column | None = None) -> DataFrame:
    """Readings of ``results[]``. Two-letter country codes become three-letter ones,
    so that readings join with patients."""
    rows = payloads.select(*[c for c in payloads.columns if c != "results"], F.inline("results"))
    code = country if country is not None else S.null("string")
    return canonical(rows, schemas.ENVIRONMENT, {
        "source": F.lit("openaq"),
        "record_type": F.lit("environment"),
        "location_id": F.coalesce("locationId", F.lit("")),
        "city": F.col("location"),
        "country_iso3": F.coalesce(S.lookup(code, C.ISO2_TO_ISO3), code),
        "latitude": S.text_to_double("coordinates.latitude"),
        "longitude": S.text_to_double("coordinates.longitude"),
        "parameter": F.col("parameter"),
        "value": S.text_to_double("value"),
        "unit": F.col("unit"),
        "measured_at": S.utc_timestamp("date.utc"),
    }, ingested_at)
