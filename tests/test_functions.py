import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.functions import stats


def column(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r["y"] for r in df.orderBy("i").select(expr.alias("y")).collect()]


def test_text_to_double(spark):
    given = ["1", " 2.5 ", "-.5", "1e3", "12d", "abc", "", None, "nan", "0x10", "5."]
    want = [1.0, 2.5, -0.5, 1000.0, None, None, None, None, None, None, 5.0]
    assert column(spark, given, S.text_to_double("x")) == want


def test_text_to_int_truncates(spark):
    assert column(spark, ["2019.0", "-3.9", "3.9", "x", ""], S.text_to_int("x")) == [
        2019, -3, 3, None, None]


def test_nan_is_missing(spark):
    assert column(spark, [1.0, float("nan"), None], S.scrub_nan("x"), "double") == [1.0, None, None]


def test_strip_removes_all_white_space(spark):
    assert column(spark, ["\t a b \n", " x ", None], S.strip("x")) == ["a b", "x", None]


def test_timestamps_do_not_depend_on_session_zone(spark):
    given = ["2024-05-01T10:00:00Z", "2024-05-01T10:00:00+00:00", "2024-05-01",
             "2024-05-01T10:00:00+02:00", "soon", None]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Dhaka"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = column(spark, given, F.unix_timestamp(S.utc_timestamp("x")))
            ten = int(dt.datetime(2024, 5, 1, 10, tzinfo=dt.timezone.utc).timestamp())
            assert got == [ten, ten, ten - 36000, None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sex_and_answers(spark):
    given = [" F ", "women", "Man", "mle", "FMLE", None, ""]
    assert column(spark, given, S.normal_sex("x")) == [
        "Female", "Female", "Male", "Both", "Both", "Both", "Both"]
    assert column(spark, given, S.population_sex("x")) == [
        "Female", "Female", "Male", "Male", "Female", "Both", "Both"]
    assert column(spark, ["YES", "0", "true ", "maybe", None], S.yes_no("x")) == [
        "yes", "no", "yes", None, None]
    assert column(spark, ["yes", "no", "?"], S.yes_no_flag("x")) == [True, False, None]


def test_synonyms_pass_unknown_words_through(spark):
    assert column(spark, ["Current", " Pipe ", None], S.synonym("x", C.SMOKING_SYNONYMS)) == [
        "smoker", "pipe", None]


def test_age_bands_at_the_edges(spark):
    ages = [0.0, 14.9, 15.0, 59.99, 60.0, 75.0, 119.9, 120.0, -1.0, None]
    want = ["0-14", "0-14", "15-29", "45-59", "60-74", "75+", "75+", "nan", "nan", "nan"]
    assert column(spark, ages, S.age_band("x"), "double") == want


def test_age_text(spark):
    given = ["30-34 years", "All Ages", "", None, "adults", "85+", "120", "under 5",
             "99999999999999999999"]
    want = ["30-44", "All ages", "All ages", "All ages", "All ages", "75+", "75+", "0-14", "75+"]
    assert column(spark, given, S.age_text_band("x")) == want


@pytest.mark.parametrize("s,d,want", [
    (140, 60, 3), (100, 90, 3), (130, 60, 2), (100, 80, 2), (120, 60, 1), (119, 79, 0),
    (None, 90, None), (150, None, None)])
def test_bp_stage(spark, s, d, want):
    df = spark.createDataFrame([(s, d)], "s double, d double".replace("double", "int"))
    assert df.select(S.bp_stage("s", "d")).first()[0] == want


def test_indicator_by_name_follows_map_order(spark):
    df = spark.createDataFrame(
        [("x", None, None), ("", "NCD_GLUC_04", "wb_urban_pct"),
         (None, "zz", "SH.STA.OWAD.ZS and NCD_BMI_30C"), (None, None, None)],
        "f string, c string, n string")
    got = [r[0] for r in df.select(
        S.feature_of_indicator(F.col("f"), F.col("c"), F.col("n"))).collect()]
    assert got == ["x", "pop_diabetes_prevalence", "pop_obesity_prevalence", None]


def test_normal_cdf(spark):
    zs = [-40.0, -8.0, -3.2, -1.0, 0.0, 0.5, 2.0, 7.5, 40.0]
    got = column(spark, zs, stats.normal_cdf(F.col("x")), "double")
    for z, p in zip(zs, got):
        assert p == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-7, abs=1e-15)


def test_kolmogorov_pvalue(spark):
    # tabulated: 1.3581 is the 5 % point, 1.6276 the 1 % point
    df = spark.createDataFrame([(1.3581,), (1.6276,), (0.1,), (5.0,)], "l double")
    got = [r[0] for r in df.select(stats.kolmogorov_pvalue(F.col("l"), F.lit(1.0))).collect()]
    assert got == [pytest.approx(0.05, abs=1e-4), pytest.approx(0.01, abs=1e-4), 1.0,
                   pytest.approx(0.0, abs=1e-9)]
