import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.operators import (
    dedup,
    drift,
    enrich,
    environment,
    folds,
    individual,
    metrics,
    monitor,
    population,
    ranks,
    scoring,
    validate,
    views,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- dedup and validation ------------------------------------------------------------


def test_keep_first_takes_nulls_as_equal_and_survives_a_hot_key(spark):
    data = [(None, i) for i in range(3000)] + [(f"k{i % 700}", i) for i in range(3000)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, o int").repartition(7)
    got = {r["k"]: r["o"] for r in dedup.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {None: 0, **{f"k{i}": i for i in range(700)}}


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, o int")
    plan = dedup.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.rindex("WindowGroupLimit")
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < partial


def test_validation_reasons_and_invariants(spark):
    data = [("a", 120.0, 80.0, 25.0, "40"), ("a", 120.0, 80.0, 25.0, "41"),
            ("b", None, 80.0, 5.0, "150"), ("c", 60.0, 200.0, 80.0, "x"),
            ("d", 59.9, 80.0, 25.0, None)]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(data)],
        "seq int, patient_id string, systolic_bp double, diastolic_bp double, bmi double, age string")
    clean, bad = validate.validate_individual(df, ["seq"])
    assert rows(clean.select("patient_id", "age")) == [("a", "40"), ("c", "x")]
    assert rows(bad.select("patient_id", "_reject", "_source")) == [
        ("b", "null_systolic_bp; range_bmi; range_age", "individual"),
        ("d", "range_systolic_bp", "individual")]
    report = {(r["metric"], r["column"]): r["value"]
              for r in validate.individual_report(df, ["seq"]).collect()}
    assert report[("total_rows", None)] == 5
    assert (report[("valid_rows", None)] + report[("quarantined_rows", None)]
            + report[("duplicate_rows", None)]) == 5
    assert report[("missing_required", None)] == 1
    assert report[("range_violation", "bmi")] == 1
    assert ("range_violation", "systolic_bp") in report
    assert ("range_violation", "diastolic_bp") not in report


def test_empty_input_gives_an_empty_report(spark):
    df = spark.createDataFrame([], "seq int, patient_id string, systolic_bp double, "
                                   "diastolic_bp double, bmi double")
    report = {r["metric"]: r["value"] for r in validate.individual_report(df, ["seq"]).collect()
              if r["column"] is None}
    assert report["total_rows"] == 0 and report["pass_rate"] == 0


def test_rejected_twin_does_not_shadow_a_valid_row(spark):
    df = spark.createDataFrame(
        [(0, "s", "A", 2000, "i", "Both", "x", None), (1, "s", "A", 2000, "i", "Both", "x", 5.0),
         (2, "s", "A", 1989, "i", "Both", "x", 5.0), (3, "s", "A", None, "i", "Both", "x", 6.0)],
        "o int, source string, country_iso3 string, year int, indicator_code string, sex string, "
        "age_group string, value double")
    fixed = validate.validate_population(df, ["o"])
    assert rows(fixed.select("o")) == [(1,), (3,)]
    literal = validate.validate_population(df, ["o"], reject_before_dedup=False)
    assert rows(literal.select("o")) == [(3,)]


# --- individuals ---------------------------------------------------------------------


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("a", 30.0)], "patient_id string, bmi double")
    out = individual.prepare(df, 2024)
    assert {"bmi_category_enc", "metabolic_syndrome_score", "year"} <= set(out.columns)
    assert not {"bp_stage", "chol_hdl_ratio", "sex_enc"} & set(out.columns)
    first = out.first()
    assert (first["year"], first["bmi_category_enc"], first["metabolic_syndrome_score"]) == (2024, 3, 1)


def test_zero_hdl_has_no_ratio(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0)], "total_cholesterol double, hdl double")
    assert rows(individual.derive(df).select("chol_hdl_ratio")) == [(2.5,), (None,)]


def test_imputer_is_exact_and_leaves_out_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 1), (2.0, None, 2), (4.0, None, 2), (None, None, 1)],
        "age double, hdl double, sex_enc int")
    stats = individual.stats_dict(individual.imputer_stats(df))
    assert stats == {"age": 2.0, "sex_enc": 1.0}
    assert rows(individual.impute(df, stats).select("age", "hdl")) == [
        (1.0, None), (2.0, None), (2.0, None), (4.0, None)]


# --- order statistics ----------------------------------------------------------------


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.sampled_from([0.0, -0.0, 1.0, 1e300, -1e-300, 5e-324]),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value double").withColumn(
        "g", F.lit("x"))
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "q10": 1.0}
    got = ranks.exact_quantiles(ranks.value_counts(df, ["g"]), ["g"], probs).first()
    for name, p in probs.items():
        want = float(np.quantile(values, p))
        assert got[name] == pytest.approx(want, rel=1e-9, abs=1e-300)


def test_narrow_values_spread_over_many_buckets(spark):
    narrow = spark.range(200_000).select(F.lit("x").alias("g"), (1.7e9 + F.col("id") * 5).alias("value"), F.lit(1).alias("n"))
    cut = ranks._cut(narrow, ["g"], "value", bucket_values=2_000)
    sizes = [r["count"] for r in cut.groupBy("g", "__bucket", "__part").count().collect()]
    assert len(sizes) >= 100 and max(sizes) <= 2_100
    got = ranks.exact_quantiles(narrow, ["g"], {"q": 0.25}).first()["q"]
    assert got == 1.7e9 + 5 * 0.25 * 199_999


def test_crowded_values_beside_far_ones_spread_evenly(spark):
    # one magnitude bucket: 100,000 values within 1e-7 of 1.0, and two near its far end
    crowded = spark.range(100_000).select(F.lit("x").alias("g"), (1.0 + F.col("id") * 1e-12).alias("value"),
                                          F.lit(1).alias("n"))
    far = spark.createDataFrame([("x", 1.0006, 1), ("x", 1.00061, 1)], "g string, value double, n int")
    both = crowded.unionByName(far)
    cut = ranks._cut(both, ["g"], "value", bucket_values=2_000)
    assert cut.select("__bucket").distinct().count() == 1
    sizes = [r["count"] for r in cut.groupBy("g", "__bucket", "__part").count().collect()]
    assert len(sizes) >= 45 and max(sizes) <= 2_500
    got = ranks.running_totals(both, ["g"], "value", ["n"]).filter("value = 1.0006").first()["cum_n"]
    assert got == 100_001


def test_lead_feature_is_the_first_with_data(spark):
    wide = spark.createDataFrame(
        [("BGD", 2010, "Male", "30-44", None, 10.0), ("BGD", 2020, "Both", "All ages", None, 50.0)],
        "country_iso3 string, year int, sex string, age_group_bin string, pop_bp_prevalence double, wb_urban_pct double")
    ind = spark.createDataFrame([("BGD", 2010, "Male", "30-44"), (None, None, None, None)],
                                "country_iso3 string, year int, sex string, age_group_bin string")
    got = rows(enrich.tiered_join(ind, wide, tier="tier").select("country_iso3", "wb_urban_pct", "tier"))
    assert got == [("BGD", 10.0, 1), (None, None, 0)]


def test_bucket_is_monotone(spark):
    values = sorted([0.0, -1e308, 1e308, -5e-324, 5e-324, 1.0, -1.0, 1.0000001, 1023.99, 1024.0,
                     float("inf"), float("-inf")])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.orderBy("v").select(ranks.order_bucket(F.col("v"))).collect()]
    assert got == sorted(got) and None not in got


def test_running_totals(spark):
    counts = spark.createDataFrame([("a", float(v), 2) for v in range(-500, 500)],
                                   "g string, value double, n long")
    got = ranks.running_totals(counts, ["g"], "value", ["n"]).collect()
    assert all(r["cum_n"] == 2 * (r["value"] + 501) for r in got) and len(got) == 1000


# --- population ----------------------------------------------------------------------


def test_units_need_more_than_five_values(spark):
    data = [("f", 0.2)] * 6 + [("g", 0.2)] * 5 + [("h", 0.2)] * 19 + [("h", 3.0)] + [(None, 0.1)]
    df = spark.createDataFrame(data, "indicator_name string, value double")
    got = population.normalise_units(df).groupBy("indicator_name").agg(F.max("value"))
    # 19 of 20 is not more than 95 %
    assert rows(got) == [("f", 20.0), ("g", 0.2), ("h", 3.0), (None, 0.1)]


def test_forward_fill_stops_after_the_limit(spark):
    data = [("A", y, 1.0 if y == 2000 else None) for y in range(1999, 2008)] + [(None, 2000, 2.0)]
    df = spark.createDataFrame(data, "country_iso3 string, year int, value double").withColumns(
        {"sex": F.lit("Both"), "age_group_bin": F.lit("All ages"), "feature_name": F.lit("f")})
    got = {(r["country_iso3"], r["year"]): r["value"] for r in population.forward_fill(df).collect()}
    assert [got[("A", y)] for y in range(1999, 2008)] == [None] + [1.0] * 6 + [None] * 2
    assert got[(None, 2000)] is None


def _wide(spark, data):
    return spark.createDataFrame(
        data, "country_iso3 string, year int, sex string, age_group_bin string, "
              "pop_bp_prevalence double, wb_urban_pct double")


def test_tiers(spark):
    wide = _wide(spark, [
        ("A", 2000, "Male", "30-44", 1.0, None), ("A", 2000, "Both", "All ages", 2.0, 50.0),
        ("A", 2001, "Both", "All ages", None, 60.0), ("B", 1999, "Both", "All ages", 7.0, 70.0),
        ("B", 2005, "Both", "All ages", None, 80.0)])
    ind = spark.createDataFrame(
        [("t1", "A", 2000, "Male", "30-44"), ("t2", "A", 2000, " male", "30-44"),
         ("t3", "A", 2001, "Male", "30-44"), ("t3b", "B", 1990, "Male", "30-44"),
         ("none", "C", 2000, "Male", "30-44")],
        "patient_id string, country_iso3 string, year int, sex string, age_group_bin string")
    got = {r[0]: tuple(r)[1:] for r in enrich.tiered_join(ind, wide, tier="tier").select(
        "patient_id", "pop_bp_prevalence", "wb_urban_pct", "tier").collect()}
    # tier 1 keeps its NULL; tier 3 takes the latest known value of each feature
    assert got == {"t1": (1.0, None, 1), "t2": (2.0, 50.0, 2), "t3": (2.0, 60.0, 3),
                   "t3b": (7.0, 80.0, 3), "none": (None, None, 0)}


def test_tier_two_uses_everything_when_no_overall_rows_exist(spark):
    wide = _wide(spark, [("A", 2000, "Male", "30-44", 1.0, 10.0), ("A", 2000, "Female", "30-44", 3.0, 20.0)])
    ind = spark.createDataFrame([("A", 2000, "x", "75+")],
                                "country_iso3 string, year int, sex string, age_group_bin string")
    got = enrich.tiered_join(ind, wide).first()
    assert (got["pop_bp_prevalence"], got["wb_urban_pct"]) == (2.0, 15.0)


def test_repeated_lookup_keys_do_not_multiply_rows(spark):
    wide = _wide(spark, [("A", 2000, "Male", "30-44", 1.0, 10.0)] * 3)
    ind = spark.createDataFrame([("A", 2000, "Male", "30-44")] * 4,
                                "country_iso3 string, year int, sex string, age_group_bin string")
    assert enrich.tiered_join(ind, wide).count() == 4


def test_large_lookups_take_the_stored_path_with_the_same_result(spark):
    wide = _wide(spark, [("A", 2000, "Both", "All ages", 1.0, 10.0)])
    ind = spark.createDataFrame([("A", 2000, "Male", "30-44"), ("B", 2000, "Male", "30-44")],
                                "country_iso3 string, year int, sex string, age_group_bin string")
    want = rows(enrich.tiered_join(ind, wide))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(enrich.tiered_join(ind, wide)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --- environment ---------------------------------------------------------------------


def _haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2)
    return 2 * 6371000.0 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [500.0, 10_000.0, 800_000.0])
def test_radius_join_equals_brute_force(spark, radius):
    rng = random.Random(3)
    step = radius / 111_000
    anchors = [(0.0, 0.0), (59.9, 10.0), (0.0, 180.0), (0.0, -180.0), (89.99, 0.0), (89.99, 179.0),
               (-90.0, 0.0), (90.0, 45.0), (-45.0, -179.99)]

    def near():
        lat, lon = rng.choice(anchors)
        lat = max(-90.0, min(90.0, lat + rng.uniform(-2, 2) * step))
        lon = lon + rng.uniform(-2, 2) * step / max(0.01, math.cos(math.radians(lat)))
        return lat, (lon + 180) % 360 - 180

    points = [(i, *near()) for i in range(60)]
    points += [(100 + i, *points[0][1:]) for i in range(5)]
    readings = [(i, *near(), rng.randrange(50)) for i in range(300)]
    readings += [(1000 + i, *points[0][1:], 60 + i % 3) for i in range(40)]
    p = spark.createDataFrame(points, "point_id int, latitude double, longitude double")
    r = spark.createDataFrame(readings, "rid int, latitude double, longitude double, t int").select(
        "rid", "latitude", "longitude", F.timestamp_seconds("t").alias("measured_at"))
    got = {}
    for row in environment.within_radius(p, r, "rid", 7, radius).collect():
        got.setdefault(row["point_id"], []).append((row["recency"], row["rid"]))
    want = {}
    for pid, lat, lon in points:
        hits = sorted((-t, rid) for rid, a, b, t in readings
                      if _haversine(lat, lon, a, b) <= radius)[:7]
        if hits:
            want[pid] = [(i + 1, rid) for i, (_, rid) in enumerate(hits)]
    assert {k: sorted(v) for k, v in got.items()} == want


# --- scoring -------------------------------------------------------------------------


def test_gates_cover_all_scores(spark):
    values = [0.0, 0.2499999, 0.25, 0.45, 0.65, 1.0, 1.2]
    df = spark.createDataFrame([(v, 1 - v, 0.0) for v in values], "a_high double, a_low double, a_mod double")
    df = df.withColumns({f"b_{c}": F.col(f"a_{c}") for c in scoring.CLASSES})
    out = scoring.scored_records(df, F.lit(None).cast("timestamp"))
    assert [r["warning_level"] for r in out.collect()] == [1, 1, 2, 3, 4, 4, 4]
    assert out.columns == C.RESULT_COLUMNS


def test_first_class_wins_ties(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.1, 0.2, 0.7)], "a double, b double, c double")
    assert [r[0] for r in df.select(scoring.first_argmax(["a", "b", "c"])).collect()] == [0, 1, 2]


def test_align_ignores_null_and_repeated_keys(spark):
    a = spark.createDataFrame([("x", 1, 0.1), ("x", 2, 0.2), (None, 3, 0.3), ("y", 4, 0.4)], "id string, o int, a double")
    b = spark.createDataFrame([("x", 1, 0.5), ("x", 0, 0.6), (None, 1, 0.7)], "id string, o int, b double")
    assert rows(scoring.align_branches(a, b, ["id"], ["o"]).select("id", "a", "b")) == [("x", 0.1, 0.6)]


# --- metrics and folds ---------------------------------------------------------------


def test_auc_counts_ties_half_and_reports_missing_classes(spark):
    df = spark.createDataFrame([(0, 0.9, 0.1), (0, 0.5, 0.5), (1, 0.5, 0.5), (1, 0.2, 0.8)], "y int, p0 double, p1 double")
    auc = {r["label"]: r["auc"] for r in metrics.roc_auc_by_class(df, "y", ["p0", "p1"]).collect()}
    assert auc == {0: 0.875, 1: 0.875}
    assert metrics.roc_auc_macro(df, "y", ["p0", "p1"]).first()[0] == 0.875
    assert metrics.roc_auc_macro(df.withColumn("p2", F.lit(0.0)), "y", ["p0", "p1", "p2"]).first()[0] == 0.0


def test_macro_f1_covers_classes_of_truth_and_prediction(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (None, 1)], "y int, p int")
    got = metrics.macro_f1(df, "y", "p").first()
    assert got["f1_macro"] == pytest.approx((2 / 3 + 1 + 0) / 3)
    assert got["accuracy"] == pytest.approx(2 / 3) and got["n_rows"] == 3


def test_forest_is_primary_on_ties(spark):
    df = spark.createDataFrame([("A", "kernel", 0.5), ("A", "forest", 0.5), ("B", "kernel", 0.6), ("B", "forest", 0.5)],
                               "branch string, model string, f1_macro double")
    assert rows(metrics.primary_model(df)) == [("A", "forest"), ("B", "kernel")]


def test_folds_are_even_in_a_hot_class_and_stable(spark):
    df = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 4 < 3, 0).otherwise(1).alias("y"))
    out = folds.stratified_folds(df, "y", ["id"])
    sizes = out.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    again = folds.stratified_folds(df.repartition(13, "y"), "y", ["id"], prefix=2)
    assert rows(out) == rows(again.select(*out.columns))
    test = folds.stratified_holdout(df, "y", ["id"]).filter("is_test").groupBy("y").count()
    assert rows(test) == [(0, 600), (1, 200)]


# --- drift and monitoring ------------------------------------------------------------


def _long(spark, values, feature="bmi"):
    return spark.createDataFrame([(feature, float(v)) for v in values], "feature string, value double")


def test_identical_data_has_no_drift(spark):
    rng = np.random.default_rng(0)
    values = rng.normal(50, 10, 3000).round(3)
    base = drift.compute_baseline(_long(spark, values))
    row = drift.detect_drift(_long(spark, values), base).first()
    assert row["psi"] == pytest.approx(0, abs=1e-12) and row["status"] == "ok"
    assert row["mean_shift_pct"] == pytest.approx(0, abs=1e-9)
    assert 0 <= row["ks_stat"] <= 1 and row["ks_pval"] > 0.05
    stored = base.first()
    assert sum(stored["bin_counts"]) == 3000
    assert stored["bin_counts"] == np.histogram(values, bins=stored["bin_edges"])[0].tolist()
    assert stored["std"] == pytest.approx(values.std(ddof=1))
    shifted = drift.detect_drift(_long(spark, values + 20), base).first()
    assert shifted["status"] == "alert" and shifted["psi"] > 0.25


def test_small_and_constant_features_are_left_out(spark):
    assert drift.compute_baseline(_long(spark, range(9))).count() == 0
    assert drift.compute_baseline(_long(spark, [1] * 60 + [2] * 39)).count() == 0
    base = drift.compute_baseline(_long(spark, range(100)))
    assert drift.detect_drift(_long(spark, range(19)), base).count() == 0
    assert drift.detect_drift(_long(spark, range(20)), base).count() == 1


def test_two_sample_statistic(spark):
    data = [("f", float(v), True) for v in [1, 2, 3, 4]] + [("f", float(v), False) for v in [3, 4, 5, 6]]
    df = spark.createDataFrame(data, "feature string, value double, b boolean")
    assert drift.ks_two_sample(df, F.col("b")).first()["ks_stat"] == 0.5


def test_retrain_reasons(spark):
    report = spark.createDataFrame(
        [("hdl", "alert"), ("bmi", "alert"), ("age", "warn"), ("x", "warn"), ("systolic_bp", "warn")],
        "feature string, status string")
    f1 = spark.createDataFrame([(0.5,)], "f1_macro double")
    row = monitor.retrain_decision(report, f1, 0.75).first()
    assert row["retrain_triggered"] and row["n_alert"] == 2 and row["n_warn"] == 3
    assert row["reasons"] == (
        "PSI/KS alert on features: ['bmi', 'hdl']; "
        "3+ features in warn state: ['systolic_bp', 'age', 'x']; "
        "F1 degraded by 0.250 (ref=0.750 -> current=0.500)")
    calm = report.filter("status = 'warn'").limit(2)
    assert not monitor.retrain_decision(calm, f1, 0.6).first()["retrain_triggered"]
    assert monitor.retrain_decision(calm, force=True).first()["reasons"] == "manual force_retrain flag"
    assert not monitor.retrain_decision(report.limit(0)).first()["retrain_triggered"]


# --- views ---------------------------------------------------------------------------


def test_heatmap_keeps_null_strata(spark):
    df = spark.createDataFrame(
        [("p", None, None, "Male", 0.2, 1, 0.1, 0.2, "both"), (None, None, None, "Male", 0.4, 3, 0.3, 0.2, "a")],
        "patient_id string, country_iso3 string, age_group_bin string, sex string, ensemble_risk_score double, "
        "warning_level int, branch_a_score double, branch_b_score double, signal_type string")
    row = views.population_heatmap(df).first()
    assert (row["n_patients"], row["mean_risk_score"], row["pct_high_risk"], row["dominant_signal"]) == (1, 0.3, 0.5, "a")


def test_importance_ties_share_the_rank(spark):
    df = spark.createDataFrame([("A", "age", 0.5), ("A", "bmi", 0.25), ("A", "zz", 0.25)],
                               "branch string, feature string, importance double")
    assert rows(views.feature_importance(df).select("feature", "rank", "pct_of_total", "clinical_group")) == [
        ("age", 1, 50.0, "demographics"), ("bmi", 2, 25.0, "metabolic"), ("zz", 2, 25.0, "other")]


def test_results_do_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.4 else f"p{rng.randrange(50)}", i, float(rng.randrange(60, 200)),
             float(rng.randrange(40, 120)), float(rng.randrange(12, 60))) for i in range(600)]
    df = spark.createDataFrame(data, "patient_id string, seq int, systolic_bp double, diastolic_bp double, bmi double")
    first = rows(validate.tag_individual(df.repartition(2), ["seq"]))
    assert first == rows(validate.tag_individual(df.repartition(11, "bmi"), ["seq"]))


def test_environment_quarantine_and_report(spark):
    rows = [(1, "s1", "pm25", 5.0, "2024-01-01 00:00:00"), (2, "s1", "pm25", 6.0, "2024-01-01 00:00:00"),
            (3, "s1", "pm25", None, "2024-01-01 00:00:00"), (4, "s2", "pm25", 1.0, None),
            (5, "s2", "no2", None, None), (6, "s3", "o3", 2.0, "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "event_id long, location_id string, parameter string, value double, m string")
    df = df.withColumn("measured_at", F.to_timestamp("m")).drop("m")
    clean, quarantine = validate.validate_environment_rows(df, ["event_id"])
    assert sorted(r["event_id"] for r in clean.collect()) == [1, 6]
    assert sorted((r["event_id"], r["_reject"]) for r in quarantine.collect()) == [
        (3, "null_value"), (4, "null_measured_at"), (5, "null_value; null_measured_at")]
    report = {r["metric"]: r["value"] for r in validate.environment_report(df).collect()}
    assert report == {"total_rows": 6, "duplicate_rows": 1, "valid_rows": 2, "quarantined_rows": 3,
                      "missing_required": 4}
    assert validate.environment_report(df.limit(0)).filter("metric = 'total_rows'").first()["value"] == 0
