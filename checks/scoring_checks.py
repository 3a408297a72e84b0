"""Registered queries: fusion, metrics, folds, drift, monitoring, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sqltext as q
from checks.features_checks import clean_population, stamp
from cohort_risk import config as C
from cohort_risk.operators import drift, folds, metrics, monitor, population, scoring, views
from cohort_risk.session import stored
from cohort_risk.sinks.tables import latest_snapshot

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def probs(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load(spark, sf, fx.BRANCH_PROBS)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.scored_records(probs(spark, sf), F.col("scored_at"))


_S = q.scored(fx.BRANCH_PROBS)
_STAMP = "strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at"
_RESULT = ", ".join([*C.RESULT_COLUMNS[:-1], _STAMP])


@register("ensemble_scores", q.with_ctes(_S, f"SELECT {_RESULT} FROM scored"))
def ensemble_scores(spark, sf):
    return scored(spark, sf).withColumn("scored_at", stamp("scored_at"))


@register("results_schema", q.with_ctes({"probs": fx.BRANCH_PROBS}, f"""SELECT patient_id, country_iso3, age_group_bin,
  sex, CAST(NULL AS DOUBLE) AS prob_low, CAST(NULL AS DOUBLE) AS prob_moderate, CAST(NULL AS DOUBLE) AS prob_high,
  CAST(NULL AS DOUBLE) AS ensemble_risk_score, CAST(NULL AS INT) AS predicted_class, CAST(NULL AS VARCHAR) AS predicted_label,
  CAST(NULL AS INT) AS warning_level, CAST(NULL AS VARCHAR) AS warning_label, CAST(NULL AS VARCHAR) AS warning_message,
  CAST(NULL AS DOUBLE) AS branch_a_score, CAST(NULL AS DOUBLE) AS branch_b_score, CAST(NULL AS VARCHAR) AS signal_type,
  {_STAMP} FROM probs"""))
def results_schema(spark, sf):
    return scoring.result_schema(probs(spark, sf)).withColumn("scored_at", stamp("scored_at"))


@register("score_patient_filter", q.with_ctes(
    _S, f"SELECT {_RESULT} FROM scored WHERE patient_id IN (SELECT concat('o', max(o_orderkey)) FROM orders)"))
def score_patient_filter(spark, sf):
    everyone = probs(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    wanted = orders.agg(F.concat(F.lit("o"), F.max("o_orderkey")).alias("id")).scalar()
    one = everyone.filter(F.col("patient_id") == wanted)
    return scoring.scored_records(one, F.col("scored_at")).withColumn(
        "scored_at", stamp("scored_at"))


# Two branch tables with repeated keys; users and customers overlap in part.
_SIDE_A = """SELECT concat('p', c_custkey) AS patient_id, c_custkey AS seq, c_acctbal AS a_high FROM customer
  UNION ALL SELECT concat('p', o_custkey), 1000000 + o_orderkey, o_totalprice FROM orders"""
_SIDE_B = """SELECT concat('p', user_id) AS patient_id, event_id AS seq, value AS b_high FROM events"""


@register("align_branches", f"""SELECT a.patient_id, a.seq, a.a_high, b.b_high FROM
  (SELECT * FROM ({_SIDE_A}) x QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY seq) = 1) a
  JOIN (SELECT * FROM ({_SIDE_B}) y QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY seq) = 1) b
  ON a.patient_id = b.patient_id""")
def align_branches(spark, sf):
    a, b = fx.load(spark, sf, _SIDE_A), fx.load(spark, sf, _SIDE_B)
    return scoring.align_branches(a, b, ["patient_id"], ["seq"])


@register("common_ids", f"""SELECT patient_id, seq, a_high FROM ({_SIDE_A}) a
  WHERE patient_id IN (SELECT patient_id FROM ({_SIDE_B}) b)""")
def common_ids(spark, sf):
    return scoring.common_ids(fx.load(spark, sf, _SIDE_A), fx.load(spark, sf, _SIDE_B))


@register("level_distribution", q.with_ctes(_S, """SELECT warning_level, count(*) AS n_patients,
  round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS share FROM scored GROUP BY warning_level"""))
def level_distribution(spark, sf):
    return scoring.level_distribution(scored(spark, sf)).withColumn("share", F.round("share", 9))


@register("top_risk", q.with_ctes(_S, """SELECT patient_id, ensemble_risk_score, warning_level, warning_label, signal_type
  FROM scored ORDER BY ensemble_risk_score DESC, patient_id LIMIT 5"""))
def top_risk(spark, sf):
    return scoring.top_risk(scored(spark, sf))


_SNAP = """SELECT event_id, user_id, value, CAST(date_trunc('day', ts) AS DATE) AS snapshot_ts FROM events"""


@register("latest_snapshot", f"""SELECT event_id, user_id, value, CAST(snapshot_ts AS VARCHAR) AS snapshot_ts FROM ({_SNAP}) s
  WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM ({_SNAP}) t)""")
def latest(spark, sf):
    return latest_snapshot(fx.load(spark, sf, _SNAP)).withColumn(
        "snapshot_ts", F.col("snapshot_ts").cast("string"))


# --- metrics -----------------------------------------------------------------------

# Long form: two models per branch, their predictions taken from the two branches.
_PREDICTED = """SELECT branch, model, true_label, pred FROM (
  SELECT true_label, CASE WHEN a_low >= a_mod AND a_low >= a_high THEN 0 WHEN a_mod >= a_high THEN 1 ELSE 2 END AS pa,
    CASE WHEN b_low >= b_mod AND b_low >= b_high THEN 0 WHEN b_mod >= b_high THEN 1 ELSE 2 END AS pb FROM probs) p
  CROSS JOIN LATERAL (VALUES ('A', 'forest', pa), ('A', 'kernel', pb), ('B', 'forest', pb), ('B', 'kernel', pa)) AS v(branch, model, pred)"""
_M = {"probs": fx.BRANCH_PROBS, "pred": _PREDICTED,
      "conf": "SELECT branch, model, true_label AS truth, pred, count(*) AS n_rows FROM pred "
              "WHERE true_label IS NOT NULL GROUP BY ALL",
      "sides": "SELECT branch, model, truth AS label, CASE WHEN truth = pred THEN n_rows ELSE 0 END AS tp, "
               "n_rows AS support, 0 AS predicted FROM conf UNION ALL "
               "SELECT branch, model, pred, 0, 0, n_rows FROM conf",
      "report": "SELECT branch, model, label, coalesce(sum(tp) / CAST(nullif(sum(predicted), 0) AS DOUBLE), 0) AS precision, "
                "coalesce(sum(tp) / CAST(nullif(sum(support), 0) AS DOUBLE), 0) AS recall, "
                "coalesce(2 * sum(tp) / CAST(nullif(sum(support) + sum(predicted), 0) AS DOUBLE), 0) AS f1, "
                "CAST(sum(support) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp FROM sides GROUP BY ALL",
      "summary": "SELECT branch, model, sum(tp) / CAST(sum(support) AS DOUBLE) AS accuracy, avg(f1) AS f1_macro, "
                 "CAST(sum(support) AS BIGINT) AS n_rows FROM report GROUP BY ALL"}
_BY = ["branch", "model"]


def predictions(spark, sf) -> DataFrame:
    df = probs(spark, sf).select(
        "true_label", scoring.first_argmax(["a_low", "a_mod", "a_high"]).alias("pa"),
        scoring.first_argmax(["b_low", "b_mod", "b_high"]).alias("pb"))
    cells = [F.struct(F.lit(b).alias("branch"), F.lit(m).alias("model"), F.col(p).alias("pred"))
             for b, m, p in [("A", "forest", "pa"), ("A", "kernel", "pb"),
                             ("B", "forest", "pb"), ("B", "kernel", "pa")]]
    return df.select("true_label", F.inline(F.array(*cells)))


@register("confusion_matrix", q.with_ctes(_M, "SELECT branch, model, truth, pred, n_rows FROM conf"))
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), "true_label", "pred", _BY)


@register("class_report", q.with_ctes(_M, """SELECT branch, model, label, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM report"""))
def class_report(spark, sf):
    conf = metrics.confusion_matrix(predictions(spark, sf), "true_label", "pred", _BY)
    return metrics.class_report(conf, _BY).withColumns(
        {c: F.round(c, 9) for c in ["precision", "recall", "f1"]})


@register("f1_vs_truth", q.with_ctes(_M, """SELECT branch, model, round(accuracy, 9) AS accuracy,
  round(f1_macro, 9) AS f1_macro, n_rows FROM summary"""))
def f1_vs_truth(spark, sf):
    return metrics.macro_f1(predictions(spark, sf), "true_label", "pred", _BY).withColumns(
        {c: F.round(c, 9) for c in ["accuracy", "f1_macro"]})


@register("primary_model", q.with_ctes(_M, """SELECT branch, arg_max(model, f1_macro + CASE WHEN model = 'forest' THEN 1e-12 ELSE 0 END)
  AS primary_model FROM summary GROUP BY branch"""))
def primary_model(spark, sf):
    scores = metrics.macro_f1(predictions(spark, sf), "true_label", "pred", _BY)
    return metrics.primary_model(scores)


def _auc_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT {i} AS label, a_{c} AS score, true_label = {i} AS hit FROM probs "
        "WHERE true_label IS NOT NULL" for i, c in enumerate(["low", "mod", "high"]))
    return f"""SELECT label, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
      sum(pos * (cum - neg + neg / 2.0)) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS auc FROM (
        SELECT *, sum(neg) OVER (PARTITION BY label ORDER BY score) AS cum FROM (
          SELECT label, score, count(*) FILTER (WHERE hit) AS pos, count(*) FILTER (WHERE NOT hit) AS neg
          FROM ({cells}) c GROUP BY label, score) g) w GROUP BY label"""


_AUC = {"probs": fx.BRANCH_PROBS, "auc": _auc_sql()}
_A_PROBS = ["a_low", "a_mod", "a_high"]


@register("roc_auc_ovr", q.with_ctes(_AUC, "SELECT label, n_pos, n_neg, round(auc, 9) AS auc FROM auc"))
def roc_auc_ovr(spark, sf):
    return metrics.roc_auc_by_class(probs(spark, sf), "true_label", _A_PROBS).withColumn(
        "auc", F.round("auc", 9))


@register("roc_auc_macro", q.with_ctes(_AUC, "SELECT round(avg(auc), 9) AS roc_auc FROM auc"))
def roc_auc_macro(spark, sf):
    return metrics.roc_auc_macro(probs(spark, sf), "true_label", _A_PROBS).withColumn(
        "roc_auc", F.round("roc_auc", 9))


_ORDERED = """SELECT patient_id, true_label, row_number() OVER (PARTITION BY true_label
  ORDER BY md5(concat_ws('|', '42', patient_id)), patient_id) - 1 AS pos, count(*) OVER (PARTITION BY true_label) AS n
  FROM probs WHERE true_label IS NOT NULL"""


@register("stratified_folds", q.with_ctes({"probs": fx.BRANCH_PROBS, "ord": _ORDERED},
          "SELECT patient_id, true_label, CAST(pos % 5 AS INT) AS fold FROM ord"))
def stratified_folds(spark, sf):
    rows = probs(spark, sf).select("patient_id", "true_label")
    return folds.stratified_folds(rows, "true_label", ["patient_id"])


@register("stratified_holdout", q.with_ctes({"probs": fx.BRANCH_PROBS, "ord": _ORDERED},
          "SELECT patient_id, true_label, pos < ceil(n * 0.2) AS is_test FROM ord"))
def stratified_holdout(spark, sf):
    rows = probs(spark, sf).select("patient_id", "true_label")
    return folds.stratified_holdout(rows, "true_label", ["patient_id"])


@register("class_distribution", q.with_ctes({"probs": fx.BRANCH_PROBS}, """SELECT true_label, count(*) AS n_rows
  FROM probs WHERE true_label IS NOT NULL GROUP BY true_label"""))
def class_distribution(spark, sf):
    return folds.class_distribution(probs(spark, sf), "true_label")


@register("class_weights", q.with_ctes({"probs": fx.BRANCH_PROBS}, """SELECT true_label, count(*) AS n_rows,
  round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 9) AS weight
  FROM probs WHERE true_label IS NOT NULL GROUP BY true_label"""))
def class_weights(spark, sf):
    return folds.class_weights(probs(spark, sf), "true_label").withColumn(
        "weight", F.round("weight", 9))


# --- drift -------------------------------------------------------------------------

_EDGES = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(11))
_Z = "((value - mean) / std)"


def _poly(x: str, coefficients: list[float]) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


def _phi(z: str) -> str:
    """Normal distribution function by the same rational approximation."""
    from cohort_risk.functions.stats import _HART_DENOMINATOR, _HART_NUMERATOR
    x = f"abs({z})"
    near = f"{_poly(x, _HART_NUMERATOR)} / {_poly(x, _HART_DENOMINATOR)}"
    far = (f"1 / (({x} + 1 / ({x} + 2 / ({x} + 3 / ({x} + 4 / ({x} + 0.65))))) "
           "* 2.506628274631e0)")
    tail = (f"(CASE WHEN {x} > 37 THEN 0e0 ELSE exp(-{x} * {x} / 2) * "
            f"(CASE WHEN {x} < 7.07106781186547e0 THEN {near} ELSE {far} END) END)")
    return f"(CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END)"


def _q(d: str, n: str) -> str:
    """Kolmogorov series."""
    lam2 = f"({n} * {d} * {d})"
    series = ("list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END) "
              f"* exp(-2e0 * k * k * {lam2})))")
    return f"(CASE WHEN {lam2} < 0.04 THEN 1e0 ELSE greatest(0e0, least(1e0, {series})) END)"


_B = {
    "vals": fx.DRIFT,
    "base": "SELECT feature, value FROM vals WHERE side = 'baseline' AND value IS NOT NULL",
    "stats": "SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, quantile_cont(value, 0.5) AS median, "
             "quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.95) AS p95, count(*) AS n, "
             f"list_sort(list_distinct([{_EDGES}])) AS edges FROM base GROUP BY feature "
             "HAVING count(*) >= 10 AND len(list_sort(list_distinct([" + _EDGES + "]))) >= 3",
    "bins": "SELECT feature, i AS bin, edges[i + 1] AS low, edges[i + 2] AS high, i = len(edges) - 2 AS last "
            "FROM (SELECT feature, edges, unnest(range(0, len(edges) - 1)) AS i FROM stats) s",
    "bcount": "SELECT b.feature, b.bin, any_value(low) AS low, any_value(high) AS high, any_value(last) AS last, "
              "count(v.value) AS baseline_count FROM bins b LEFT JOIN base v ON v.feature = b.feature AND "
              "v.value >= low AND (v.value < high OR (last AND v.value = high)) GROUP BY b.feature, b.bin",
}
_C = {
    **_B,
    "cur": "SELECT feature, value FROM vals WHERE side = 'current' AND value IS NOT NULL",
    "ccount": "SELECT b.feature, b.bin, any_value(baseline_count) AS baseline_count, count(v.value) AS current_count "
              "FROM bcount b LEFT JOIN cur v ON v.feature = b.feature AND v.value >= low AND "
              "(v.value < high OR (last AND v.value = high)) GROUP BY b.feature, b.bin",
    "shares": "SELECT feature, CASE WHEN baseline_count = 0 THEN 1e-4 ELSE baseline_count / (sum(baseline_count) OVER w + 1e-10) END AS b, "
              "CASE WHEN current_count = 0 THEN 1e-4 ELSE current_count / (sum(current_count) OVER w + 1e-10) END AS c "
              "FROM ccount WINDOW w AS (PARTITION BY feature)",
    "psi": "SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM shares GROUP BY feature",
    "ranked": "SELECT feature, value, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature ORDER BY value) AS cum, "
              "sum(count(*)) OVER (PARTITION BY feature) AS total FROM cur GROUP BY feature, value",
    "ks": f"SELECT feature, ks_stat, {_q('ks_stat', 'total')} AS ks_pval FROM (SELECT r.feature, max(total) AS total, "
          f"max(greatest(cum / CAST(total AS DOUBLE) - {_phi(_Z)}, {_phi(_Z)} - (cum - r.n) / CAST(total AS DOUBLE))) AS ks_stat "
          "FROM ranked r JOIN stats s ON r.feature = s.feature GROUP BY r.feature) k",
    "report": "SELECT c.feature, psi, ks_stat, ks_pval, abs(current_mean - s.mean) / (abs(s.mean) + 1e-10) * 100 AS mean_shift_pct, "
              "current_mean, s.mean AS baseline_mean, n_current, CASE WHEN psi > 0.25 OR ks_pval < 0.05 THEN 'alert' "
              "WHEN psi > 0.10 THEN 'warn' ELSE 'ok' END AS status FROM (SELECT feature, count(*) AS n_current, avg(value) AS current_mean "
              "FROM cur GROUP BY feature HAVING count(*) >= 20) c JOIN stats s USING (feature) JOIN psi USING (feature) JOIN ks USING (feature)",
}


def samples(spark, sf) -> DataFrame:
    return fx.load(spark, sf, fx.DRIFT)


def side(spark, sf, name: str) -> DataFrame:
    return samples(spark, sf).filter(F.col("side") == name).select("feature", "value")


def baseline(spark, sf) -> DataFrame:
    """The baseline is a stored artefact: computed once, read by every later run."""
    return stored(drift.compute_baseline(side(spark, sf, "baseline")), "baseline")


def report(spark, sf) -> DataFrame:
    return drift.detect_drift(side(spark, sf, "current"), baseline(spark, sf))


_STATS = ["mean", "std", "median", "p5", "p95"]


@register("drift_baseline", q.with_ctes(_B, "SELECT feature, " + ", ".join(
    f"round({c}, 7) AS {c}" for c in _STATS) + ", n, len(edges) AS n_edges FROM stats"))
def drift_baseline(spark, sf):
    out = drift.baseline_stats(drift.stored_counts(side(spark, sf, "baseline")))
    return out.select("feature", *[F.round(c, 7).alias(c) for c in _STATS], "n",
                      F.size("bin_edges").cast("bigint").alias("n_edges"))


@register("drift_bins", q.with_ctes(_B, """SELECT feature, bin, round(low, 7) AS low, round(high, 7) AS high,
  baseline_count FROM bcount"""))
def drift_bins(spark, sf):
    out = drift.baseline_bins(drift.compute_baseline(side(spark, sf, "baseline")))
    return out.select("feature", F.col("bin").cast("bigint").alias("bin"),
                      F.round("low", 7).alias("low"), F.round("high", 7).alias("high"),
                      "baseline_count")


@register("psi", q.with_ctes(_C, "SELECT feature, round(psi, 9) AS psi FROM psi"))
def psi(spark, sf):
    counts = drift.stored_counts(side(spark, sf, "current"))
    return drift.psi(drift.baseline_bins(baseline(spark, sf)), counts).withColumn(
        "psi", F.round("psi", 9))


@register("ks_two_sample", q.with_ctes({"vals": fx.DRIFT}, f"""SELECT feature, round(ks_stat, 9) AS ks_stat,
  CAST(nb AS BIGINT) AS n_baseline, CAST(nc AS BIGINT) AS n_current,
  round({_q('ks_stat', '(nb * nc / CAST(nb + nc AS DOUBLE))')}, 9) AS ks_pval FROM (
    SELECT feature, max(abs(cb / CAST(nb AS DOUBLE) - cc / CAST(nc AS DOUBLE))) AS ks_stat, max(nb) AS nb, max(nc) AS nc FROM (
      SELECT feature, sum(b) OVER w AS cb, sum(c) OVER w AS cc, sum(b) OVER p AS nb, sum(c) OVER p AS nc FROM (
        SELECT feature, value, count(*) FILTER (WHERE side = 'baseline') AS b, count(*) FILTER (WHERE side = 'current') AS c
        FROM vals WHERE value IS NOT NULL GROUP BY feature, value) g
      WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature)) r GROUP BY feature) k"""))
def ks_two_sample(spark, sf):
    out = drift.ks_two_sample(samples(spark, sf), F.col("side") == "baseline")
    return out.withColumns({c: F.round(c, 9) for c in ["ks_stat", "ks_pval"]})


@register("ks_one_sample", q.with_ctes(_C, "SELECT feature, round(ks_stat, 8) AS ks_stat, round(ks_pval, 8) AS ks_pval FROM ks"))
def ks_one_sample(spark, sf):
    counts = drift.stored_counts(side(spark, sf, "current"))
    out = drift.ks_normal(counts, baseline(spark, sf))
    return out.withColumns({c: F.round(c, 8) for c in ["ks_stat", "ks_pval"]})


_DIGITS = {"psi": 4, "ks_stat": 4, "ks_pval": 4, "mean_shift_pct": 2, "current_mean": 3,
           "baseline_mean": 3}


@register("drift_report", q.with_ctes(_C, "SELECT feature, " + ", ".join(
    f"{q.rnd(c, d)} AS {c}" for c, d in _DIGITS.items()) + ", n_current, status FROM report"))
def drift_report(spark, sf):
    return drift.rounded_report(report(spark, sf))


@register("top_drift", q.with_ctes(
    _C, "SELECT feature, round(psi, 9) AS psi, status FROM report ORDER BY report.psi DESC, feature LIMIT 5"))
def top_drift(spark, sf):
    return drift.top_drift(report(spark, sf)).select("feature", F.round("psi", 9).alias("psi"), "status")


# --- monitoring --------------------------------------------------------------------

_F1 = {"conf": "SELECT true_label AS truth, predicted_class AS pred, count(*) AS n FROM scored "
               "WHERE true_label IS NOT NULL GROUP BY ALL",
       "f1": "SELECT avg(f1) AS f1_macro FROM (SELECT label, 2 * sum(tp) / CAST(sum(size) AS DOUBLE) AS f1 FROM ("
             "SELECT truth AS label, CASE WHEN truth = pred THEN n ELSE 0 END AS tp, n AS size FROM conf "
             "UNION ALL SELECT pred, 0, n FROM conf) s GROUP BY label) r"}
_LEVELS = ", ".join(f"avg(CASE WHEN warning_level = {k} THEN 1e0 ELSE 0e0 END) AS level_share_{k}" for k in (1, 2, 3, 4))
_PERF = {**_S, **_F1, "perf": f"""SELECT {_LEVELS}, (SELECT f1_macro FROM f1) AS f1_macro_vs_groundtruth,
  avg(CASE WHEN warning_level >= 3 THEN 1e0 ELSE 0e0 END) AS high_risk_rate,
  avg(abs(branch_a_score - branch_b_score)) AS branch_divergence_mean, avg(branch_a_score) AS branch_a_mean,
  avg(branch_b_score) AS branch_b_mean, avg(ensemble_risk_score) AS risk_score_mean,
  stddev_samp(ensemble_risk_score) AS risk_score_std, quantile_cont(ensemble_risk_score, 0.9) AS risk_score_p90,
  count(*) AS n_scored FROM scored"""}
_PERF_COLS = ["high_risk_rate", "branch_divergence_mean", "branch_a_mean", "branch_b_mean",
              "risk_score_mean", "risk_score_std", "risk_score_p90", "f1_macro_vs_groundtruth",
              *[f"level_share_{k}" for k in (1, 2, 3, 4)]]


@register("performance_metrics", q.with_ctes(_PERF, "SELECT " + ", ".join(
    f"round({c}, 8) AS {c}" for c in _PERF_COLS) + ", n_scored FROM perf"))
def performance_metrics(spark, sf):
    return monitor.performance_metrics(scored(spark, sf), _overall_f1(spark, sf)).withColumns(
        {c: F.round(c, 8) for c in _PERF_COLS})


_MON = {**{("report" if k == "report" else k): v for k, v in _C.items()}, **_PERF}


def _overall_f1(spark, sf) -> DataFrame:
    df = probs(spark, sf)
    out = scoring.ensemble(df).select(
        "true_label", scoring.first_argmax(["p_low", "p_mod", "p_high"]).alias("pred"))
    return metrics.macro_f1(out, "true_label", "pred").select("f1_macro")


_REFERENCE_F1 = 0.9
_NAMES = "'[' || coalesce(string_agg('''' || feature || '''', ', ' ORDER BY feature) FILTER (WHERE status = '{s}'), '') || ']'"
_DECISION = {**_MON, **_F1, "decision": f"""SELECT n_alert, n_warn, concat_ws('; ',
    CASE WHEN n_alert >= 1 THEN 'PSI/KS alert on features: ' || alerts END,
    CASE WHEN n_warn >= 3 THEN '3+ features in warn state: ' || warns END,
    (SELECT CASE WHEN {_REFERENCE_F1} - f1_macro > 0.10 THEN printf('F1 degraded by %.3f (ref=%.3f -> current=%.3f)',
      CAST({_REFERENCE_F1} AS DOUBLE) - f1_macro, CAST({_REFERENCE_F1} AS DOUBLE), f1_macro) END FROM f1)) AS reasons FROM (
  SELECT count(*) FILTER (WHERE status = 'alert') AS n_alert, count(*) FILTER (WHERE status = 'warn') AS n_warn,
    {_NAMES.format(s='alert')} AS alerts, {_NAMES.format(s='warn')} AS warns FROM report) d"""}


def decision(spark, sf, drifted: DataFrame) -> DataFrame:
    return monitor.retrain_decision(drifted, _overall_f1(spark, sf), _REFERENCE_F1)


@register("retrain_decision", q.with_ctes(
    _DECISION, "SELECT n_alert, n_warn, reasons, reasons <> '' AS retrain_triggered FROM decision"))
def retrain_decision(spark, sf):
    return decision(spark, sf, report(spark, sf))


_SUMMARY = """SELECT 'n_features_monitored' AS metric, CAST(count(*) AS DOUBLE) AS value FROM report
  UNION ALL SELECT 'n_features_alert', count(*) FILTER (WHERE status = 'alert') FROM report
  UNION ALL SELECT 'n_features_warn', count(*) FILTER (WHERE status = 'warn') FROM report
  UNION ALL SELECT 'n_features_ok', count(*) FILTER (WHERE status = 'ok') FROM report
  UNION ALL SELECT 'high_risk_rate', high_risk_rate FROM perf"""


@register("monitoring_summary", q.with_ctes(
    _MON, f"SELECT metric, round(value, 9) AS value FROM ({_SUMMARY}) s"))
def monitoring_summary(spark, sf):
    out = monitor.monitoring_summary(
        report(spark, sf), monitor.performance_metrics(scored(spark, sf)))
    return out.withColumn("value", F.round("value", 9))


# --- views -------------------------------------------------------------------------


@register("view_patient_scores", q.with_ctes(_S, f"""SELECT {_RESULT},
  {q.band('ensemble_risk_score', [0, .25, .45, .65, 1.01], ['low', 'moderate', 'high', 'critical'])} AS risk_tier,
  {q.truth('branch_a_score > branch_b_score')} AS branch_a_dominant, strftime(scored_at, '%Y-%m-%d') AS scored_date,
  CAST(hour(scored_at) AS INT) AS scored_hour FROM scored"""))
def view_patient_scores(spark, sf):
    return views.patient_scores(scored(spark, sf)).withColumn("scored_at", stamp("scored_at"))


_HEAT = {**_S, **{k: v for k, v in q.population(fx.POPULATION).items() if k != "pop_wide"},
         "means": "SELECT country_iso3, " + ", ".join(
             f"avg(CASE WHEN feature_name = '{i}' THEN value END) AS {i}"
             for i in C.HEATMAP_INDICATORS) + " FROM pop_long GROUP BY country_iso3"}
_PCT = ", ".join(f"round(avg(CASE WHEN warning_level = {i} THEN 1e0 ELSE 0e0 END), 8) AS pct_warning_level_{i}"
                 for i in range(1, 5))
_KEYS = "country_iso3, age_group_bin, sex"


@register("view_heatmap", q.with_ctes(_HEAT, f"""SELECT h.*, {', '.join(f'round(m.{i}, 8) AS {i}' for i in C.HEATMAP_INDICATORS)}
  FROM (SELECT {_KEYS}, count(patient_id) AS n_patients, {q.rnd('CAST(sum(CAST(round(ensemble_risk_score * 10000) AS BIGINT)) AS DOUBLE) / count(ensemble_risk_score) / 10000', 4)} AS mean_risk_score, {_PCT},
    {q.rnd('avg(CASE WHEN warning_level >= 3 THEN 1e0 ELSE 0e0 END)', 4)} AS pct_high_risk,
    {q.rnd('CAST(sum(CAST(round(branch_a_score * 10000) AS BIGINT)) AS DOUBLE) / count(branch_a_score) / 10000', 4)} AS mean_branch_a_score, {q.rnd('CAST(sum(CAST(round(branch_b_score * 10000) AS BIGINT)) AS DOUBLE) / count(branch_b_score) / 10000', 4)} AS mean_branch_b_score,
    (array_agg(signal_type ORDER BY sn DESC, signal_type))[1] AS dominant_signal
    FROM (SELECT *, count(*) OVER (PARTITION BY {_KEYS}, signal_type) AS sn FROM scored) s GROUP BY {_KEYS}) h
  LEFT JOIN means m ON h.country_iso3 = m.country_iso3"""))
def view_heatmap(spark, sf):
    long, _ = population.transform_population(clean_population(spark, sf), ["row_order"])
    out = views.population_heatmap(scored(spark, sf), long)
    return out.withColumns({c: F.round(c, 8) for c in [
        *[f"pct_warning_level_{i}" for i in range(1, 5)], *C.HEATMAP_INDICATORS]})


def _group_case() -> str:
    groups = {f: g for g, members in C.CLINICAL_GROUPS.items() for f in members}
    return q.case_map("feature", groups, "'other'")


@register("view_feature_importance", q.with_ctes({"imp": fx.IMPORTANCE}, f"""SELECT branch,
  {q.case_map('branch', C.BRANCH_LABELS)} AS branch_label, feature, importance, CAST(rank() OVER (PARTITION BY branch ORDER BY importance DESC) AS INT) AS rank,
  {q.rnd('importance / sum(importance) OVER (PARTITION BY branch) * 100', 2)} AS pct_of_total, {_group_case()} AS clinical_group
  FROM (SELECT branch, feature, {q.rnd('importance', 5)} AS importance FROM imp) i"""))
def view_feature_importance(spark, sf):
    return views.feature_importance(fx.load(spark, sf, fx.IMPORTANCE))


@register("top_importances", q.with_ctes({"imp": fx.IMPORTANCE}, """SELECT branch, feature, importance, CAST(position AS INT) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY branch ORDER BY importance DESC, feature) AS position FROM imp) r WHERE position <= 5"""))
def top_importances(spark, sf):
    return views.top_importances(fx.load(spark, sf, fx.IMPORTANCE))


@register("view_model_health", q.with_ctes(_DECISION, f"""SELECT metric_type, metric_name, round(value, 8) AS value, status,
  '2024-06-01 00:00:00' AS timestamp, (SELECT reasons <> '' FROM decision) AS retrain_triggered FROM (
    SELECT 'performance' AS metric_type, 'high_risk_rate' AS metric_name, high_risk_rate AS value, 'ok' AS status FROM perf
    UNION ALL SELECT 'performance', 'risk_score_mean', risk_score_mean, 'ok' FROM perf
    UNION ALL SELECT 'performance', 'branch_divergence_mean', branch_divergence_mean,
      CASE WHEN branch_divergence_mean > 0.3 THEN 'warn' ELSE 'ok' END FROM perf
    UNION ALL SELECT 'drift', feature, psi, status FROM report
    UNION ALL SELECT 'summary', metric, value, 'ok' FROM ({_SUMMARY}) s) h"""))
def view_model_health(spark, sf):
    drifted = stored(report(spark, sf), "drift_report")
    perf = monitor.performance_metrics(scored(spark, sf))
    out = views.model_health(perf, drifted, monitor.monitoring_summary(drifted, perf),
                             decision(spark, sf, drifted), F.lit("2024-06-01 00:00:00"))
    return out.withColumn("value", F.round("value", 8))
