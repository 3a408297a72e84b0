"""Registered queries: models, scoring runs, monitoring runs, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import scoring_checks as sc
from checks import sqltext as q
from checks import source_checks as src
from checks.features_checks import _FULL, clean_individuals, fitted
from cohort_risk import config as C
from cohort_risk.operators import drift, monitor, validate
from cohort_risk.plans import monitoring, score, training
from cohort_risk.session import shared_dir, stored
from cohort_risk.sinks import runs, tables
from cohort_risk.streaming import readings

QUERIES = {}
ORACLES = {}

FOREST = C.ForestParams()
KERNEL = C.KernelParams()
SCORED_AT = "2024-06-01 00:00:00"


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table, stored as it is between the feature and the training run."""
    model, ind = fitted(spark, sf)
    return stored(model.transform(ind, with_target=True), "features")


def _features(branch: str) -> list[str]:
    return C.BRANCH_A_FEATURES if branch == "A" else C.BRANCH_B_FEATURES


def _train(df: DataFrame, branch: str, cv=True) -> training.BranchResult:
    """Both models of a branch; ``cv=False`` where nothing reads fold scores."""
    return training.train_branch(df, branch, _features(branch), ["patient_id", "seq"],
                                 FOREST, KERNEL, cv=cv)


@register("train_branch_forest")
def train_branch_forest(spark, sf):
    """Gini importances of the forests of both branches."""
    df = enriched(spark, sf)
    a, b = (_train(df, branch, cv=False).importances for branch in ("A", "B"))
    return a.unionByName(b)


@register("train_branch_kernel")
def train_branch_kernel(spark, sf):
    """Hold-out metrics of both models of both branches, with means and deviations of the folds."""
    df = enriched(spark, sf)
    a, b = (_train(df, branch).metrics for branch in ("A", "B"))
    return a.unionByName(b)


def _class_counts_sql() -> str:
    parts = []
    for branch in ("A", "B"):
        names = _features(branch)
        complete = " AND ".join(f"{c} IS NOT NULL" for c in [C.TARGET, *names])
        parts.append(f"""SELECT '{branch}' AS branch, CAST({len(names)} AS BIGINT) AS n_features,
  '{",".join(names)}' AS features, CAST({C.TARGET} AS INT) AS class, count(*) AS n_rows
FROM enriched WHERE {complete} GROUP BY {C.TARGET}""")
    return q.with_ctes(_FULL, "\nUNION ALL\n".join(parts))


@register("training_metadata", _class_counts_sql())
def training_metadata(spark, sf):
    """Class counts of both branches, read back from the newest committed training run."""
    root = shared_dir(spark, "training-runs")
    training.train_run(enriched(spark, sf), root, ["patient_id", "seq"], forest=FOREST, kernel=KERNEL)
    manifest = runs.latest(spark, root)
    shape = spark.createDataFrame(
        [(b, m["n_features"], ",".join(m["features"])) for b, m in manifest["branches"].items()],
        "branch string, n_features long, features string")
    return runs.read_table(spark, root, manifest, "class_dist").join(shape, "branch").select(
        "branch", "n_features", "features", "class", "n_rows")


@register("score_with_models")
def score_with_models(spark, sf):
    """Features, the primary model of each branch, ensemble, gates."""
    df = enriched(spark, sf)
    models = [_train(df, b, cv=False).model for b in ("A", "B")]
    return score.score(df, *models, F.lit(SCORED_AT).cast("timestamp"))


@register("score_without_models", q.with_ctes(
    q.validated(fx.INDIVIDUAL), f"""SELECT patient_id, country_iso3, {q.band('age')} AS age_group_bin, sex,
  0.3333e0 AS prob_low, 0.3333e0 AS prob_moderate, 0.3333e0 AS prob_high, 0.3333e0 AS ensemble_risk_score,
  0 AS predicted_class, 'low' AS predicted_label, 2 AS warning_level, 'moderate' AS warning_label,
  'Elevated risk. Lifestyle review recommended.' AS warning_message, 0.3333e0 AS branch_a_score, 0.3333e0 AS branch_b_score,
  'both' AS signal_type, '{SCORED_AT}' AS scored_at FROM clean"""))
def score_without_models(spark, sf):
    from cohort_risk.operators.individual import add_age_band
    ind = add_age_band(clean_individuals(spark, sf))
    out = score.score(ind, None, None, F.lit(SCORED_AT).cast("timestamp"))
    return out.withColumn("scored_at", F.date_format("scored_at", "yyyy-MM-dd HH:mm:ss"))


_SCALED = ["systolic_bp", "bmi", "age"]


@register("standardize", q.with_ctes(q.validated(fx.INDIVIDUAL), "SELECT patient_id, seq, " + ", ".join(
    f"round((x_{c} - avg(x_{c}) OVER ()) / stddev_samp(x_{c}) OVER (), 7) AS z_{c}" for c in _SCALED)
    + " FROM (SELECT patient_id, seq, " + ", ".join(f"coalesce({c}, 0) AS x_{c}" for c in _SCALED)
    + " FROM clean) c"))
def standardize(spark, sf):
    out = training.standardised(clean_individuals(spark, sf), _SCALED)
    return out.select("patient_id", "seq", *[F.round(f"z_{c}", 7).alias(f"z_{c}") for c in _SCALED])


@register("cross_validation")
def cross_validation(spark, sf):
    """Macro F1 of both models of both branches per fold."""
    df, found = enriched(spark, sf), []
    for branch in ("A", "B"):
        names = _features(branch)
        prep = training.prepare(training.training_rows(df, names, ["patient_id", "seq"]), names, KERNEL)
        scores = training.cross_validate_prepared(prep, [training.FOREST, training.KERNEL], FOREST, KERNEL)
        for name, f1s in scores.items():
            found += [(branch, name, i, f1) for i, f1 in enumerate(f1s)]
    return spark.createDataFrame(found, "branch string, model string, fold int, f1_macro double")


# --- tables ------------------------------------------------------------------------

_KEPT = ["patient_id", "ensemble_risk_score", "warning_level"]


@register("snapshot_round_trip", q.with_ctes(
    q.scored(fx.BRANCH_PROBS), f"SELECT {', '.join(_KEPT)} FROM scored WHERE warning_level >= 3"))
def snapshot_round_trip(spark, sf):
    """A full run, a later full run over the high-risk rows, and a partial one on top."""
    path = shared_dir(spark, "scores")
    everyone = sc.scored(spark, sf)
    tables.write_scores(everyone, path, "20240101_000000")
    tables.write_scores(everyone.filter("warning_level >= 3"), path, "20240102_000000")
    tables.write_scores(everyone.filter("warning_level = 1"), path, "20240103_000000", partial=True)
    return tables.read_scores(spark, path).select(*_KEPT)


@register("landed_round_trip", q.with_ctes(
    {"pop": fx.POPULATION, "env": fx.ENVIRONMENT},
    """SELECT 'population_orders' AS dataset, source, value, CAST(NULL AS VARCHAR) AS parameter FROM pop
  UNION ALL SELECT 'population_events', NULL, value, parameter FROM env"""))
def landed_round_trip(spark, sf):
    """Two datasets of one family with different columns, and one of another family."""
    root = shared_dir(spark, "landed")
    pop = fx.load(spark, sf, fx.POPULATION).select("source", "value")
    env = fx.load(spark, sf, fx.ENVIRONMENT).select("parameter", "value")
    tables.write_landed({"population_orders": pop, "population_events": env,
                         "individual_training": pop}, root, "20240101_000000")
    return tables.read_landed(spark, root, "population_").select(
        "dataset", "source", "value", "parameter")


@register("clean_round_trip", q.with_ctes(
    q.validated(fx.INDIVIDUAL), "SELECT patient_id, seq FROM clean"))
def clean_round_trip(spark, sf):
    """Two runs of the same day and an earlier one: the newest snapshot counts, once."""
    path = shared_dir(spark, "validated")
    tagged = validate.tag_individual(fx.load(spark, sf, fx.INDIVIDUAL), ["seq"])
    for day in ("20240101_000000", "20240102_000000", "20240102_000000"):
        tables.write_validated(tagged, path, "individual", day)
    return tables.read_clean(spark, path).select("patient_id", "seq")


@register("snapshot_rerun", q.with_ctes(
    q.scored(fx.BRANCH_PROBS), f"SELECT {', '.join(_KEPT)} FROM scored"))
def snapshot_rerun(spark, sf):
    """A run that is repeated replaces its snapshot."""
    path = shared_dir(spark, "scores")
    for _ in range(2):
        tables.write_scores(sc.scored(spark, sf), path, "20240101_000000")
    return tables.read_scores(spark, path).select(*_KEPT)


@register("quarantine_round_trip", q.with_ctes(
    q.validated(fx.INDIVIDUAL), "SELECT patient_id, seq, _reject, 'individual' AS _source, "
                                "CAST(len(string_split(_reject, '; ')) AS INT) AS n_reasons "
                                "FROM tagged WHERE _reject <> ''"))
def quarantine_round_trip(spark, sf):
    path = shared_dir(spark, "validated")
    tagged = validate.tag_individual(fx.load(spark, sf, fx.INDIVIDUAL), ["seq"])
    tables.write_validated(tagged, path, "individual", "20240101_000000")
    return tables.read_quarantine(spark, path).select(
        "patient_id", "seq", "_reject", "_source", F.size("_reasons").alias("n_reasons"))


# Diagnoses are known for some patients, for a few of them twice.
_TRUTH = """SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('o', o_orderkey) END AS patient_id, CAST(o_custkey % 3 AS INT) AS true_label FROM orders
  UNION ALL SELECT CASE WHEN o_orderkey % 9 = 1 THEN concat('o', o_orderkey) END, CAST((o_custkey + 1) % 3 AS INT) FROM orders"""


@register("truth_join", q.with_ctes({**q.scored(fx.BRANCH_PROBS), "truth": _TRUTH}, """
  SELECT s.patient_id, s.predicted_class, t.true_label FROM scored s LEFT JOIN
  (SELECT patient_id, min(true_label) AS true_label FROM truth WHERE patient_id IS NOT NULL GROUP BY patient_id) t ON s.patient_id = t.patient_id"""))
def truth_join(spark, sf):
    out = monitor.with_truth(sc.scored(spark, sf), fx.load(spark, sf, _TRUTH), ["true_label"])
    return out.select("patient_id", "predicted_class", "true_label")


@register("monitoring_run")
def monitoring_run(spark, sf):
    """Baseline on the feature table, current run on a shifted copy of it."""
    df = enriched(spark, sf)
    base = stored(drift.compute_baseline(drift.long_features(df)), "baseline")
    shifted = df.withColumn("systolic_bp", F.col("systolic_bp") + 15)
    run = monitoring.monitoring_run(shifted, sc.scored(spark, sf), base, reference_f1=0.9,
                                    truth=fx.load(spark, sf, _TRUTH))
    return run.drift


# --- streams -----------------------------------------------------------------------

_STREAM_RANGES = {k: v for k, v in C.CLINICAL_RANGES.items() if k in src.BIO_COLUMNS}
_STREAM_REASONS = ", ".join(
    [f"CASE WHEN {c} IS NULL THEN 'null_{c}' END" for c in C.REQUIRED_COLUMNS]
    + [f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN 'range_{c}' END"
       for c, (lo, hi) in _STREAM_RANGES.items()])


@register("stream_validate", f"""SELECT *, reason <> '' AS rejected FROM (
  SELECT *, concat_ws('; ', {_STREAM_REASONS}) AS reason FROM ({src.BIO_SQL}) b) r""")
def stream_validate(spark, sf):
    """Device payloads through the stream, read back from both partitions."""
    landing = shared_dir(spark, "biometrics")
    src.biometric_payloads(spark, sf).select(F.col("payload").alias("value")).write.text(landing)
    out, checkpoint = shared_dir(spark, "stream_out"), shared_dir(spark, "stream_state")
    tagged = readings.validated_stream(readings.biometric_stream(spark, landing))
    readings.write_partitioned(tagged, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        *src.BIO_COLUMNS, F.col("_reject").alias("reason"),
        (F.col("rejected") == "true").alias("rejected"))


def _reading_stream(spark, sf) -> DataFrame:
    """The events table as a stream of readings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf))
    nation = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_name")
    return (events.join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
            .select("event_id", F.col("n_name").alias("country_iso3"),
                    F.concat(F.lit("s"), (F.col("user_id") % 50).cast("string"))
                    .alias("location_id"),
                    F.element_at(F.array(*[F.lit(p) for p in C.ENVIRONMENT_PARAMETERS]),
                                 (F.col("event_id") % 4 + 1).cast("int")).alias("parameter"),
                    F.when(F.col("event_id") % 31 != 0, F.col("value")).alias("value"),
                    F.col("ts").cast("timestamp").alias("measured_at")))


def _drain(spark, stream: DataFrame) -> DataFrame:
    out, checkpoint = shared_dir(spark, "stream_out"), shared_dir(spark, "stream_state")
    readings.append_to(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@register("stream_env_mean", q.with_ctes({"env": fx.ENVIRONMENT}, """
  SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, country_iso3, parameter, round(avg(value), 8) AS mean_value, count(value) AS n_values
  FROM (SELECT *, date_trunc('day', measured_at) AS day FROM env) e
  WHERE day + INTERVAL 1 DAY <= (SELECT max(measured_at) - INTERVAL 1 HOUR FROM env)
  GROUP BY day, country_iso3, parameter"""))
def stream_env_mean(spark, sf):
    """Closed windows only: append mode holds back what the watermark has not passed."""
    out = _drain(spark, readings.windowed_means(_reading_stream(spark, sf)))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "country_iso3", "parameter", F.round("mean_value", 8).alias("mean_value"),
                      "n_values")


@register("stream_env_mean_all", q.with_ctes({"env": fx.ENVIRONMENT}, """
  SELECT strftime(date_trunc('day', measured_at), '%Y-%m-%d %H:%M:%S') AS window_start, country_iso3, parameter, round(avg(value), 8) AS mean_value, count(value) AS n_values
  FROM env GROUP BY ALL"""))
def stream_env_mean_all(spark, sf):
    """All windows over all readings, also windows still open and readings that come late."""
    landed = _drain(spark, readings.landed_readings(_reading_stream(spark, sf)))
    return readings.current_means(landed).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "country_iso3", "parameter", F.round("mean_value", 8).alias("mean_value"), "n_values")


@register("stream_env_mean_merged", ORACLES["stream_env_mean_all"])
def stream_env_mean_merged(spark, sf):
    """As stream_env_mean_all, by partial sums that each micro-batch merges into its windows."""
    root, checkpoint = shared_dir(spark, "windows"), shared_dir(spark, "windows_state")
    readings.merge_windows(_reading_stream(spark, sf), root, checkpoint).awaitTermination()
    return readings.merged_means(spark, root).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "country_iso3", "parameter", F.round("mean_value", 8).alias("mean_value"), "n_values")


@register("stream_dedup", """SELECT DISTINCT concat('s', user_id % 50) AS location_id,
  CASE event_id % 4 WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' WHEN 2 THEN 'no2' ELSE 'o3' END AS parameter,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS measured_at, microsecond(ts) AS us FROM events JOIN nation ON user_id % 25 = n_nationkey""")
def stream_dedup(spark, sf):
    """Readings sent twice come out once."""
    stream = _reading_stream(spark, sf)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy", "event_id")
    out = _drain(spark, readings.deduplicated(twice))
    return out.select(
        "location_id", "parameter",
        F.date_format("measured_at", "yyyy-MM-dd HH:mm:ss").alias("measured_at"),
        (F.unix_micros("measured_at") % 60_000_000).alias("us"))


@register("stream_score")
def stream_score(spark, sf):
    """Individuals as a stream, scored with static models and lookups."""
    model, ind = fitted(spark, sf)
    table = stored(model.transform(ind, with_target=True), "features")
    models = [_train(table, b, cv=False).model for b in ("A", "B")]
    landing = shared_dir(spark, "individuals")
    ind.write.parquet(landing)
    stream = spark.readStream.schema(ind.schema).parquet(landing)
    out = readings.scored_stream(stream, model, *models, F.lit(SCORED_AT).cast("timestamp"))
    return _drain(spark, out)
