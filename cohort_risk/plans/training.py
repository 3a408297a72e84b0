"""Branch classifiers: a forest and a kernel machine per branch, evaluated on a hold-out."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.functions import scalars as S
from cohort_risk.operators import folds, metrics
from cohort_risk.operators.scoring import CLASSES
from cohort_risk.plans import forests, kernels, packed
from cohort_risk.session import stored
from cohort_risk.sinks import runs

WEIGHT = "class_weight"
FOREST, KERNEL = "forest", "kernel"
#: Fits that run at once; each is a sequence of small jobs that alone leaves cores idle.
PARALLEL_FITS = 6
#: Rounds of tree growth between checkpoints of the cached node ids.
NODE_CHECKPOINT = 10
#: Fewest rows worth a task of their own.
ROWS_PER_TASK = 4096


def _features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature columns as doubles without NULLs; a missing column or value counts as 0."""
    return df.withColumns({
        f"__x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns
        else F.lit(0.0) for c in names})


def _scaler(names: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=[f"__x_{c}" for c in names], outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True)])


def standardised(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The scaled inputs of the models as columns ``z_<name>``."""
    out = _scaler(names).fit(_features(df, names)).transform(_features(df, names))
    z = vector_to_array("__scaled")
    return out.withColumns({f"z_{c}": z[i] for i, c in enumerate(names)}).drop(
        "__raw", "__scaled", *[f"__x_{c}" for c in names])


def weight_column(df: DataFrame, label: str = C.TARGET) -> Column:
    """Balanced class weights as literals; there is one per class."""
    rows = folds.class_weights(df, label).collect()
    return S.lookup(label, {int(r[label]): float(r["weight"]) for r in rows}, 1.0)


def frequencies(n_inputs: int, params: C.KernelParams) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of the random Fourier features of an RBF kernel.

    Kernel width 1 / n_inputs, since scaled inputs have variance 1
    (Rahimi and Recht, 2007).
    """
    rng = np.random.default_rng(params.seed)
    freq = rng.normal(0.0, math.sqrt(2.0 / n_inputs), (n_inputs, params.n_components))
    return freq, rng.uniform(0.0, 2.0 * math.pi, params.n_components)


def random_features(n_inputs: int, params: C.KernelParams):
    """Arrow UDF mapping scaled inputs to random Fourier features of an RBF kernel."""
    freq, phase = frequencies(n_inputs, params)
    scale = math.sqrt(2.0 / params.n_components)

    @F.arrow_udf("array<double>")
    def mapped(x: pa.Array) -> pa.Array:
        inputs = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), n_inputs)
        out = scale * np.cos(inputs @ freq + phase)
        ends = np.arange(len(x) + 1, dtype=np.int32) * params.n_components
        return pa.ListArray.from_arrays(ends, out.ravel())

    return mapped


@dataclass
class ForestModel:
    features: list[str]
    pipeline: PipelineModel

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(_features(df, self.features))
        return out.drop("__raw", "__scaled", "rawPrediction", *[f"__x_{c}" for c in self.features])

    def importances(self) -> list[tuple[str, float]]:
        values = self.pipeline.stages[-1].featureImportances.toArray()
        return list(zip(self.features, [round(float(v), 4) for v in values]))

    def save(self, path: str) -> None:
        self.pipeline.save(f"{path}/pipeline")


@dataclass
class KernelModel:
    features: list[str]
    scaler: PipelineModel
    classifier: LogisticRegressionModel
    params: C.KernelParams

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.classifier.transform(_mapped(self.scaler, df, self.features, self.params))
        return out.drop("__raw", "__scaled", "__mapped", "rawPrediction",
                        *[f"__x_{c}" for c in self.features])

    def save(self, path: str) -> None:
        self.scaler.save(f"{path}/scaler")
        self.classifier.save(f"{path}/classifier")


def _mapped(scaler: PipelineModel, df: DataFrame, features: Sequence[str],
            params: C.KernelParams) -> DataFrame:
    udf = random_features(len(features), params)
    return scaler.transform(_features(df, features)).withColumn(
        "__mapped", array_to_vector(udf(vector_to_array("__scaled"))))


def fit_forest(train: DataFrame, features: Sequence[str], params: C.ForestParams,
               label: str = C.TARGET) -> ForestModel:
    forest = RandomForestClassifier(
        featuresCol="__scaled", labelCol=label, weightCol=WEIGHT, numTrees=params.num_trees,
        maxDepth=params.max_depth, minInstancesPerNode=params.min_instances,
        featureSubsetStrategy=params.subset, seed=params.seed)
    stages = [*_scaler(features).getStages(), forest]
    return ForestModel(list(features), Pipeline(stages=stages).fit(_features(train, features)))


def fit_kernel(train: DataFrame, features: Sequence[str], params: C.KernelParams,
               label: str = C.TARGET) -> KernelModel:
    scaler = _scaler(features).fit(_features(train, features))
    classifier = LogisticRegression(
        featuresCol="__mapped", labelCol=label, weightCol=WEIGHT, family="multinomial",
        regParam=params.reg, maxIter=params.max_iter, standardization=False)
    model = classifier.fit(_mapped(scaler, train, features, params))
    return KernelModel(list(features), scaler, model, params)


@dataclass
class Prepared:
    """Rows of a branch with scaled (and mapped) inputs, stored once for every fit.

    The scaler is fitted on the training rows (not the hold-out) and serves all folds: a
    forest's splits don't change under a per-feature affine map, and the kernel's inputs
    differ from a per-fold scaler by the fold's share of the mean and deviation only.
    Where the rows are ``many``, the mapped inputs are computed wherever they are read.
    """

    rows: DataFrame
    scaler: PipelineModel
    features: list[str]
    kernel: C.KernelParams | None
    n_rows: int = 0

    @property
    def many(self) -> bool:
        """Whether there is enough for more than one task, see ``spread``."""
        return self.n_rows >= 2 * ROWS_PER_TASK

    def mapped(self, rows: DataFrame) -> DataFrame:
        if self.kernel is None or "__mapped" in rows.columns:
            return rows
        udf = random_features(len(self.features), self.kernel)
        return rows.withColumn("__mapped", array_to_vector(udf(vector_to_array("__scaled"))))


def spread(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` dealt evenly over one task per core; fewer rows keep their tasks.

    A narrow table fills few file splits, but its rows still cost much computing.
    """
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // rows_per_task)
    return rows.repartition(tasks) if tasks > 1 else rows


def prepare(rows: DataFrame, features: Sequence[str], kernel: C.KernelParams | None = None) -> Prepared:
    scaler = _scaler(features).fit(_features(rows.filter(~F.col("is_test")), features))
    out = scaler.transform(_features(spread(rows), features))
    prep = Prepared(out, scaler, list(features), kernel, rows.count())
    if not prep.many:
        out = prep.mapped(out)
    keep = [c for c in out.columns if c not in features and c != "__raw" and not c.startswith("__x_")]
    return replace(prep, rows=stored(out.select(*keep), "prepared"))


def _estimator(name: str, forest: C.ForestParams, kernel: C.KernelParams | None, label: str):
    if name == FOREST:
        return RandomForestClassifier(
            featuresCol="__scaled", labelCol=label, weightCol=WEIGHT, numTrees=forest.num_trees,
            maxDepth=forest.max_depth, minInstancesPerNode=forest.min_instances,
            featureSubsetStrategy=forest.subset, seed=forest.seed,
            cacheNodeIds=True, checkpointInterval=NODE_CHECKPOINT)
    return LogisticRegression(
        featuresCol="__mapped", labelCol=label, weightCol=WEIGHT, family="multinomial",
        regParam=kernel.reg, maxIter=kernel.max_iter, standardization=False)


def _wrapped(prep: Prepared, name: str, fitted) -> ForestModel | KernelModel:
    if name == FOREST:
        return ForestModel(prep.features, PipelineModel(stages=[*prep.scaler.stages, fitted]))
    return KernelModel(prep.features, prep.scaler, fitted, prep.kernel)


def concurrently(calls: Sequence[Callable[[], object]], parallel: int = PARALLEL_FITS) -> list:
    """Results of ``calls``, run as concurrent Spark jobs from threads that keep the job settings."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(calls)))) as pool:
        return list(pool.map(lambda call: inheritable_thread_target(call)(), calls))


def with_probabilities(predicted: DataFrame, branch: str) -> DataFrame:
    """Class probabilities as columns; classes a model never saw get 0."""
    p = vector_to_array("probability")
    return predicted.withColumns({
        f"{branch}_{c}": F.coalesce(F.get(p, F.lit(i)), F.lit(0.0))
        for i, c in enumerate(CLASSES)}).drop("probability", "prediction")


@dataclass
class BranchModel:
    """Both models of a branch and which of them scores."""

    branch: str
    forest: ForestModel
    kernel: KernelModel | None
    primary: str = FOREST

    def probabilities(self, df: DataFrame) -> DataFrame:
        model = self.kernel if self.primary == KERNEL and self.kernel else self.forest
        return with_probabilities(model.predict(df), self.branch.lower())

    def save(self, path: str, spark: SparkSession) -> None:
        self.forest.save(f"{path}/forest")
        meta = {"branch": self.branch, "primary": self.primary, "features": self.forest.features}
        if self.kernel:
            self.kernel.save(f"{path}/kernel")
            meta["kernel"] = asdict(self.kernel.params)
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(
            f"{path}/meta")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> BranchModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        features = meta["features"]
        forest = ForestModel(features, PipelineModel.load(f"{path}/forest/pipeline"))
        kernel = None
        if "kernel" in meta:
            kernel = KernelModel(features, PipelineModel.load(f"{path}/kernel/scaler"),
                                 LogisticRegressionModel.load(f"{path}/kernel/classifier"),
                                 C.KernelParams(**meta["kernel"]))
        return cls(meta["branch"], forest, kernel, meta["primary"])


def training_rows(df: DataFrame, features: Sequence[str], ids: Sequence[str],
                  label: str = C.TARGET, folds_k: int = C.CV_FOLDS) -> DataFrame:
    """Complete rows with fold, hold-out flag and class weight, stored for the passes."""
    present = [c for c in features if c in df.columns]
    rows = df.select(*ids, label, *[c for c in present if c not in ids]).dropna(
        subset=[label, *present])
    rows = stored(folds.training_split(rows, label, ids, folds_k), "training_rows")
    return rows.withColumn(WEIGHT, weight_column(rows, label))


def evaluate(model: ForestModel | KernelModel, rows: DataFrame, branch: str, name: str,
             label: str = C.TARGET) -> DataFrame:
    """Hold-out metrics ``(branch, model, metric, value)``; scoring runs once."""
    return evaluate_predicted(model.predict(rows), branch, name, label)


def evaluate_predicted(predicted: DataFrame, branch: str, name: str, label: str = C.TARGET) -> DataFrame:
    """Hold-out metrics of rows that carry ``probability`` and ``prediction``."""
    predicted = with_probabilities(predicted.withColumn("pred", F.col("prediction").cast("int")), "p")
    kept = stored(predicted.select(label, "pred", *[f"p_{c}" for c in CLASSES]), "predictions")
    overall = metrics.macro_f1(kept, label, "pred")
    long = overall.select(F.col("accuracy"), F.col("f1_macro"),
                          F.col("n_rows").cast("double").alias("n_test")).unpivot(
        [], ["accuracy", "f1_macro", "n_test"], "metric", "value")
    auc = metrics.roc_auc_macro(kept, label, [f"p_{c}" for c in CLASSES]).select(
        F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    per_class = metrics.class_report(metrics.confusion_matrix(kept, label, "pred"))
    cells = per_class.unpivot("label", ["precision", "recall", "f1"], "m", "value").select(
        F.concat("m", F.lit("_"), F.col("label").cast("string")).alias("metric"), "value")
    out = long.unionByName(auc).unionByName(cells)
    return out.select(F.lit(branch).alias("branch"), F.lit(name).alias("model"), "metric", "value")


def cross_validate(rows: DataFrame, fit, k: int = C.CV_FOLDS, label: str = C.TARGET) -> list[float]:
    """Macro F1 per fold. ``fit`` trains on a frame and returns a model."""
    scores = []
    for i in range(k):
        model = fit(rows.filter(F.col("fold") != i))
        predicted = model.predict(rows.filter(F.col("fold") == i)).withColumn(
            "pred", F.col("prediction").cast("int"))
        scores.append(metrics.macro_f1(predicted, label, "pred").first()["f1_macro"])
    return scores


def fold_calls(prep: Prepared, names: Sequence[str], forest: C.ForestParams,
               kernel: C.KernelParams | None, k: int = C.CV_FOLDS, label: str = C.TARGET):
    """``(name, fold)`` and a call giving its macro F1, for every model and fold."""
    def fold_f1(name: str, i: int) -> Callable[[], float]:
        def run() -> float:
            model = _estimator(name, forest, kernel, label).fit(prep.rows.filter(F.col("fold") != i))
            predicted = model.transform(prep.rows.filter(F.col("fold") == i)).withColumn(
                "pred", F.col("prediction").cast("int"))
            return metrics.macro_f1(predicted, label, "pred").first()["f1_macro"]
        return run
    jobs = [(name, i) for name in names for i in range(k)]
    return jobs, [fold_f1(name, i) for name, i in jobs]


def cross_validate_prepared(prep: Prepared, names: Sequence[str], forest: C.ForestParams,
                            kernel: C.KernelParams | None, k: int = C.CV_FOLDS,
                            label: str = C.TARGET) -> dict[str, list[float]]:
    """Macro F1 per model and fold, all fits over the one prepared frame."""
    return fit_all(prep, names, forest, kernel, k, label, final=False)[1]


def fit_all(prep: Prepared, names: Sequence[str], forest: C.ForestParams, kernel: C.KernelParams | None,
            k: int = C.CV_FOLDS, label: str = C.TARGET, final: bool = True, cv: bool = True):
    """Final models by name, and the macro F1 of every fold by name.

    Few rows are fitted by Spark ML in concurrent jobs. Its fits walk all rows again for every
    level of a forest and every step of a kernel machine, so many rows are packed once, and all
    forests, then all kernel machines of the branch, are fitted over the packed blocks.
    """
    local = [n for n in names if prep.many and (
        n == KERNEL or prep.n_rows * len(prep.features) <= forests.MAX_CELLS)]
    rest = [n for n in names if n not in local]
    train = prep.mapped(prep.rows.filter(~F.col("is_test"))) if final else None
    ends = [lambda n=n: _estimator(n, forest, kernel, label).fit(train) for n in rest] if final else []
    # the final models and all folds of both models at once
    jobs, calls = fold_calls(prep, rest, forest, kernel, k, label) if cv else ([], [])
    done = concurrently([*ends, *calls])
    models, scores = dict(zip(rest, done[:len(ends)])), _by_model(jobs, done[len(ends):])
    if local:
        own, found = _fit_packed(prep, local, forest, kernel, k, label, final, cv)
        models, scores = {**models, **own}, {**scores, **found}
    return models, {n: scores[n] for n in names if n in scores}


def _fit_packed(prep: Prepared, names: Sequence[str], forest: C.ForestParams, kernel: C.KernelParams | None,
                k: int, label: str, final: bool, cv: bool):
    """As ``fit_all``, over packed blocks."""
    spark, n = prep.rows.sparkSession, len(prep.features)
    seen = {int(r[0]): float(r[1]) for r in prep.rows.groupBy(label).agg(F.max(WEIGHT)).collect()}
    weights = [seen.get(c, 0.0) for c in range(max(seen) + 1)]
    cuts = packed.cut_points(prep.rows.filter(~F.col("is_test")), n, F.col(WEIGHT))
    blocks = packed.pack(prep.rows, label, cuts, len(weights))
    fits = [packed.FINAL] * final + list(range(k)) * cv
    models, predicted = {}, []
    if FOREST in names:
        grown = forests.grow(blocks, fits, n, weights, forest)
        if final:
            models[FOREST] = forests.model(grown, _estimator(FOREST, forest, kernel, label), cuts, len(weights))
        if cv:
            predicted.append((FOREST, forests.fold_predictions(grown, len(weights))))
    if KERNEL in names:
        freq, phase = frequencies(n, kernel)
        found = kernels.fit(blocks, fits, freq, phase, weights, kernel)
        if final:
            models[KERNEL] = kernels.model(found[packed.FINAL], _estimator(KERNEL, forest, kernel, label), spark)
        if cv:
            predicted.append((KERNEL, kernels.fold_predictions(blocks, found, freq, phase)))
    scores = {}
    for name, rows in predicted:
        by_fold = {r["fold"]: r["f1_macro"] for r in metrics.macro_f1(rows, "label", "pred", ["fold"]).collect()}
        scores[name] = [by_fold[i] for i in range(k)]
    return models, scores


def _by_model(jobs, scores) -> dict[str, list[float]]:
    out: dict[str, list[float]] = {}
    for (name, _), f1 in zip(jobs, scores):
        out.setdefault(name, []).append(f1)
    return out


def cv_summary(scores: Sequence[float]) -> dict[str, float]:
    """Mean and population standard deviation over the folds."""
    return {"cv_mean": round(float(np.mean(scores)), 4), "cv_std": round(float(np.std(scores)), 4)}


@dataclass
class BranchResult:
    model: BranchModel
    metrics: DataFrame
    importances: DataFrame
    cv: dict[str, list[float]]
    class_counts: dict[int, int] | None = None


def train_branch(df: DataFrame, branch: str, features: Sequence[str], ids: Sequence[str],
                 forest: C.ForestParams = C.ForestParams(),
                 kernel: C.KernelParams | None = C.KernelParams(),
                 cv: bool = True, label: str = C.TARGET) -> BranchResult:
    """Train on 80 % of each class, evaluate on the rest, pick the primary model."""
    spark = df.sparkSession
    present = [c for c in features if c in df.columns]
    prep = prepare(training_rows(df, present, ids, label), present, kernel)
    names = [FOREST, KERNEL] if kernel else [FOREST]
    test = prep.mapped(prep.rows.filter("is_test"))
    fitted, folds_f1 = fit_all(prep, names, forest, kernel, label=label, cv=cv)
    models = {name: _wrapped(prep, name, fitted[name]) for name in names}
    report = None
    for name in names:
        own = models[name].pipeline.stages[-1] if name == FOREST else models[name].classifier
        part = evaluate_predicted(own.transform(test), branch, name, label)
        report = part if report is None else report.unionByName(part)
    if folds_f1:
        lines = [(branch, name, metric, value) for name, scores in folds_f1.items()
                 for metric, value in cv_summary(scores).items()]
        report = report.unionByName(spark.createDataFrame(
            lines, "branch string, model string, metric string, value double"))
    report = stored(report, "evaluation")
    f1 = report.filter("metric = 'f1_macro'").select("branch", "model", F.col("value").alias("f1_macro"))
    primary = metrics.primary_model(f1, FOREST).first()["primary_model"]
    importances = spark.createDataFrame(
        [(branch, c, v) for c, v in models[FOREST].importances()],
        "branch string, feature string, importance double")
    model = BranchModel(branch, models[FOREST], models.get(KERNEL), primary)
    counts = {int(r[label]): int(r["n_rows"]) for r in folds.class_distribution(prep.rows, label).collect()}
    return BranchResult(model, report, importances, folds_f1, counts)


def _cv_entry(scores: Sequence[float]) -> dict:
    return {**{k.removeprefix("cv_"): v for k, v in cv_summary(scores).items()},
            "fold_scores": [round(float(f), 4) for f in scores]}


def train_run(df: DataFrame, root: str, ids: Sequence[str],
              branches: Sequence[tuple[str, Sequence[str]]] = (("A", C.BRANCH_A_FEATURES), ("B", C.BRANCH_B_FEATURES)),
              forest: C.ForestParams = C.ForestParams(), kernel: C.KernelParams | None = C.KernelParams(),
              label: str = C.TARGET) -> dict:
    """Trains every branch, stores models, evaluation, importances and class counts as one run.

    The run becomes visible when its manifest is committed, after all its tables: readers
    of ``root`` (scoring, monitoring, the retraining rule) never see half a run.
    """
    spark = df.sparkSession
    run_id = runs.new_run()
    manifest = {"kind": "training", "class_names": C.CLASS_NAMES, "tables": [], "branches": {}}
    counts = []
    for branch, features in branches:
        result = train_branch(df, branch, features, ids, forest, kernel, cv=True, label=label)
        result.model.save(runs.table_path(root, run_id, f"model_{branch}"), spark)
        for name, table in (("evaluation", result.metrics), ("importances", result.importances)):
            runs.write_table(table, root, run_id, f"{name}_{branch}")
            manifest["tables"].append(f"{name}_{branch}")
        counts += [(branch, c, n) for c, n in sorted(result.class_counts.items())]
        manifest["branches"][branch] = {
            "features": result.model.forest.features, "n_features": len(result.model.forest.features),
            "primary": result.model.primary, "model": f"model_{branch}",
            "class_dist": {str(c): n for c, n in sorted(result.class_counts.items())},
            "cv": {name: _cv_entry(scores) for name, scores in result.cv.items()}}
    runs.write_table(spark.createDataFrame(counts, "branch string, class int, n_rows long"),
                     root, run_id, "class_dist")
    manifest["tables"].append("class_dist")
    return runs.commit(spark, root, run_id, manifest)


def reference_f1(manifest: dict) -> float:
    """The retraining rule's reference: the largest forest CV mean over the branches."""
    return max((b["cv"].get(FOREST, {}).get("mean", 0.0) for b in manifest["branches"].values()), default=0.0)


def load_run(spark: SparkSession, root: str) -> dict[str, BranchModel] | None:
    """Branch models of the newest committed run, or None."""
    manifest = runs.latest(spark, root)
    if manifest is None:
        return None
    return {b: BranchModel.load(runs.table_path(root, manifest["run_id"], m["model"]), spark)
            for b, m in manifest["branches"].items()}
