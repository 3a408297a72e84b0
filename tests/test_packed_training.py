"""Many rows are fitted over packed blocks, with the results of Spark ML's fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.plans import forests, kernels, packed, training

FEATURES = ["a", "b", "c"]


def gini(stats):
    return 1 - (stats ** 2).sum() / stats.sum() ** 2


def brute_force(x, y, counts, weights, params, rows, depth, chosen=None):
    """The tree below ``rows``: (feature, bin, left, right), or a leaf's weighted class counts.

    Splits of equal gain are told apart by ``chosen``, the tree to compare with.
    """
    def stats(rows):
        return np.array([counts[rows][y[rows] == c].sum() for c in range(len(weights))]) * weights

    own, gains = stats(rows), {}
    if depth < params.max_depth and gini(own) > 1e-15:
        for f in range(x.shape[1]):
            for b in range(packed.BINS - 1):
                left, right = rows[x[rows, f] <= b], rows[x[rows, f] > b]
                if min(counts[left].sum(), counts[right].sum()) >= params.min_instances:
                    l, r = stats(left), stats(right)
                    gains[f, b] = gini(own) - l.sum() / own.sum() * gini(l) - r.sum() / own.sum() * gini(r)
    best = max(gains.values(), default=0.0)
    if best < 1e-12:
        return tuple(own)
    if chosen is not None and len(chosen) == 4:
        at, below = (int(chosen[0]), int(chosen[1])), chosen[2:]
        assert gains[at] > best - 1e-12
    else:
        at, below = max(gains, key=gains.get), (None, None)
    left, right = (brute_force(x, y, counts, weights, params, side, depth + 1, c) for side, c in zip(
        (rows[x[rows, at[0]] <= at[1]], rows[x[rows, at[0]] > at[1]]), below))
    if len(left) == len(right) == len(weights) and np.argmax(left) == np.argmax(right):
        return tuple(own)
    return *at, left, right


@pytest.mark.parametrize("seed", range(4))
def test_tree_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, packed.BINS, (150, 3))
    y = (x[:, 0] + rng.integers(0, 12, 150) > 20).astype(int) + (x[:, 1] > 25)
    counts, weights = rng.poisson(1.0, 150), np.array([0.5, 1.0, 3.0])
    params = C.ForestParams(max_depth=4, min_instances=3, subset="all")
    drawn, every = np.flatnonzero(counts), np.arange(150)
    codes = (x + y[:, None] * packed.BINS).astype(packed.codes_type(3)).ravel()
    nodes, leaf = forests.grow_tree(codes, 3, drawn, counts[drawn].astype(float), weights, params, rng, every)

    def nested(i):
        node = nodes[i]
        if node["left"] < 0:
            return tuple(node["stats"])
        return node["feature"], node["bin"], nested(node["left"]), nested(node["right"])

    def same(a, b):
        assert len(a) == len(b)
        if len(a) == 3:
            assert np.allclose(a, b)
        else:
            assert a[:2] == b[:2]
            same(a[2], b[2])
            same(a[3], b[3])

    tree = nested(0)
    assert len(nodes) > 6
    same(tree, brute_force(x, y, counts, weights, params, drawn, 0, tree))
    for row in every:
        i = 0
        while nodes[i]["left"] >= 0:
            i = nodes[i]["left" if x[row, nodes[i]["feature"]] <= nodes[i]["bin"] else "right"]
        assert leaf[row] == i


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 900
    a, b, c = rng.normal(size=n), rng.integers(0, 6, n), rng.exponential(size=n)
    y = (a + 0.3 * rng.normal(size=n) > 0).astype(int) + (b > 4)
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), int(y[i])) for i in range(n)]
    # rows that come twice, a null input and a null label
    rows += rows[:20] + [(n, None, 1.0, 1.0, 0), (n + 1, 0.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, f"id int, a double, b double, c double, {C.TARGET} int")


@pytest.fixture
def many(monkeypatch):
    """Tables of a few hundred rows count as many, and Spark ML fits nothing."""
    def fails(self, *args):
        raise AssertionError("Spark ML was asked to fit")

    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(RandomForestClassifier, "_fit", fails)
    monkeypatch.setattr(LogisticRegression, "_fit", fails)


FOREST, KERNEL = C.ForestParams(num_trees=12, max_depth=5), C.KernelParams(n_components=24)


def test_branch_of_many_rows_is_trained_whole(spark, table, many):
    result = training.train_branch(table, "A", FEATURES, ["id"], FOREST, KERNEL)
    forest = result.model.forest.pipeline.stages[-1]
    assert forest.getNumTrees == 12 and forest.numClasses == 3 and forest.numFeatures == 3
    assert max(t.depth for t in forest.trees) <= 5
    assert abs(sum(v for _, v in result.model.forest.importances()) - 1) < 1e-3
    assert {n: len(f) for n, f in result.cv.items()} == {training.FOREST: 5, training.KERNEL: 5}
    assert all(f > 0.75 for f in result.cv[training.FOREST])
    got = {(r["model"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert got[training.FOREST, "n_test"] == got[training.KERNEL, "n_test"] > 180
    assert sum(result.class_counts.values()) == 920


def test_models_of_many_rows_save_and_load(spark, table, many, tmp_path):
    model = training.train_branch(table, "A", FEATURES, ["id"], FOREST, KERNEL, cv=False).model
    model.save(str(tmp_path / "m"), spark)
    again = training.BranchModel.load(str(tmp_path / "m"), spark)
    for primary in (training.FOREST, training.KERNEL):
        model.primary = again.primary = primary
        a, b = (sorted(map(tuple, m.probabilities(table.select("id", *FEATURES)).collect()), key=str)
                for m in (model, again))
        assert a == b and len(a) == 922


def _packed(table, k=5):
    prep = training.prepare(training.training_rows(table, FEATURES, ["id"]), FEATURES, KERNEL)
    weights = [float(r[1]) for r in prep.rows.groupBy(C.TARGET).agg(F.max(training.WEIGHT)).orderBy(C.TARGET).collect()]
    cuts = packed.cut_points(prep.rows.filter(~F.col("is_test")), 3)
    return prep, weights, cuts, packed.pack(prep.rows, C.TARGET, cuts, len(weights))


def test_forest_votes_are_those_of_the_model_and_of_any_number_of_tasks(spark, table, many, monkeypatch):
    prep, weights, cuts, blocks = _packed(table)
    estimator = training._estimator(training.FOREST, FOREST, None, C.TARGET)
    found = []
    for rounds in (1, 3):
        monkeypatch.setattr(forests, "ROUNDS", rounds)
        grown = forests.grow(blocks, [packed.FINAL, 0, 1, 2, 3, 4], 3, weights, FOREST)
        model = forests.model(grown, estimator, cuts, 3)
        votes = sorted(map(tuple, forests.fold_predictions(grown, 3).collect()))
        assert len(votes) == prep.n_rows == 920
        found.append((votes, [t.toDebugString.split("\n", 1)[1] for t in model.trees]))
    assert found[0] == found[1]
    assert sorted((f, y) for f, y, _ in found[0][0]) == sorted(
        map(tuple, prep.rows.select("fold", F.col(C.TARGET)).collect()))
    # the nodes walked by hand give the model's predictions
    kind = forests._node_type(3)
    trees = [np.frombuffer(r["data"], kind) for r in grown.filter(F.col("fit") == packed.FINAL).orderBy("tree").collect()]
    for row in model.transform(prep.rows).limit(50).collect():
        total = np.zeros(3)
        for t in trees:
            i = 0
            while t[i]["left"] >= 0:
                right = row["__scaled"][t[i]["feature"]] > cuts[t[i]["feature"]][t[i]["bin"]]
                i = t[i]["right" if right else "left"]
            total += t[i]["stats"] / t[i]["stats"].sum()
        assert np.allclose(row["probability"].toArray(), total / total.sum())


def test_kernel_fits_are_those_of_spark_ml(spark, table):
    prep, weights, _, blocks = _packed(table)
    assert "__mapped" in prep.rows.columns
    freq, phase = training.frequencies(3, KERNEL)
    got = kernels.fit(blocks, [packed.FINAL, 2], freq, phase, weights, KERNEL)
    estimator = training._estimator(training.KERNEL, FOREST, KERNEL, C.TARGET).setTol(1e-10).setMaxIter(500)
    for fit, rows in ((packed.FINAL, prep.rows.filter(~F.col("is_test"))), (2, prep.rows.filter("fold != 2"))):
        want = estimator.fit(rows)
        assert np.allclose(got[fit][:-1].T, want.coefficientMatrix.toArray(), atol=2e-3)
        assert np.allclose(got[fit][-1], want.interceptVector.toArray(), atol=2e-3)
    own = kernels.model(got[2], estimator, spark)
    held = prep.rows.filter("fold = 2")
    same = want.transform(held).select("id", "prediction").exceptAll(own.transform(held).select("id", "prediction"))
    assert same.count() <= 1
    pred = kernels.fold_predictions(blocks, {**got, 0: got[2], 1: got[2], 3: got[2], 4: got[2]}, freq, phase)
    assert sorted(map(tuple, pred.filter("fold = 2").select("label", "pred").collect())) == sorted(
        (r[0], int(r[1])) for r in own.transform(held).select(C.TARGET, "prediction").collect())


def test_more_cells_than_a_task_takes_leave_the_forest_to_spark_ml(spark, table, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(forests, "MAX_CELLS", 900 * 3)
    monkeypatch.setattr(forests, "grow", None)
    small = C.ForestParams(num_trees=2, max_depth=2)
    result = training.train_branch(table, "A", FEATURES, ["id"], small, KERNEL)
    assert {n: len(f) for n, f in result.cv.items()} == {training.FOREST: 5, training.KERNEL: 5}


def test_cut_points_lie_between_values_with_even_weights(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    rows = spark.range(1, 3201).select(array_to_vector(F.array(
        (F.col("id") % 3).cast("double"), F.col("id").cast("double"), F.lit(7.0),
        (F.col("id") % 40).cast("double"))).alias("__scaled"), F.col("id") % 40)
    few, wide, one, forty = packed.cut_points(rows, 4)
    assert few.tolist() == [0.5, 1.5] and len(one) == 0
    assert len(wide) == 31 and np.abs(wide - 100 * np.arange(1, 32)).max() <= 2
    assert len(forty) == 31 and set(forty) <= {i + 0.5 for i in range(39)}
    # half of the weight lies on one value
    heavy = F.when(F.col("(id % 40)") == 5, 39.0).otherwise(1.0)
    skewed = packed.cut_points(rows, 4, heavy)[3]
    assert 16 < len(skewed) <= 31 and 4.5 in skewed and 5.5 in skewed
    monkeypatch.setattr(packed, "MOST_VALUES", 50)
    wide = packed.cut_points(rows, 4)[1]
    assert len(wide) == 31 and np.abs(wide - 100 * np.arange(1, 32)).max() <= 2
