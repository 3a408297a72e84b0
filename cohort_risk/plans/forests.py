"""Random forests whose trees are grown whole, each in one task over the binned rows.

The trees are those of Spark ML's forest: Poisson bootstrap, 32 bins, weighted Gini gain, a
random subset of the features per node, a fewest number of rows per child, sibling leaves of
one prediction merged. Spark ML walks all rows once per level and shuffles the statistics of
all nodes; here a task takes all rows as one byte per feature and grows its share of trees
without any exchange. ``MAX_CELLS`` bounds what a task takes.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk import config as C
from cohort_risk.plans.packed import BINS, FINAL, codes_type, held_out, trained_on
from cohort_risk.session import shared_dir, stored

#: Most binned values (rows x features) that a task takes.
MAX_CELLS = 1 << 27
#: Tasks per core: a second round evens out cores of different speed.
ROUNDS = 2
#: Judged rows per row of the result.
CHUNK = 1 << 16
#: Rows that lookups take at once, so that their temporary arrays stay in the cache.
STRIDE = 1 << 14
#: As in Spark ML, purer nodes than this are leaves.
PURE = 2.0 ** -52

_GROWN = "fit int, tree int, chunk int, data binary, y binary"
_NODES = ("treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, "
          "gain double, leftChild int, rightChild int, feature int, threshold array<double>")


def _node_type(n_classes: int) -> np.dtype:
    return np.dtype([("stats", "f8", (n_classes,)), ("raw", "i8"), ("impurity", "f8"), ("gain", "f8"),
                     ("left", "i4"), ("right", "i4"), ("feature", "i4"), ("bin", "i4")])


def subset_size(subset: str, n_features: int) -> int:
    """Features tried per node, by Spark ML's names of the strategies."""
    known = {"all": n_features, "sqrt": math.ceil(math.sqrt(n_features)), "auto": math.ceil(math.sqrt(n_features)),
             "log2": max(1, math.ceil(math.log2(n_features))), "onethird": math.ceil(n_features / 3)}
    return min(n_features, known[subset])


def _best_splits(pos, col, counts, codes, subset, weights, min_instances):
    """Per node the best split: score, feature, bin, and the class counts of the node and its left child."""
    n, k = subset.shape
    width = len(weights) * BINS
    keys = np.empty((k, len(pos)), np.int64)
    for i in range(0, len(pos), STRIDE):
        node = pos[i:i + STRIDE]
        at = subset.take(node, axis=0, mode="clip")
        at += col[i:i + STRIDE, None]
        np.add(codes.take(at, mode="clip").T, node * width, out=keys[:, i:i + STRIDE])
    best = np.full(n, -np.inf)
    feature, cut = np.zeros(n, np.int64), np.zeros(n, np.int64)
    below, total = np.zeros((n, len(weights))), None
    every = np.arange(n)
    for s in range(k):
        left = np.bincount(keys[s], counts, n * width).reshape(n, len(weights), BINS).cumsum(axis=2)
        if total is None:
            total = left[:, :, -1].copy()
            whole = total * weights
        left = left[:, :, :-1]
        w, own, other, raw = (np.zeros((n, BINS - 1)) for _ in range(4))
        for c, weight in enumerate(weights):
            part = left[:, c] * weight
            raw += left[:, c]
            w += part
            own += part * part
            part -= whole[:, c, None]
            other += part * part
        with np.errstate(divide="ignore", invalid="ignore"):
            score = own / w + other / (whole.sum(axis=1)[:, None] - w)
        score[(raw < min_instances) | (total.sum(axis=1)[:, None] - raw < min_instances)] = -np.inf
        b = score.argmax(axis=1)
        found = score[every, b]
        better = found > best
        best[better], feature[better], cut[better] = found[better], subset[better, s], b[better]
        below[better] = left[every[better], :, b[better]]
    return best, feature, cut, total, below


def _sides(pos, col, codes, feature, cut):
    """Twice the node of each row, and one more where the row goes right."""
    out = np.empty(len(pos), np.int64)
    for i in range(0, len(pos), STRIDE):
        node = pos[i:i + STRIDE]
        at = feature.take(node, mode="clip")
        at += col[i:i + STRIDE]
        right = (codes.take(at, mode="clip") & (BINS - 1)) > cut.take(node, mode="clip")
        np.add(2 * node, right, out=out[i:i + STRIDE])
    return out


def grow_tree(codes: np.ndarray, n_features: int, rows: np.ndarray, counts: np.ndarray, weights: np.ndarray,
              params: C.ForestParams, rng: np.random.Generator, judged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of one tree in breadth-first order, and the node that each judged row ends in.

    ``codes`` are the bins of all rows one after the other; ``rows`` and ``counts`` are the
    bootstrap, ``weights`` those of the classes.
    """
    k = subset_size(params.subset, n_features)
    kind = _node_type(len(weights))

    def nodes_of(raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw), kind)
        out["stats"], out["raw"] = raw * weights, raw.sum(axis=1)
        w = out["stats"].sum(axis=1)
        out["impurity"] = 1.0 - (out["stats"] ** 2).sum(axis=1) / np.where(w > 0, w * w, 1.0)
        out["gain"], out["left"], out["right"], out["feature"], out["bin"] = -1.0, -1, -1, -1, -1
        return out

    cls = (codes.take(rows * n_features) // BINS).astype(np.int64)
    levels = [nodes_of(np.bincount(cls, counts, len(weights))[None, :])]
    first, size = 0, 1  # ids of the newest level begin at first
    active = np.arange(1) if levels[0]["impurity"][0] >= PURE else np.arange(0)  # places in the newest level
    pos, col = np.zeros(len(rows), np.int64), rows * n_features
    at, hcol, leaf = np.zeros(len(judged), np.int64), judged * n_features, np.zeros(len(judged), np.int64)
    row = np.arange(len(judged))
    for depth in range(params.max_depth):
        if len(active) == 0 or len(pos) == 0:
            break
        level = levels[-1]
        subset = rng.random((len(active), n_features)).argsort(axis=1)[:, :k]
        best, feature, cut, total, below = _best_splits(pos, col, counts, codes, subset, weights, params.min_instances)
        w = level["stats"][active].sum(axis=1)
        gain = np.where(np.isfinite(best), best / w - (level["stats"][active] ** 2).sum(axis=1) / (w * w), -1.0)
        split = gain > 0.0
        n = int(split.sum())
        who = active[split]
        level["gain"][who], level["feature"][who], level["bin"][who] = gain[split], feature[split], cut[split]
        level["left"][who] = size + 2 * np.arange(n)
        level["right"][who] = level["left"][who] + 1
        raw = np.empty((2 * n, len(weights)))
        raw[::2], raw[1::2] = below[split], total[split] - below[split]
        levels.append(nodes_of(raw))
        # a child is split in turn unless it is pure, too small or at the last level
        again = (levels[-1]["impurity"] >= PURE) & (levels[-1]["raw"] >= 2 * params.min_instances)
        again &= depth + 1 < params.max_depth
        # where the rows of an active node go: the place of the child among the active ones, or the leaf
        goes = np.full((len(active), 2), -1)
        ends = np.repeat(first + active, 2).reshape(-1, 2)
        place = np.where(again, np.cumsum(again) - 1, -1)
        goes[split] = place.reshape(-1, 2)
        ends[split] = size + np.arange(2 * n).reshape(-1, 2)
        active = np.flatnonzero(again)
        first, size = size, size + 2 * n

        if len(at):
            side = _sides(at, hcol, codes, feature, cut)
            to = goes.ravel().take(side)
            done = to < 0
            leaf[row[done]] = ends.ravel().take(side[done])
            stay = np.flatnonzero(~done)
            at, hcol, row = to.take(stay), hcol.take(stay), row.take(stay)
        if len(active):
            pos = goes.ravel().take(_sides(pos, col, codes, feature, cut))
            if (pos < 0).any():
                stay = np.flatnonzero(pos >= 0)
                pos, col, counts = pos.take(stay), col.take(stay), counts.take(stay)
    return _merged(levels, leaf)


def _merged(levels: list[np.ndarray], leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sibling leaves of one prediction become their parent, from the last level up, as in Spark ML."""
    nodes = np.concatenate(levels)
    ends = np.cumsum([len(level) for level in levels])
    says = nodes["stats"].argmax(axis=1)
    target, kept = np.arange(len(nodes)), np.ones(len(nodes), bool)
    for begin, end in reversed(list(zip([0, *ends[:-1]], ends))):
        who = begin + np.flatnonzero(nodes["left"][begin:end] >= 0)
        left, right = nodes["left"][who], nodes["right"][who]
        same = (nodes["left"][left] < 0) & (nodes["left"][right] < 0) & (says[left] == says[right])
        who, left, right = who[same], left[same], right[same]
        kept[left] = kept[right] = False
        target[left] = target[right] = who
        for name, none in (("gain", -1.0), ("left", -1), ("right", -1), ("feature", -1), ("bin", -1)):
            nodes[name][who] = none
    for begin, end in zip([0, *ends[:-1]], ends):  # a merged node may lie below another
        target[begin:end] = target[target[begin:end]]
    new = np.cumsum(kept) - 1
    out = nodes[kept]
    inner = out["left"] >= 0
    out["left"][inner], out["right"][inner] = new[out["left"][inner]], new[out["right"][inner]]
    return out, new[target[leaf]]


def _grow(fits: Sequence[int], n_features: int, weights: np.ndarray, params: C.ForestParams, tasks: int):
    """Arrow function of a task: its share of the trees of all fits."""
    trees = [(fit, tree) for fit in fits for tree in range(params.num_trees)]
    n_classes = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(r["block"], r["task"], r["codes"], r["y"], r["marks"])
                 for batch in batches for r in batch.to_pylist()]
        if not parts:
            return
        parts.sort(key=lambda p: p[0])
        task = parts[0][1]
        codes = np.frombuffer(b"".join(p[2] for p in parts), codes_type(n_classes))
        y = np.frombuffer(b"".join(p[3] for p in parts), np.uint8)
        marks = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
        del parts
        now, votes, train, judged = None, None, None, None

        def chunks():
            for i in range(0, len(judged), CHUNK):
                yield out(now, -1, i // CHUNK, votes[i:i + CHUNK], y[judged[i:i + CHUNK]])

        def out(fit, tree, chunk, data, of):
            return pa.RecordBatch.from_pydict({
                "fit": pa.array([fit], pa.int32()), "tree": pa.array([tree], pa.int32()),
                "chunk": pa.array([chunk], pa.int32()), "data": pa.array([data.tobytes()], pa.binary()),
                "y": pa.array([of.tobytes()], pa.binary())})

        for fit, tree in trees[task * len(trees) // tasks:(task + 1) * len(trees) // tasks]:
            if fit != now:
                if now is not None:
                    yield from chunks()
                now, train = fit, np.flatnonzero(trained_on(marks, fit))
                judged = np.flatnonzero(held_out(marks, fit))
                votes = np.zeros((len(judged), n_classes))
            rng = np.random.default_rng([params.seed, fit + 1, tree])
            counts = rng.poisson(1.0, len(train))
            drawn = np.flatnonzero(counts)
            nodes, leaf = grow_tree(codes, n_features, train[drawn], counts[drawn].astype(float), weights,
                                    params, rng, judged)
            if fit == FINAL:
                yield out(fit, tree, 0, nodes, y[:0])
            else:
                stats = nodes["stats"]
                votes += (stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300))[leaf]
        if now is not None:
            yield from chunks()

    return run


def grow(packed: DataFrame, fits: Sequence[int], n_features: int, weights: Sequence[float],
         params: C.ForestParams) -> DataFrame:
    """Trees of the final model, and the votes of every fold's forest over the rows it left out, stored."""
    spark = packed.sparkSession
    tasks = min(ROUNDS * spark.sparkContext.defaultParallelism, len(fits) * params.num_trees)
    dealt = packed.select("block", "codes", "y", "marks",
                          F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"))
    run = _grow(fits, n_features, np.asarray(weights, float), params, tasks)
    return stored(dealt.repartitionById(tasks, F.col("task")).mapInArrow(run, _GROWN), "grown")


def fold_predictions(grown: DataFrame, n_classes: int) -> DataFrame:
    """``(fold, label, pred)`` of every row, by the forest that left out its fold."""
    def summed(table: pa.Table) -> pa.Table:
        votes = sum(np.frombuffer(v.as_py(), float) for v in table.column("data"))
        y = np.frombuffer(table.column("y")[0].as_py(), np.uint8)
        pred = votes.reshape(-1, n_classes).argmax(axis=1)
        fold = np.full(len(y), table.column("fit")[0].as_py())
        return pa.table({"fold": pa.array(fold, pa.int32()), "label": pa.array(y, pa.int32()),
                         "pred": pa.array(pred, pa.int32())})

    return grown.filter(F.col("fit") != FINAL).groupBy("fit", "chunk").applyInArrow(
        summed, "fold int, label int, pred int")


def model(grown: DataFrame, estimator: RandomForestClassifier, cuts: Sequence[np.ndarray],
          n_classes: int) -> RandomForestClassificationModel:
    """The final forest as Spark ML's model: written in its format and loaded."""
    kind = _node_type(n_classes)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = np.frombuffer(row["data"], kind)
                inner = t["left"] >= 0
                at = [[float(cuts[f][b])] if f >= 0 else [] for f, b in zip(t["feature"], t["bin"])]
                ends = np.arange(len(t) + 1, dtype=np.int32) * n_classes
                yield pa.RecordBatch.from_pydict({
                    "treeID": pa.array(np.full(len(t), row["tree"]), pa.int32()),
                    "id": pa.array(np.arange(len(t)), pa.int32()),
                    "prediction": pa.array(t["stats"].argmax(axis=1).astype(float)),
                    "impurity": pa.array(t["impurity"]),
                    "impurityStats": pa.ListArray.from_arrays(ends, t["stats"].ravel()),
                    "rawCount": pa.array(t["raw"]), "gain": pa.array(np.where(inner, t["gain"], -1.0)),
                    "leftChild": pa.array(t["left"]), "rightChild": pa.array(t["right"]),
                    "feature": pa.array(t["feature"]), "threshold": pa.array(at, pa.list_(pa.float64()))})

    spark = grown.sparkSession
    path = shared_dir(spark, "forest")
    nodes = grown.filter(F.col("fit") == FINAL).select("tree", "data").mapInArrow(tables, _NODES)
    nodes.select("treeID", F.struct(
        "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild",
        F.struct(F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData")).write.parquet(f"{path}/data")

    def about(cls: str, uid: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.classification.{cls}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, "paramMap": {"impurity": "gini"},
                           "defaultParamMap": {}, **more})

    n_trees = estimator.getNumTrees()
    spark.createDataFrame(
        [(i, about("DecisionTreeClassificationModel", f"{estimator.uid}_{i}"), 1.0) for i in range(n_trees)],
        "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(
        [(about("RandomForestClassificationModel", estimator.uid, numFeatures=len(cuts), numClasses=n_classes,
                numTrees=n_trees),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return estimator._copyValues(RandomForestClassificationModel.load(path))
