"""Gradient-boosted trees of the second order over binned features, with the penalties that MLlib's trees lack.

Features are cut into at most BINS quantile bins.  For each level of a tree every task sums gradients and Hessians of its rows
by node, feature and bin; the sums of all tasks, at most nodes x features x bins of them, decide the splits by the gain
1/2 [G_L^2/(H_L + lambda) + G_R^2/(H_R + lambda) - G^2/(H + lambda)] - gamma with G soft-thresholded by alpha (Chen and
Guestrin, 2016).  Rows stay where they are: no row is shuffled, only sums are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import metrics, sampling
from gridloom.operators.graph import checkpointed
from gridloom.ship import ship

BINS = 64
#: Trees between checkpoints of the margins.
WRITE_EVERY = 10


@dataclass
class Tree:
    """A binary tree in heap order: node i has children 2 i + 1 and 2 i + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row is in after so many levels."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            inner = self.feature[at] >= 0
            right = bins[np.arange(len(bins)), np.maximum(self.feature[at], 0)] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


@dataclass
class Booster:
    features: list[str]
    edges: list[np.ndarray]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    gains: np.ndarray | None = None

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin numbers; missing values are in the last bin."""
        return np.stack([np.where(np.isnan(x), len(e), np.searchsorted(e, x, side="left")) for x, e in zip(columns, self.edges, strict=True)], axis=1)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out += t.value[t.nodes(bins, self.depth)]
        return out

    def importance(self) -> list[tuple[int, str, float]]:
        """(rank, feature, share of the gain); of equal ones the later feature ranks first."""
        total = self.gains.sum() or 1.0
        order = sorted(range(len(self.features)), key=lambda i: (-self.gains[i], -i))
        return [(k, self.features[i], float(self.gains[i] / total)) for k, i in enumerate(order, 1)]


def save(spark: SparkSession, model: Booster, path: str) -> None:
    """Writes a model as one JSON document, in place of an older one; numbers keep all their digits."""
    trees = [{name: getattr(t, name).tolist() for name in ("feature", "bin", "value")} for t in model.trees]
    document = {"features": model.features, "edges": [e.tolist() for e in model.edges], "base": model.base, "depth": model.depth, "trees": trees, "gains": model.gains.tolist()}
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Booster:
    """The model that save() wrote."""
    d = json.loads(spark.read.text(path).first()["value"])
    trees = [Tree(np.array(t["feature"], np.int64), np.array(t["bin"], np.int64), np.array(t["value"], float)) for t in d["trees"]]
    return Booster(d["features"], [np.array(e, float) for e in d["edges"]], d["base"], d["depth"], trees, np.array(d["gains"], float))


def search(df: DataFrame, features: list[str], points: list[dict], key: list[str], folds: int = 5, label: str = "label", seed: int = 42) -> list[tuple[dict, float, float]]:
    """Cross-validated search by AUC over stratified folds, all parameters of a point in force; (point, mean, deviation) by falling mean.

    A fold without both classes has no AUC and is left out of the mean; a point without any comes last, with NaN.
    """
    folded = checkpointed(sampling.stratified_folds(df.select(*key, *features, label), label, seed, *key, folds=folds))
    found = []
    for p in points:
        scores = []
        for k in range(folds):
            held = probability(train(folded.filter(F.col("fold") != k), features, p, label, seed), folded.filter(F.col("fold") == k))
            scores.append(metrics.auc(held, label, "probability").first()["auc"])
        known = [x for x in scores if x is not None]
        found.append((p, float(np.mean(known)) if known else float("nan"), float(np.std(known)) if known else float("nan")))
    return sorted(found, key=lambda x: -x[1] if x[1] == x[1] else np.inf)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names]


def train(df: DataFrame, features: list[str], params: dict, label: str = "label", seed: int = 42) -> Booster:
    """params: n_estimators, max_depth, learning_rate, subsample, colsample_bytree, gamma, reg_alpha, reg_lambda, min_child_weight and, if wanted, scale_pos_weight."""
    ship(df.sparkSession)
    depth, rate, lam, alpha, gamma = int(params["max_depth"]), params["learning_rate"], params["reg_lambda"], params["reg_alpha"], params["gamma"]
    weight, least = float(params.get("scale_pos_weight", 1.0)), params["min_child_weight"]
    cuts = df.stat.approxQuantile(features, [k / BINS for k in range(1, BINS)], 0.001)
    model = Booster(features, [np.unique(c) for c in cuts], 0.0, depth, gains=np.zeros(len(features)))
    n_bins = 1 + max(len(e) for e in model.edges) + 1

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = model.binned(_columns(b, features)).astype(np.uint8)
            yield pa.record_batch([pa.array([x.tobytes() for x in bins], pa.binary()), b.column("y"), b.column("u"), pa.array(np.zeros(b.num_rows))], ["bins", "y", "u", "margin"])

    spread = F.pmod(F.xxhash64(F.lit(seed), *features, label), F.lit(1 << 30)) / float(1 << 30)
    plain = df.select(*features, F.col(label).cast("double").alias("y"), spread.alias("u")).filter("y is not null")
    rows = checkpointed(plain.mapInArrow(binned, "bins binary, y double, u double, margin double"))
    random = np.random.default_rng(seed)
    for k in range(int(params["n_estimators"])):
        chosen = np.sort(random.choice(len(features), max(1, round(params["colsample_bytree"] * len(features))), replace=False))
        shift, size = random.random(), 2 ** (depth + 1) - 1
        tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))
        for level in range(depth + 1):
            sums = _sums(rows, tree, level, chosen, n_bins, len(features), weight, shift, params["subsample"])
            first, split = 2**level - 1, False
            for node in range(first, 2 * first + 1):
                part = sums[node - first]
                g, h = part[0].sum(axis=0)
                soft = lambda x: np.sign(x) * np.maximum(np.abs(x) - alpha, 0)
                tree.value[node] = -rate * soft(g) / (h + lam) if h > 0 else 0.0
                if level == depth or h < 2 * least:
                    continue
                left = part.cumsum(axis=1)[:, :-1]
                gl, hl = left[..., 0], left[..., 1]
                gain = 0.5 * (soft(gl) ** 2 / (hl + lam) + soft(g - gl) ** 2 / (h - hl + lam) - soft(g) ** 2 / (h + lam)) - gamma
                gain = np.where((hl >= least) & (h - hl >= least), gain, -np.inf)
                f, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, b] > 0:
                    tree.feature[node], tree.bin[node], split = chosen[f], b, True
                    model.gains[chosen[f]] += gain[f, b]
            if not split:
                break
        model.trees.append(tree)
        rows = rows.mapInArrow(_moved(tree, depth, len(features)), "bins binary, y double, u double, margin double")
        if (k + 1) % WRITE_EVERY == 0:
            rows = checkpointed(rows)
    return model


def _bins(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, n)


def _moved(tree: Tree, depth: int, n: int):
    """Rows with the tree's values added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                new = b.column("margin").to_numpy() + tree.value[tree.nodes(_bins(b, n), depth)]
                yield pa.record_batch([b.column("bins"), b.column("y"), b.column("u"), pa.array(new)], ["bins", "y", "u", "margin"])

    return run


def _sums(rows: DataFrame, tree: Tree, level: int, chosen: np.ndarray, n_bins: int, n: int, weight: float, shift: float, share: float) -> np.ndarray:
    """Sums of gradients and Hessians by node of a level, chosen feature and bin, of the rows in the tree's sample."""
    first = 2**level - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2**level * len(chosen) * n_bins, 2))
        for b in batches:
            if not b.num_rows:
                continue
            bins, y = _bins(b, n), b.column("y").to_numpy()
            node = tree.nodes(bins, level) - first
            on = (node >= 0) & ((b.column("u").to_numpy() + shift) % 1.0 < share)
            p, w = sigmoid(b.column("margin").to_numpy()), np.where(y == 1, weight, 1.0)
            for j, f in enumerate(chosen):
                at = ((node * len(chosen) + j) * n_bins + bins[:, f])[on]
                for k, v in enumerate((w * (p - y), w * p * (1 - p))):
                    total[:, k] += np.bincount(at, v[on], len(total))
        used = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(used), pa.array(total[used, 0]), pa.array(total[used, 1])], ["at", "g", "h"])

    found = rows.mapInArrow(run, "at long, g double, h double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
    out = np.zeros((2**level * len(chosen) * n_bins, 2))
    out[found["at"].to_numpy(np.int64)] = found[["g", "h"]].to_numpy()
    return out.reshape(2**level, len(chosen), n_bins, 2)


def probability(model: Booster, df: DataFrame, name: str = "probability") -> DataFrame:
    """df with the probability of class 1."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = shared.value
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sigmoid(m.margins(m.binned(_columns(b, m.features)))))], [*b.schema.names, name])

    return df.mapInArrow(run, df.withColumn(name, F.lit(0.0)).schema)
