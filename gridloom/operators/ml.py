"""Models of labelled pixels: search, training, evaluation, importance and prediction."""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.missing import valid_pixel
from gridloom.operators import boosting, metrics, sampling
from gridloom.operators.fill import hole_fill
from gridloom.schema import KEY

#: The grid of the search, by the names of boosted trees (fixed values); those that MLlib has no equal of are drawn too, and kept with the result.
GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 4, 6, 8],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
    "scale_pos_weight": [1, 3, 5, 9],
    "gamma": [0.0, 0.1, 0.5, 1.0],
    "reg_alpha": [0.0, 0.1, 0.5],
    "reg_lambda": [1.0, 1.5, 2.0],
    "min_child_weight": [1, 3, 5],
}

#: The grid of the forests (fixed values); a class weight is that of positives beside 1, None is 1 and the balanced ones are the ratio of the classes.
FOREST_GRID = {
    "n_estimators": [50, 100, 150, 200, 250, 300],
    "max_depth": [None, 10, 20],
    "min_samples_split": [2, 5],
    "min_samples_leaf": [1, 2],
    "bootstrap": [True, False],
    "class_weight": [None, "balanced", "balanced_subsample", 3, 5],
}
#: The deepest tree that MLlib grows, for a depth of None.
DEEPEST = 30


def draws(grid: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """n different points of a grid, at random."""
    total = 1
    for v in grid.values():
        total *= len(v)
    out = []
    for at in random.Random(seed).sample(range(total), min(n, total)):
        point = {}
        for k, v in grid.items():
            at, i = divmod(at, len(v))
            point[k] = v[i]
        out.append(point)
    return out


def boosted_trees(params: dict, weight: str | None = "weight", seed: int = 42) -> GBTClassifier:
    out = GBTClassifier(featuresCol="features", labelCol="label", seed=seed, maxIter=int(params["n_estimators"]), maxDepth=int(params["max_depth"]), stepSize=params["learning_rate"], subsamplingRate=params["subsample"], featureSubsetStrategy=str(params["colsample_bytree"]), minInstancesPerNode=int(params["min_child_weight"]))
    return out.setWeightCol(weight) if weight else out


def forest(trees: int = 300, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, featureSubsetStrategy="sqrt", seed=seed)


def weighted(df: DataFrame) -> DataFrame:
    """df with weight: the ratio of negatives to positives for positives, else 1."""
    ratio = metrics.class_weight(df, "label").first()["scale_pos_weight"]
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(ratio or 1.0))).otherwise(1.0))


def train(df: DataFrame, features: list[str], classifier) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), classifier]).fit(df)


def probability(model: PipelineModel | CrossValidatorModel | boosting.Booster, df: DataFrame, name: str = "probability") -> DataFrame:
    """df with the probability of class 1."""
    if isinstance(model, boosting.Booster):
        return boosting.probability(model, df, name)
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array(F.col("probability"))[1].alias(name))


def evaluate(df: DataFrame, score: str = "probability", by: list[str] | None = None) -> DataFrame:
    """AUC and the report at a cut of one half."""
    measured = metrics.report(df.withColumn("__decided", metrics.decided(F.col(score))), "label", "__decided", by)
    area = metrics.auc(df, "label", score, by)
    return area.join(measured, by) if by else area.crossJoin(measured)  # one row each


def positive_weight(point: dict) -> float | None:
    """What positives weigh beside 1 at a point of either grid; None is the ratio of negatives to positives."""
    if "class_weight" in point:
        w = point["class_weight"]
        return None if isinstance(w, str) else float(w or 1)
    return float(point["scale_pos_weight"]) if "scale_pos_weight" in point else None


def settings(classifier: GBTClassifier | RandomForestClassifier, point: dict, weight: str) -> dict:
    """A point as MLlib's parameters, with the column that weighs rows."""
    trees, depth = int(point["n_estimators"]), int(point["max_depth"] or DEEPEST)
    out = {classifier.weightCol: weight, classifier.maxDepth: depth}
    if isinstance(classifier, RandomForestClassifier):
        return out | {classifier.numTrees: trees, classifier.minInstancesPerNode: int(point["min_samples_leaf"]), classifier.bootstrap: bool(point["bootstrap"])}
    return out | {classifier.maxIter: trees, classifier.stepSize: float(point["learning_rate"]), classifier.subsamplingRate: float(point["subsample"]), classifier.featureSubsetStrategy: str(point["colsample_bytree"]), classifier.minInstancesPerNode: int(point["min_child_weight"])}


def search(df: DataFrame, features: list[str], points: list[dict], key: list[str], folds: int = 5, parallelism: int = 4, seed: int = 42) -> tuple[CrossValidatorModel, list[tuple[dict, float, float]]]:
    """Cross-validated search by AUC over stratified folds; (point, mean, deviation) by falling mean.

    Points are of GRID, or of FOREST_GRID for forests.  Positives weigh what positive_weight() says; the AUC is without weights.
    MLlib's trees have no equal of gamma, reg_alpha and reg_lambda (boosting.search() has) nor of min_samples_split; these are kept with the result.
    """
    folded = sampling.stratified_folds(weighted(df), "label", seed, *key, folds=folds)
    scales = {w: f"weight_{i}" for i, w in enumerate(sorted({positive_weight(p) for p in points} - {None}))}
    folded = folded.withColumns({name: F.when(F.col("label") == 1, F.lit(w)).otherwise(1.0) for w, name in scales.items()})
    classifier = forest(seed=seed) if "bootstrap" in points[0] else boosted_trees(points[0])
    maps = [settings(classifier, p, scales.get(positive_weight(p), "weight")) for p in points]
    validator = CrossValidator(estimator=Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), classifier]), estimatorParamMaps=maps, evaluator=BinaryClassificationEvaluator(numBins=0), numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    model = validator.fit(folded)
    found = sorted(zip(points, model.avgMetrics, model.stdMetrics, strict=True), key=lambda x: -x[1])
    return model, found


def importance(model: PipelineModel, features: list[str]) -> list[tuple[int, str, float]]:
    """(rank, feature, normalised importance); of equal ones the later feature ranks first."""
    values = model.stages[-1].featureImportances.toArray()
    order = sorted(range(len(features)), key=lambda i: (-values[i], -i))
    return [(rank, features[i], float(values[i])) for rank, i in enumerate(order, 1)]


def predict_raster(model: PipelineModel, stack: DataFrame, features: list[str], fill_holes: bool = True) -> DataFrame:
    """probability of every cell of a stack: predicted where all bands are valid, NULL elsewhere, enclosed gaps filled by the nearest."""
    valid = stack.filter(valid_pixel([F.col(f) for f in features]))
    found = stack.select(*KEY).join(probability(model, valid.select(*KEY, *features)).select(*KEY, "probability"), KEY, "left")
    return hole_fill(found, "probability") if fill_holes else found
