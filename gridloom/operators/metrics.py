"""Measures of a binary classifier over rows (label, score or prediction), whole or by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the score within which it's ranked.
BUCKETS = 256


def decided(probability: Column, cut: float = 0.5) -> Column:
    return (probability > cut).cast("int")


def confusion(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by or []).agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def report(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, and precision, recall, F1 and support of both classes; what has no denominator is 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    out = confusion(df, label, prediction, by)
    for name, hit, false, missed in (("positive", tp, fp, fn), ("negative", tn, fn, fp)):
        out = out.withColumn(f"precision_{name}", ratio(hit, hit + false)).withColumn(f"recall_{name}", ratio(hit, hit + missed)).withColumn(f"f1_{name}", ratio(2 * hit, 2 * hit + false + missed)).withColumn(f"support_{name}", hit + missed)
    return out.withColumn("accuracy", ratio(tp + tn, tn + fp + fn + tp))


def auc(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL without both classes.

    Rows are first counted by score.  The counts below a score are summed within ranges of the score, and over the ranges,
    so that no task orders all scores.
    """
    by = by or []
    group = by or [F.lit(0).alias("__all")]
    names = by or ["__all"]
    counts = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*group, F.col(score).cast("double").alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    span = counts.agg(F.min("s").alias("low"), F.max("s").alias("high"))
    bucket = F.least(F.floor((F.col("s") - F.col("low")) / F.greatest(F.col("high") - F.col("low"), F.lit(1e-300)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    counts = counts.crossJoin(F.broadcast(span)).withColumn("b", bucket)  # span is one row
    inside = Window.partitionBy(*names, "b").orderBy("s")
    counts = counts.withColumn("below", F.sum("n").over(inside) - F.col("n"))
    sums = counts.groupBy(*names, "b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("p") * (2 * F.col("below") + F.col("n"))).alias("u2"))
    order = Window.partitionBy(*names).orderBy("b")
    sums = sums.withColumn("before", F.sum("n").over(order) - F.col("n"))
    whole = sums.groupBy(*names).agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("u2") + 2 * F.col("p") * F.col("before")).alias("u2"))
    return whole.select(*by, F.try_divide("u2", 2 * F.col("p") * F.col("n")).alias("auc"), (F.col("p") + F.col("n")).alias("rows"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives for each positive, to four decimals."""
    return df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")).withColumn("scale_pos_weight", F.round(F.try_divide("negatives", "positives"), 4))


def by_group(df: DataFrame, label: str, score: str, group: str, least_rows: int = 10, cut: float = 0.5) -> DataFrame:
    """AUC, and recall, precision and F1 of the positive class, of each group of least_rows rows or more."""
    measured = report(df.withColumn("__decided", decided(F.col(score), cut)), label, "__decided", [group])
    return auc(df, label, score, [group]).join(measured, group).filter(F.col("rows") >= least_rows).select(group, "rows", "auc", "recall_positive", "precision_positive", "f1_positive")


def fold_scores(df: DataFrame, params: str, score: str) -> DataFrame:
    """Mean and deviation of the folds' scores, by parameters."""
    return df.groupBy(params).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))


def top_parameters(df: DataFrame, params: str, score: str, n: int = 10) -> DataFrame:
    return fold_scores(df, params, score).orderBy(F.desc("mean_score"), params).limit(n)
