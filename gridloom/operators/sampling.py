"""Samples, splits and folds by hash order: the same rows whatever the partitioning, and no task orders a whole class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that part a class for ranking.
BUCKET_DIGITS = 2


def hash_order(seed: int, *key: str) -> Column:
    """A digest that puts rows into a seeded random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))


def ranked(df: DataFrame, by: list[str], seed: int, *key: str) -> DataFrame:
    """df with rank, from 1, in hash order among the rows of equal by, and their number as size.

    Rows are ranked within buckets of the hash; the buckets' offsets come from their counts.
    """
    hashed = df.withColumn("__hash", hash_order(seed, *key)).withColumn("__bucket", F.substring("__hash", 1, BUCKET_DIGITS))
    counts = hashed.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*by).orderBy("__bucket")
    offsets = counts.select(*by, "__bucket", (F.sum("__n").over(order) - F.col("__n")).alias("__offset"), F.sum("__n").over(Window.partitionBy(*by)).alias("size"))
    same = [hashed[c].eqNullSafe(offsets[c]) for c in [*by, "__bucket"]]
    joined = hashed.join(offsets, same).select(hashed["*"], "__offset", "size")
    inside = F.row_number().over(Window.partitionBy(*by, "__bucket").orderBy("__hash", *key))
    return joined.withColumn("rank", (inside + F.col("__offset")).cast("long")).drop("__hash", "__bucket", "__offset")


def first_n(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """n rows in hash order, by a distributed top-n."""
    return df.withColumn("__hash", hash_order(seed, *key)).orderBy("__hash", *key).limit(n).drop("__hash")


def balanced(df: DataFrame, label: str, seed: int, *key: str, positives: int = 20000, negatives: int = 80000, ratio: int = 4) -> DataFrame:
    """At most so many positive and negative rows; where positives are scarce, ratio negatives for each."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    p = min(positives, counts["p"])
    n = min(negatives if counts["p"] >= positives else ratio * p, counts["n"])
    return first_n(df.filter(F.col(label) == 1), p, seed, *key).unionByName(first_n(df.filter(F.col(label) == 0), n, seed, *key))


def per_group(df: DataFrame, group: str, total: int, seed: int, *key: str) -> DataFrame:
    """An equal share of total rows from each group, at least one."""
    groups = df.select(group).distinct().count()
    each = max(1, total // max(groups, 1))
    return ranked(df, [group], seed, *key).filter(F.col("rank") <= each).drop("rank", "size")


def stratified_split(df: DataFrame, label: str, seed: int, *key: str, train: float = 0.75) -> DataFrame:
    """df with is_train: exactly the floor of that part of each label."""
    return ranked(df, [label], seed, *key).withColumn("is_train", F.col("rank") <= F.floor(F.col("size") * train)).drop("rank", "size")


def stratified_folds(df: DataFrame, label: str, seed: int, *key: str, folds: int = 5) -> DataFrame:
    """df with fold: labels are dealt round the folds."""
    return ranked(df, [label], seed, *key).withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank", "size")
