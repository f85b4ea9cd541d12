"""Statistics of rasters, whole or by zone, in one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.terrain import coverage_percent, hectares


def statistics(df: DataFrame, value: str, by: list[str] | None = None, valid: Column | None = None) -> DataFrame:
    """min, max, mean, median and count of the valid values."""
    v = F.col(value) if valid is None else F.when(valid, F.col(value))
    return df.groupBy(*by or []).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.count(v).alias("count"))


def combined_reducer(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """mean, min, max and standard deviation of each zone."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_pop(value).alias("std"))


def region_area(df: DataFrame, mask: Column, cell_area: float, by: list[str] | None = None) -> DataFrame:
    """Square metres of the cells in the mask."""
    return df.groupBy(*by or []).agg((F.count_if(mask) * cell_area).alias("area"))


def meadow_summary(df: DataFrame, probability: str, valid: Column, cut: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """Pixels above the cut, their hectares, valid pixels and coverage."""
    counts = df.groupBy(*by or []).agg(F.count_if(valid & (F.col(probability) > cut)).alias("meadow_pixels"), F.count_if(valid).alias("valid_pixels"))
    return counts.withColumn("hectares", hectares(F.col("meadow_pixels"))).withColumn("coverage", coverage_percent(F.col("meadow_pixels"), F.col("valid_pixels")))


def threshold_counts(df: DataFrame, probability: str, levels: list[float]) -> DataFrame:
    """Cells at or above each level."""
    p = F.col(probability)
    return df.agg(*[F.count_if(p >= t).alias(f"ge_{round(t * 100):02d}") for t in levels])


def prefix_counts(df: DataFrame, attribute: str, prefixes: tuple[str, ...]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(attribute).startswith(p)).alias(f"n_{p.lower()}") for p in prefixes], F.count(F.lit(1)).alias("n_all"))


def percentile_labels(df: DataFrame, value: str, p: float = 0.9) -> DataFrame:
    """df with label 1 above a percentile (interpolated) of its value, else 0."""
    cut = df.agg(F.percentile(value, F.lit(p)).alias("__cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("label", (F.col(value) > F.col("__cut")).cast("int")).drop("__cut")  # cut is one row


def profiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, min, max) of each column."""
    wide = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"min_{c}").cast("double").alias("min"), F.col(f"max_{c}").cast("double").alias("max")) for c in columns])
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def status_tally(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
