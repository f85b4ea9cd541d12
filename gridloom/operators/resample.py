"""Resampling of rasters in cell form as weighted group aggregates over equi-joins on target cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.crs import FROM_DEGREES, TO_DEGREES
from gridloom.functions.terrain import world_x, world_y
from gridloom.operators.focal import with_raster_values, with_size
from gridloom.schema import COL, KEY, RASTER, ROW


def _target_near(at: Column, n: Column, new: Column) -> Column:
    """Target indices whose triangle of one target pixel reaches a source index, with integer weights out of 2 n."""
    middle = F.floor(((2 * at + 1) * new - n) / (2 * n)).cast("long")
    pair = F.array(middle, middle + 1)
    weighted = F.transform(pair, lambda t: F.struct(t.cast("int").alias("t"), (2 * n - F.abs((2 * at + 1) * new - (2 * t + 1) * n)).cast("long").alias("w")))
    return F.filter(weighted, lambda x: (x["t"] >= 0) & (x["t"] < new) & (x["w"] > 0))


def downsample(df: DataFrame, value: str, factor: int = 10) -> DataFrame:
    """df at int(n / factor) rows and columns: means weighted by a triangle of one target pixel, over measured cells only."""
    sized = with_size(df.select(*KEY, F.col(value).alias("v"))).filter("v is not null")
    new_r, new_c = [F.greatest(F.floor(F.col(n) / factor), F.lit(1)).cast("long") for n in ("n_r", "n_c")]
    sent = sized.withColumn("tr", F.explode(_target_near(F.col(ROW).cast("long"), F.col("n_r").cast("long"), new_r)))
    sent = sent.withColumn("tc", F.explode(_target_near(F.col(COL).cast("long"), F.col("n_c").cast("long"), new_c)))
    w = F.col("tr.w") * F.col("tc.w")
    sums = sent.groupBy(RASTER, F.col("tr.t").alias(ROW), F.col("tc.t").alias(COL)).agg(F.sum(w * F.col("v")).alias("s"), F.sum(w).alias("w"))
    return sums.select(*KEY, (F.col("s") / F.col("w")).alias(value))


def _sources_near(at: Column, new: Column, n: Column) -> Column:
    """The two source indices around a target index, clamped to the raster, with integer weights out of 2 new."""
    low = F.floor(((2 * at + 1) * n - new) / (2 * new)).cast("long")
    pair = F.array(low, low + 1)
    weight = lambda t: (2 * new - F.abs((2 * at + 1) * n - (2 * t + 1) * new)).cast("long")
    return F.filter(F.transform(pair, lambda t: F.struct(F.greatest(F.lit(0), F.least(t, n - 1)).cast("int").alias("t"), weight(t).alias("w"))), lambda x: x["w"] > 0)


def upsample(df: DataFrame, value: str, like: DataFrame) -> DataFrame:
    """df on the cells of another raster of the same extent: bilinear between half-pixel centres, over measured cells only."""
    sizes = df.groupBy(RASTER).agg((F.max(ROW) + 1).cast("long").alias("s_r"), (F.max(COL) + 1).cast("long").alias("s_c"))
    target = with_raster_values(with_size(like.select(*KEY)), sizes)
    near = target.withColumn("sr", F.explode(_sources_near(F.col(ROW).cast("long"), F.col("n_r").cast("long"), F.col("s_r"))))
    near = near.withColumn("sc", F.explode(_sources_near(F.col(COL).cast("long"), F.col("n_c").cast("long"), F.col("s_c"))))
    source = df.select(RASTER, F.col(ROW).alias("at_r"), F.col(COL).alias("at_c"), F.col(value).alias("v")).filter("v is not null")
    near = near.select(*KEY, F.col("sr.t").alias("at_r"), F.col("sc.t").alias("at_c"), (F.col("sr.w") * F.col("sc.w")).alias("w"))
    sums = near.join(source, [RASTER, "at_r", "at_c"]).groupBy(*KEY).agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias(value))
    return like.select(*KEY).join(sums, KEY, "left")


def cubic(d: Column) -> Column:
    """Keys' kernel, a = -1/2."""
    x = F.abs(d)
    return F.when(x <= 1, 1.5 * x * x * x - 2.5 * x * x + 1).when(x < 2, -0.5 * x * x * x + 2.5 * x * x - 4 * x + 2).otherwise(0.0)


def sampled(df: DataFrame, value: str, points: DataFrame, kernel: str = "bilinear") -> DataFrame:
    """points with the interpolated value at (raster_id, fr, fc), fractional rows and columns of cell centres; NULL where no cell is near."""
    reach, weight = {"bilinear": ((0, 1), lambda d: F.greatest(F.lit(0.0), 1 - F.abs(d))), "bicubic": ((-1, 0, 1, 2), cubic)}[kernel]
    # A point is known by all its columns; equal points are put together, counted and taken apart again.
    near = points.groupBy(*points.columns).agg(F.count(F.lit(1)).alias("__copies"))
    for fraction, at in (("fr", "at_r"), ("fc", "at_c")):
        near = near.withColumn(at, F.explode(F.array(*[(F.floor(fraction) + k).cast("int") for k in reach])))
    source = df.select(RASTER, F.col(ROW).alias("at_r"), F.col(COL).alias("at_c"), F.col(value).cast("double").alias("__v")).filter("__v is not null")
    w = F.when(F.col("__v").isNotNull(), weight(F.col("fr") - F.col("at_r")) * weight(F.col("fc") - F.col("at_c")))
    sums = near.join(source, [RASTER, "at_r", "at_c"], "left").withColumn("__w", w).groupBy(*points.columns, "__copies").agg(F.sum(F.col("__w") * F.col("__v")).alias("__s"), F.sum("__w").alias("__w"))
    found = F.when(F.col("__w") > 1e-12, F.col("__s") / F.col("__w")).alias(value)
    return sums.select(*points.columns, found, F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))).drop("col")


def reprojected(df: DataFrame, value: str, source_meta: dict, target: DataFrame, target_meta: dict, kernel: str = "bilinear") -> DataFrame:
    """df on the cells of target, a raster in another coordinate system; *_meta: srid and transform (a to f).

    Each target centre is projected into the source, where its neighbours are joined by row and column.
    """
    t, s = [F.struct(*[F.lit(float(m["transform"][i])).alias(x) for i, x in enumerate("abcdef")]) for m in (target_meta, source_meta)]
    # In steps: each is used more than once by the next, and so is computed by itself.
    at = target.select(*KEY, world_x(t, F.col(ROW), F.col(COL)).alias("x"), world_y(t, F.col(ROW), F.col(COL)).alias("y"))
    for step in (TO_DEGREES[target_meta["srid"]], FROM_DEGREES[source_meta["srid"]]) if source_meta["srid"] != target_meta["srid"] else ():
        x, y = step(F.col("x"), F.col("y"))
        at = at.select(*KEY, x.alias("x"), y.alias("y"))
    det = s["a"] * s["e"] - s["b"] * s["d"]
    fc = (s["e"] * (F.col("x") - s["c"]) - s["b"] * (F.col("y") - s["f"])) / det - 0.5
    fr = (s["a"] * (F.col("y") - s["f"]) - s["d"] * (F.col("x") - s["c"])) / det - 0.5
    return sampled(df, value, at.select(*KEY, fr.alias("fr"), fc.alias("fc")), kernel).select(*KEY, value)
