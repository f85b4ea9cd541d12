"""Focal operators on rasters in cell form (raster_id, r, c, values), as windows along rows and columns.

A box is separable: sums along rows, then along columns.  Two shuffles serve all values and statistics of one size, and the
cost doesn't grow with the size.  Every cell of a raster must have a row; missing ones hold NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridloom.schema import COL, KEY, RASTER, ROW

#: Tables of a row for each raster are broadcast up to so many.
BROADCAST_RASTERS = 100_000


def along_row() -> WindowSpec:
    return Window.partitionBy(RASTER, ROW).orderBy(COL)


def along_col() -> WindowSpec:
    return Window.partitionBy(RASTER, COL).orderBy(ROW)


def with_raster_values(df: DataFrame, by_raster: DataFrame) -> DataFrame:
    """df joined with a table of a row for each raster.

    The table is collected up to BROADCAST_RASTERS rows and then broadcast, so the cells of a large raster stay where they
    are; a longer one is joined by shuffling.
    """
    rows = by_raster.limit(BROADCAST_RASTERS + 1).collect()
    if len(rows) > BROADCAST_RASTERS:
        return df.join(by_raster, RASTER)
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, by_raster.schema)), RASTER)


def with_size(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """df with the height and width of each raster, as columns n_r and n_c, taken from the cells of like if given: the same rasters, with a shorter plan."""
    cells = df if like is None else like
    return with_raster_values(df, cells.groupBy(RASTER).agg((F.max(ROW) + 1).alias("n_r"), (F.max(COL) + 1).alias("n_c")))


def mirrored(df: DataFrame, axis: str, size: str, reach: int) -> DataFrame:
    """df with reach more cells at either end of an axis: the mirror image, edge included (d c b a | a b c d), again and again if the raster is smaller."""
    at, n = F.col(axis), F.col(size)
    once = F.array_compact(F.array(at, *[F.when(x.between(-reach, -1) | x.between(n, n + reach - 1), x) for x in (-1 - at, 2 * n - 1 - at)]))
    periods = F.ceil(F.lit(reach) / (2 * n)).cast("int") + 1
    again = F.flatten(F.transform(F.sequence(-periods, periods), lambda k: F.array(at + 2 * n * k, 2 * n * k - 1 - at)))
    copies = F.when(n >= reach, once).otherwise(F.filter(again, lambda x: x.between(-reach, n + reach - 1)))
    other = [c for c in df.columns if c != axis]
    return df.select(*other, F.explode(copies).alias(axis))


def box_sums(df: DataFrame, values: dict[str, Column], k: int) -> DataFrame:
    """For each cell the sums of values over the k by k box around it, mirrored at the edges, under the names given."""
    reach = k // 2
    sized = with_size(df.select(*KEY, *[v.alias(name) for name, v in values.items()]))
    along = mirrored(sized, COL, "n_c", reach)
    across = along_row().rangeBetween(-reach, reach)
    along = along.select(*KEY, "n_r", "n_c", *[F.sum(name).over(across).alias(name) for name in values]).filter(F.col(COL).between(0, F.col("n_c") - 1))
    down = mirrored(along, ROW, "n_r", reach)
    upright = along_col().rangeBetween(-reach, reach)
    return down.select(*KEY, "n_r", *[F.sum(name).over(upright).alias(name) for name in values]).filter(F.col(ROW).between(0, F.col("n_r") - 1)).drop("n_r")


def box_statistics(df: DataFrame, value: str, k: int) -> DataFrame:
    """mean and std (of the population) of value over the k by k box, and the focal value as z; value must have no NULL."""
    z = F.col(value)
    sums = box_sums(df, {"z": z, "s2": z * z}, k)
    mean, square = F.col("z") / (k * k), F.col("s2") / (k * k)
    moments = sums.select(*KEY, mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"))
    return df.select(*KEY, z.alias("z")).join(moments, KEY)


def with_gradient(df: DataFrame, value: str, spacing: float, dx: str = "dx", dy: str = "dy") -> DataFrame:
    """df with derivatives along columns (dx) and rows (dy): central differences, one-sided at the edges, NULL beside NULL."""

    def along(window, at: Column, n: str) -> Column:
        before, after = F.lag(value).over(window), F.lead(value).over(window)
        return F.when(at == 0, (after - F.col(value)) / spacing).when(at == F.col(n) - 1, (F.col(value) - before) / spacing).otherwise((after - before) / (2 * spacing))

    sized = df if "n_r" in df.columns else with_size(df)
    return sized.withColumn(dx, along(along_row(), F.col(COL), "n_c")).withColumn(dy, along(along_col(), F.col(ROW), "n_r"))


def with_second_derivatives(df: DataFrame, value: str, spacing: float) -> DataFrame:
    """df with dx, dy and zxx, zxy (dx along rows), zyy."""
    first = with_gradient(df, value, spacing)
    return with_gradient(with_gradient(first, "dx", spacing, "zxx", "zxy"), "dy", spacing, "zyx", "zyy").drop("zyx")


def tri(df: DataFrame, value: str) -> DataFrame:
    """Ruggedness: the sum of absolute differences to the 8 neighbours, mirrored without the edge (index -1 is 1); NULL beside NULL."""

    def pair(x: str, window, at: Column, n: str) -> list[Column]:
        before, after = F.lag(x).over(window), F.lead(x).over(window)
        return [F.when(at == 0, after).otherwise(before), F.when(at == F.col(n) - 1, before).otherwise(after)]

    sized = with_size(df.select(*KEY, F.col(value).alias("z")))
    left, right = pair("z", along_row(), F.col(COL), "n_c")
    rows = sized.withColumn("left", left).withColumn("right", right)
    neighbours = [F.col("left"), F.col("right"), *[x for name in ("left", "z", "right") for x in pair(name, along_col(), F.col(ROW), "n_r")]]
    return rows.select(*KEY, reduce(lambda a, b: a + b, [F.abs(x - F.col("z")) for x in neighbours]).alias("tri"))


def interior(df: DataFrame, value: str, k: int) -> DataFrame:
    """Whether all cells of the k by k box lie in the raster and are measured."""
    reach = k // 2
    sized = with_size(df.select(*KEY, F.col(value).isNotNull().cast("int").alias("ok")))
    across = F.sum("ok").over(along_row().rangeBetween(-reach, reach))
    upright = F.sum("ok").over(along_col().rangeBetween(-reach, reach))
    return sized.withColumn("ok", across).select(*KEY, (upright == k * k).alias("interior"))


def boxes_by_neighbour(df: DataFrame, value: str, k: int) -> DataFrame:
    """mean and std of the measured cells in the k by k box, by sending each value to its neighbours: the plain form, for comparison."""
    offsets = F.array(*[F.lit(i) for i in range(-(k // 2), k // 2 + 1)])
    sent = df.select(*KEY, F.col(value).alias("v")).withColumn("dr", F.explode(offsets)).withColumn("dc", F.explode(offsets))
    sums = sent.groupBy(RASTER, (F.col(ROW) + F.col("dr")).alias(ROW), (F.col(COL) + F.col("dc")).alias(COL)).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    return df.select(*KEY).join(sums, KEY)


def max_difference(a: DataFrame, b: DataFrame, value: str, inside: DataFrame) -> DataFrame:
    """Greatest absolute difference of two rasters, over interior cells and the rest."""
    both = a.select(*KEY, F.col(value).alias("a")).join(b.select(*KEY, F.col(value).alias("b")), KEY).join(inside, KEY)
    return both.groupBy("interior").agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"), F.count(F.lit(1)).alias("cells"))
