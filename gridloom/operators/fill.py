"""Filling of missing cells: by the median, by the nearest measured cell, at boundaries and in holes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.components import interior_holes
from gridloom.operators.focal import with_raster_values
from gridloom.schema import COL, KEY, RASTER, ROW
from gridloom.ship import ship

#: Rows of a raster that one call of the row pass takes, and pairs of cells that it compares at once.
ROWS_TOGETHER, PAIRS = 64, 4_000_000


#: Half the part of a raster's cells, around the middle one, whose values are counted one by one for its median, and the accuracy of the bounds.
AROUND_MIDDLE, ACCURACY = 0.001, 10_000


def medians(df: DataFrame, value: str) -> DataFrame:
    """(raster_id, median) over measured cells, exact: the mean of the two middle values if they're even in number.

    A sketch bounds the middle values; what lies below is only counted, and no task gets more of a raster than the distinct
    values within the bounds.
    """
    known = df.select(RASTER, F.col(value).cast("double").alias("v")).filter("v is not null")
    bounds = known.groupBy(RASTER).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", [0.5 - AROUND_MIDDLE, 0.5 + AROUND_MIDDLE], ACCURACY).alias("b"))
    placed = with_raster_values(known, bounds.select(RASTER, "n", F.col("b")[0].alias("low"), F.col("b")[1].alias("high"))).filter("v <= high")
    counts = placed.groupBy(RASTER, "n", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("m"))
    ranked = counts.withColumn("upto", F.sum("m").over(Window.partitionBy(RASTER).orderBy(F.asc_nulls_first("v"))))
    middle = lambda k: F.min(F.when(F.col("upto") > k, F.col("v")))
    return ranked.groupBy(RASTER).agg(((middle(F.floor((F.col("n") - 1) / 2)) + middle(F.floor(F.col("n") / 2))) / 2).alias("median"))


def median_fill(df: DataFrame, value: str) -> DataFrame:
    """df with NULLs of value replaced by the median of its raster; a raster without any stays NULL."""
    found = df.select(RASTER).distinct().join(medians(df, value), RASTER, "left")
    return with_raster_values(df, found.withColumnRenamed("median", "__median")).withColumn(value, F.coalesce(F.col(value).cast("double"), "__median")).drop("__median")


def nearest_fill(df: DataFrame, value: str, where: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """df with NULLs of value (where a condition holds) replaced by the value of the nearest measured cell of the raster.

    Nearest by Euclidean distance; ties go to the smaller row, then column.  Exact, in two passes: the nearest measured cell
    up or down in each column by windows, then the best of the columns for each row, in blocks of rows.  Columns named in
    also, missing where value is, are filled from the same cells.
    """
    values = [value, *also]
    own = df.select(*KEY, *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)], (F.lit(True) if where is None else where).alias("wanted"))
    vs = [f"v{i}" for i in range(len(values))]
    up, down = Window.partitionBy(RASTER, COL).orderBy(ROW), Window.partitionBy(RASTER, COL).orderBy(F.desc(ROW))
    held = F.when(F.col("v0").isNotNull(), F.struct(F.col(ROW).alias("at"), *vs))
    above, below = F.last(held, ignorenulls=True).over(up), F.last(held, ignorenulls=True).over(down)
    columns = own.withColumn("above", above).withColumn("below", below)
    nearer = F.when(F.col("below").isNull() | (F.col(ROW) - F.col("above.at") <= F.col("below.at") - F.col(ROW)), F.col("above")).otherwise(F.col("below"))
    columns = columns.withColumn("near", nearer).select(*KEY, *vs, (F.col("v0").isNull() & F.col("wanted")).alias("hole"), F.col("near.at").alias("at"), *[F.col(f"near.{v}").alias(f"near_{v}") for v in vs])
    ship(df.sparkSession)
    schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in KEY] + [f"{v} double" for v in vs])
    filled = columns.groupBy(RASTER, (F.col(ROW) - F.pmod(F.col(ROW), F.lit(ROWS_TOGETHER))).alias("block")).applyInPandas(_best_column, schema)
    filled = filled.select(*KEY, *[F.col(a).alias(b) for a, b in zip(vs, values, strict=True)])
    rest = [c for c in df.columns if c not in (*KEY, *values)]
    return (df.select(*KEY, *rest).join(filled, KEY) if rest else filled).select(*df.columns)


def _best_column(block: pd.DataFrame) -> pd.DataFrame:
    """Holes of some rows of a raster take the values of the nearest candidate among the columns of their row."""
    names = [c for c in block.columns if c.startswith("v")]
    out = []
    for _, row in block.groupby(ROW, sort=True):
        row = row.sort_values(COL)
        c, at = row[COL].to_numpy(np.int64), row["at"].to_numpy(float)
        v, near = row[names].to_numpy(float).copy(), row[[f"near_{n}" for n in names]].to_numpy(float)
        can = np.flatnonzero(~np.isnan(at))
        holes = np.flatnonzero(row["hole"].to_numpy(bool))
        if len(can) and len(holes):
            # Candidates in order of row, then column: the first of equal distance wins.
            can = can[np.lexsort((c[can], at[can]))]
            down = (at[can] - row[ROW].iloc[0]) ** 2
            step = max(1, PAIRS // len(can))
            for a in range(0, len(holes), step):
                h = holes[a : a + step]
                v[h] = near[can[((c[h, None] - c[None, can]) ** 2 + down[None, :]).argmin(axis=1)]]
        out.append(row[KEY].assign(**{n: v[:, i] for i, n in enumerate(names)}))
    return pd.concat(out)


def boundary_fill(df: DataFrame, value: str, inside: str) -> DataFrame:
    """NULLs inside the mask are filled by the nearest measured cell, those outside stay."""
    return nearest_fill(df, value, F.col(inside))


def hole_fill(df: DataFrame, value: str) -> DataFrame:
    """Missing areas that touch no edge of the raster are filled by the nearest measured cell, the outside stays missing."""
    holes = interior_holes(df, value).select(*KEY, F.lit(True).alias("__hole"))
    marked = df.join(holes, KEY, "left").withColumn("__hole", F.coalesce("__hole", F.lit(False)))
    return nearest_fill(marked, value, F.col("__hole")).drop("__hole")
