"""Connected areas of equal state in rasters: runs along rows are nodes, touching runs of neighbouring rows are edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.focal import along_col, along_row, with_size
from gridloom.operators.graph import components
from gridloom.schema import COL, KEY, RASTER, ROW


def labelled(df: DataFrame, member: Column) -> DataFrame:
    """The cells of member, each with comp_id: the first cell (r, c), by row, of the area that it is 4-connected to."""
    cells = with_size(df.withColumn("__in", member))
    starts = F.col("__in") & ~F.coalesce(F.lag("__in").over(along_row()), F.lit(False))
    place = F.col(ROW).cast("long") * F.col("n_c") + F.col(COL)
    # A run is known by the place of its first cell.
    run = F.last(F.when(starts, place), ignorenulls=True).over(along_row())
    runs = cells.withColumn("__run", F.when(F.col("__in"), run))
    above = F.lag("__run").over(along_col())
    name = lambda x: F.struct(F.col(RASTER), x.alias("place"))
    edges = runs.withColumn("__above", above).filter("__run is not null and __above is not null").select(name(F.col("__run")).alias("a"), name(F.col("__above")).alias("b")).distinct()
    roots = components(edges).select(F.col(f"node.{RASTER}").alias(RASTER), F.col("node.place").alias("__run"), F.col("root.place").alias("__root"))
    found = runs.filter("__in").join(roots, [RASTER, "__run"], "left")
    return found.select(*KEY, F.coalesce("__root", "__run").alias("comp_id"))


def exterior(df: DataFrame, value: str) -> DataFrame:
    """(raster_id, comp_id) of the missing areas that touch an edge."""
    return _marked(df, value).filter("edge").select(RASTER, "comp_id").distinct()


def interior_holes(df: DataFrame, value: str) -> DataFrame:
    """The missing cells, with comp_id, of areas that touch no edge of their raster."""
    marked = _marked(df, value)
    outside = marked.groupBy(RASTER, "comp_id").agg(F.max("edge").alias("outside"))
    return marked.select(*KEY, "comp_id").join(outside.filter("outside"), [RASTER, "comp_id"], "left_anti").select(*KEY, "comp_id")


def _marked(df: DataFrame, value: str) -> DataFrame:
    cells = with_size(labelled(df.select(*KEY, value), F.col(value).isNull()).join(df.select(*KEY), KEY, "right"))
    edge = (F.col(ROW) == 0) | (F.col(COL) == 0) | (F.col(ROW) == F.col("n_r") - 1) | (F.col(COL) == F.col("n_c") - 1)
    return cells.filter("comp_id is not null").select(*KEY, "comp_id", edge.alias("edge"))


def area_sizes(df: DataFrame, member: Column) -> DataFrame:
    """Cells of each area."""
    return labelled(df, member).groupBy(RASTER, "comp_id").agg(F.count(F.lit(1)).alias("cells"))
