"""Polygons: boxes, containment, and their rasters.

A polygon is a row (poly_id, ..., ring array<struct<x, y>>), its ring closed or not.  Joins with points and cells are
equi-joins on square buckets of the plane, with exact tests behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.focal import along_col, along_row
from gridloom.schema import KEY, RASTER, REGION


def envelope(ring: Column) -> Column:
    """xmin, ymin, xmax, ymax."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def total_envelope(polygons: DataFrame, *by: str) -> DataFrame:
    e = polygons.select(*by, envelope(F.col("ring")).alias("e"))
    return e.groupBy(*by).agg(F.min("e.xmin").alias("xmin"), F.min("e.ymin").alias("ymin"), F.max("e.xmax").alias("xmax"), F.max("e.ymax").alias("ymax"))


def area(ring: Column) -> Column:
    """By the shoelace formula."""
    following = lambda i: F.get(ring, (i + 1) % F.size(ring))
    crossed = F.transform(ring, lambda p, i: p["x"] * following(i)["y"] - following(i)["x"] * p["y"])
    return F.abs(F.aggregate(crossed, F.lit(0.0), lambda s, v: s + v)) / 2


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right of a point crosses the ring an odd number of times."""

    def crosses(p: Column, i: Column) -> Column:
        q = F.get(ring, (i + 1) % F.size(ring))
        apart = (p["y"] > y) != (q["y"] > y)
        rise = F.when(q["y"] == p["y"], F.lit(1.0)).otherwise(q["y"] - p["y"])
        return (apart & (x < (q["x"] - p["x"]) * (y - p["y"]) / rise + p["x"])).cast("int")

    return F.aggregate(F.transform(ring, crosses), F.lit(0), lambda s, v: s + v) % 2 == 1


def boxes_touch(a: Column, b: Column) -> Column:
    return (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])


def in_box(e: Column, west: float, south: float, east: float, north: float, pad: float = 0.0) -> Column:
    """Whether an envelope meets a box, padded."""
    return (e["xmin"] <= east + pad) & (e["xmax"] >= west - pad) & (e["ymin"] <= north + pad) & (e["ymax"] >= south - pad)


def in_region(e: Column) -> Column:
    return in_box(e, *REGION)


#: Whether a state's layer is needed for latitudes from low to high, which may be columns; the layers overlap (fixed values).
STATES = {"OR": lambda low, high: high >= 42.0, "CA": lambda low, high: low < 42.5}


def states_needed(min_lat: float, max_lat: float) -> list[str]:
    """The state layers that a raster's latitudes need; the layers overlap."""
    return [name for name, needed in STATES.items() if needed(min_lat, max_lat)]


def _buckets(polygons: DataFrame, side: float) -> DataFrame:
    """polygons, once for each square bucket that its envelope meets."""
    e = envelope(F.col("ring"))
    steps = lambda low, high: F.sequence(F.floor(e[low] / side), F.floor(e[high] / side))
    return polygons.withColumn("bx", F.explode(steps("xmin", "xmax"))).withColumn("by", F.explode(steps("ymin", "ymax")))


def joined_points(points: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """Points (with x, y) and the polygons that contain them."""
    placed = points.withColumn("bx", F.floor(F.col("x") / side)).withColumn("by", F.floor(F.col("y") / side))
    return placed.join(_buckets(polygons, side), ["bx", "by"]).filter(contains(F.col("ring"), F.col("x"), F.col("y"))).drop("bx", "by")


def first_polygon(points: DataFrame, polygons: DataFrame, key: str, name: str, side: float) -> DataFrame:
    """points with the least name of the polygons that contain them, and how many do; NULL and 0 outside."""
    found = joined_points(points, polygons, side).groupBy(key).agg(F.min(name).alias(name), F.count(F.lit(1)).alias("polygons"))
    return points.join(found, key, "left").withColumn("polygons", F.coalesce("polygons", F.lit(0)))


def intersecting(a: DataFrame, b: DataFrame, side: float) -> DataFrame:
    """Pairs of polygons (poly_id, other_id) whose envelopes meet."""
    left = _buckets(a, side).select("bx", "by", "poly_id", envelope(F.col("ring")).alias("e"))
    right = _buckets(b, side).select("bx", "by", F.col("poly_id").alias("other_id"), envelope(F.col("ring")).alias("f"))
    return left.join(right, ["bx", "by"]).filter(boxes_touch(F.col("e"), F.col("f"))).select("poly_id", "other_id").distinct()


def runs(polygons: DataFrame, height: int, width: int) -> DataFrame:
    """(poly_id, r, c_start, c_end) of the cells whose centres (c + 1/2, r + 1/2) lie in a polygon, by scan lines in pixel space; raster_id too, if polygons have it."""
    own = ["poly_id", *[c for c in (RASTER,) if c in polygons.columns]]
    e = envelope(F.col("ring"))
    first, last = F.greatest(F.ceil(e["ymin"] - 0.5), F.lit(0)), F.least(F.floor(e["ymax"] - 0.5), F.lit(height - 1))
    lines = polygons.filter(last >= first).select(*own, "ring", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("r"))
    ring, y = F.col("ring"), F.col("r") + 0.5
    following = lambda i: F.get(ring, (i + 1) % F.size(ring))

    def crossing(p: Column, i: Column) -> Column:
        q = following(i)
        return F.when((p["y"] > y) != (q["y"] > y), (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])

    lines = lines.withColumn("x", F.sort_array(F.array_compact(F.transform(ring, crossing))))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("x") / 2).cast("int") - 1), lambda k: F.struct(F.get("x", 2 * k).alias("a"), F.get("x", 2 * k + 1).alias("b")))
    found = lines.filter(F.size("x") >= 2).select(*own, "r", F.explode(pairs).alias("p"))
    start, end = F.greatest(F.ceil(F.col("p.a") - 0.5), F.lit(0)), F.least(F.ceil(F.col("p.b") - 0.5) - 1, F.lit(width - 1))
    return found.select(*own, "r", start.cast("int").alias("c_start"), end.cast("int").alias("c_end")).filter("c_end >= c_start")


def rasterised(grid: DataFrame, polygons: DataFrame, height: int, width: int) -> DataFrame:
    """The cells of grid with label 1 inside any polygon, else 0; polygons with a raster_id belong to that raster only, others to all."""
    key = KEY if RASTER in polygons.columns else ["r", "c"]
    cells = runs(polygons, height, width).withColumn("c", F.explode(F.sequence("c_start", "c_end"))).select(*key).distinct()
    return grid.select(*KEY).join(cells.withColumn("label", F.lit(1)), key, "left").select(*KEY, F.coalesce("label", F.lit(0)).alias("label"))


def outlined(labels: DataFrame) -> DataFrame:
    """Cells of label 1 with a neighbour, up, down, left or right, that isn't."""
    near = [f("label").over(w()) for f in (F.lag, F.lead) for w in (along_row, along_col)]
    edge = near[0].isNull()
    for x in near:
        edge = edge | F.coalesce(x != 1, F.lit(True))
    return labels.withColumn("__edge", edge).filter("label = 1 and __edge").select(*KEY)


def clipped(df: DataFrame, zone_cells: DataFrame) -> DataFrame:
    """The cells of df that are in a zone."""
    return df.join(zone_cells.select(*KEY).distinct(), KEY, "left_semi")


def dissolved(zone_cells: DataFrame, by: str) -> DataFrame:
    """Distinct cells of the zones of each value of by."""
    return zone_cells.select(by, *KEY).distinct()


def prefix_filter(attribute: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether an attribute starts with any prefix; NULL doesn't."""
    out = F.lit(False)
    for p in prefixes:
        out = out | attribute.startswith(p)
    return attribute.isNotNull() & out


def as_geojson(polygons: DataFrame, *properties: str) -> DataFrame:
    """One GeoJSON feature as text for each polygon."""
    ring = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat(ring, F.slice(ring, 1, 1))).alias("coordinates"))
    return polygons.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))
