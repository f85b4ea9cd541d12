"""Raster operators against numpy on the grids of the fixtures, with gaps, edges and ties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import crs, display, missing, terrain
from gridloom.operators import components, fill, focal, hydrology, resample, tiled
from gridloom.plans import terrain as plan
from gridloom.schema import FEATURES, KEY, NODATA


def frame(spark, *arrays, names=("z",)):
    rows = []
    h, w = arrays[0].shape
    for r in range(h):
        for c in range(w):
            rows.append(("a", r, c, *[None if np.isnan(x[r, c]) else float(x[r, c]) for x in arrays]))
    return spark.createDataFrame(rows, "raster_id string, r int, c int, " + ", ".join(f"{n} double" for n in names))


def matrix(df, value):
    return df.toPandas().pivot(index="r", columns="c", values=value).to_numpy(float)


@pytest.fixture(scope="module")
def dem():
    r = np.random.default_rng(42)
    y, x = np.mgrid[0:1:30j, 0:1:30j]
    return 1200 + 300 * x + 200 * y + 20 * r.normal(size=(30, 30))


@pytest.fixture(scope="module")
def gaps(dem):
    out = dem.copy()
    out[np.random.default_rng(3).random(dem.shape) < 0.3] = np.nan
    return out


@pytest.fixture(scope="module")
def cells(spark, dem):
    return frame(spark, dem).cache()


@pytest.mark.parametrize("k", [3, 5, 9, 11, 21])
def test_boxes(cells, dem, k):
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(dem, k // 2, mode="symmetric"), (k, k))
    found = focal.box_statistics(cells, "z", k)
    assert np.abs(matrix(found, "mean") - windows.mean((2, 3))).max() < 1e-8
    assert np.abs(matrix(found, "std") - windows.std((2, 3))).max() < 1e-4


def test_boxes_commute_with_transposition(spark, dem, cells):
    other = focal.box_statistics(frame(spark, dem.T.copy()), "z", 5)
    assert np.allclose(matrix(other, "mean").T, matrix(focal.box_statistics(cells, "z", 5), "mean"))


def test_gradient_and_curvature(cells, dem):
    gy, gx = np.gradient(dem, 10.0)
    found = focal.with_second_derivatives(cells, "z", 10.0).cache()
    assert (matrix(found, "dx") == gx).all() and (matrix(found, "dy") == gy).all()
    zxy, zxx = np.gradient(gx, 10.0)
    assert np.allclose(matrix(found, "zxx"), zxx) and np.allclose(matrix(found, "zxy"), zxy)


def test_plane_has_constant_slope_and_no_curvature(spark):
    y, x = np.mgrid[0:12, 0:9]
    found = focal.with_second_derivatives(frame(spark, 3.0 * x + 4.0 * y), "z", 1.0)
    parts = [F.col(n) for n in ("dx", "dy", "zxx", "zxy", "zyy")]
    out = found.select(terrain.slope(*parts[:2]).alias("s"), terrain.profile_curvature(*parts).alias("p"), terrain.plan_curvature(*parts).alias("q")).toPandas()
    assert np.allclose(out.s, math.degrees(math.atan(5))) and np.allclose(out[["p", "q"]], 0)


def test_flat_ground_keeps_aspect_defined(spark):
    found = focal.with_gradient(frame(spark, np.ones((4, 4))), "z", 1.0).select(terrain.aspect(F.col("dx"), F.col("dy")).alias("a"))
    assert {r.a for r in found.collect()} <= {0.0, 180.0}


def test_constant_has_no_tpi_and_one_row_works(spark):
    assert np.allclose(matrix(focal.box_statistics(frame(spark, np.full((11, 11), 7.0)), "z", 21), "mean"), 7)
    line = focal.with_gradient(frame(spark, np.array([[1.0, 2.0, 4.0]])), "z", 1.0)
    assert matrix(line, "dx").tolist() == [[1.0, 1.5, 2.0]]


def test_tri(cells, dem):
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(dem, 1, mode="reflect"), (3, 3))
    assert np.allclose(matrix(focal.tri(cells, "z"), "tri"), np.abs(windows - dem[:, :, None, None]).sum((2, 3)))


def test_tiles_equal_windows(cells, dem):
    found = tiled.focal_features(cells, "z", 10.0, tile=13).cache()
    assert found.count() == dem.size
    for k, name in ((3, "tpi_3x3"), (11, "tpi_11x11"), (21, "tpi_21x21")):
        assert np.allclose(matrix(found, name), dem - matrix(focal.box_statistics(cells, "z", k), "mean"))
    assert np.allclose(matrix(found, "elev_std_9x9"), matrix(focal.box_statistics(cells, "z", 9), "std"), atol=1e-4)
    assert np.allclose(matrix(found, "tri"), matrix(focal.tri(cells, "z"), "tri"))


SIDES = [(h, w) for h in range(1, 13) for w in (1, 2, 3, 7, 12)]


@pytest.fixture(scope="module")
def small(spark):
    """Rasters with sides of 1 to 12 cells, by name, and their cells."""
    random = np.random.default_rng(3)
    rasters = {f"{h}x{w}": random.normal(100, 10, (h, w)) for h, w in SIDES}
    rows = [(name, r, c, float(z[r, c])) for name, z in rasters.items() for r in range(z.shape[0]) for c in range(z.shape[1])]
    return rasters, spark.createDataFrame(rows, "raster_id string, r int, c int, z double").cache()


@pytest.mark.parametrize("k", [3, 5, 9, 11, 21])
def test_boxes_of_rasters_smaller_than_the_box(small, k):
    """Mirrored as often as the box needs, as numpy pads."""
    rasters, df = small
    got = {(x.raster_id, x.r, x.c): (x["mean"], x["std"]) for x in focal.box_statistics(df, "z", k).collect()}
    for name, z in rasters.items():
        boxes = np.lib.stride_tricks.sliding_window_view(np.pad(z, k // 2, mode="symmetric"), (k, k))
        found = np.array([[got[name, r, c] for c in range(z.shape[1])] for r in range(z.shape[0])])
        assert np.allclose(found[..., 0], boxes.mean(axis=(2, 3))) and np.allclose(found[..., 1], boxes.std(axis=(2, 3)), atol=1e-5)


def test_tiled_features_of_rasters_smaller_than_the_box(small):
    rasters, df = small
    got = {(x.raster_id, x.r, x.c): (x.tpi_21x21, x.elev_std_9x9, x.tri) for x in tiled.focal_features(df, "z").collect()}
    for name, z in rasters.items():
        box = lambda k: np.lib.stride_tricks.sliding_window_view(np.pad(z, k // 2, mode="symmetric"), (k, k))  # noqa: B023, E731
        near = np.lib.stride_tricks.sliding_window_view(np.pad(z, 1, mode="reflect"), (3, 3))
        found = np.array([[got[name, r, c] for c in range(z.shape[1])] for r in range(z.shape[0])])
        assert np.allclose(found[..., 0], z - box(21).mean(axis=(2, 3))) and np.allclose(found[..., 1], box(9).std(axis=(2, 3)), atol=1e-5)
        assert np.allclose(found[..., 2], np.abs(near - z[..., None, None]).sum(axis=(2, 3)))


def test_interior(spark, gaps):
    k = 5
    ok = np.pad(~np.isnan(gaps), k // 2, constant_values=False)
    expected = np.lib.stride_tricks.sliding_window_view(ok, (k, k)).all((2, 3))
    assert (matrix(focal.interior(frame(spark, gaps), "z", k), "interior") == expected).all()


def test_nearest_fill(spark, gaps):
    points = np.argwhere(~np.isnan(gaps))
    expected = gaps.copy()
    for i, j in np.argwhere(np.isnan(gaps)):
        far = ((points - [i, j]) ** 2).sum(1)
        a, b = points[np.lexsort((points[:, 1], points[:, 0], far))[0]]
        expected[i, j] = gaps[a, b]
    filled = fill.nearest_fill(frame(spark, gaps), "z")
    assert (matrix(filled, "z") == expected).all() and filled.columns == [*KEY, "z"]
    inside = frame(spark, gaps).withColumn("inside", F.col("r") < 10)
    some = matrix(fill.boundary_fill(inside, "z", "inside"), "z")
    assert (some[:10] == expected[:10]).all() and np.isnan(some[10:]).sum() == np.isnan(gaps[10:]).sum()


def test_fills_of_nothing(spark):
    empty = frame(spark, np.full((3, 4), np.nan))
    assert np.isnan(matrix(fill.nearest_fill(empty, "z"), "z")).all()
    assert fill.median_fill(empty, "z").filter("z is not null").count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 10, 5000, 5001])
def test_medians_are_exact(spark, n):
    r = np.random.default_rng(n)
    for values in (r.normal(size=n), r.integers(0, 3, n).astype(float), np.full(n, 2.0)):
        df = spark.createDataFrame([("a", i, 0, float(v)) for i, v in enumerate(values)] + [("a", n, 0, None), ("b", 0, 0, None)], "raster_id string, r int, c int, z double")
        assert {x.raster_id: x.median for x in fill.medians(df, "z").collect()} == {"a": pytest.approx(np.median(values), abs=0, rel=1e-15)}
        assert fill.median_fill(df, "z").filter("z is null").collect()[0].raster_id == "b"


def areas(mask):
    label, h, w = np.full(mask.shape, -1), *mask.shape
    for i, j in np.argwhere(mask):
        if label[i, j] < 0:
            stack = [(i, j)]
            label[i, j] = i * w + j
            while stack:
                a, b = stack.pop()
                for x, y in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                    if 0 <= x < h and 0 <= y < w and mask[x, y] and label[x, y] < 0:
                        label[x, y] = i * w + j
                        stack.append((x, y))
    return label


def test_components_and_holes(spark, gaps):
    missing_cells = np.isnan(gaps)
    label = areas(missing_cells)
    found = components.labelled(frame(spark, gaps), F.col("z").isNull()).collect()
    assert len(found) == missing_cells.sum() and all(label[x.r, x.c] == x.comp_id for x in found)
    edge = set(label[0]) | set(label[-1]) | set(label[:, 0]) | set(label[:, -1])
    inner = {(i, j) for i, j in np.argwhere(missing_cells) if label[i, j] not in edge}
    assert {(x.r, x.c) for x in components.interior_holes(frame(spark, gaps), "z").collect()} == inner
    filled = matrix(fill.hole_fill(frame(spark, gaps), "z"), "z")
    assert np.isnan(filled).sum() == missing_cells.sum() - len(inner)


def test_diagonal_cells_are_apart(spark):
    z = np.ones((4, 4))
    z[1, 1] = z[2, 2] = np.nan
    assert components.area_sizes(frame(spark, z), F.col("z").isNull()).count() == 2


def test_missing_encodings(spark):
    values = [None, float("nan"), float("inf"), -float("inf"), 3e34, -3.4e38, NODATA, 0.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.x for r in df.select(missing.to_null(F.col("v"), NODATA).alias("x")).collect()] == [None] * 7 + [0.0, 5.0]
    once = df.select(missing.fix_nodata(F.col("v"), NODATA, NODATA).alias("v"))
    assert [r.v for r in once.collect()] == [NODATA] * 7 + [0.0, 5.0]
    valid = [r.x for r in df.select(missing.valid_pixel([F.col("v")]).alias("x")).collect()]
    assert [bool(x) for x in valid] == [False, False, False, False, True, False, True, True, True]


def test_wetness(spark):
    df = spark.createDataFrame([(10.0, 45.0), (10.0, 0.0), (0.0, 10.0), (-1.0, 10.0), (None, 10.0)], "a double, s double")
    out = [r.t for r in df.select(terrain.twi(F.col("a"), F.col("s")).alias("t")).collect()]
    assert out[0] == pytest.approx(math.log(10)) and out[1] == pytest.approx(math.log(10 / 0.001)) and out[2:] == [NODATA] * 3


def test_resampling_keeps_constants(spark):
    flat = frame(spark, np.full((25, 33), 4.0))
    small = resample.downsample(flat, "z")
    assert matrix(small, "z").shape == (2, 3) and np.allclose(matrix(small, "z"), 4)
    assert np.allclose(matrix(resample.upsample(small, "z", flat), "z"), 4)
    x = np.mgrid[0:20, 0:20][1].astype(float)
    points = frame(spark, x).select(*KEY, (F.col("r") + 0.0).alias("fr"), (F.col("c") + 0.5).alias("fc")).filter("c between 2 and 16 and r between 2 and 16")
    for kernel in ("bilinear", "bicubic"):
        out = resample.sampled(frame(spark, x), "z", points, kernel).toPandas()
        assert np.allclose(out.z, out.c + 0.5)


def test_reprojection_onto_itself(spark, cells, dem):
    meta = {"srid": 32610, "transform": (10.0, 0.0, 500000.0, 0.0, -10.0, 4650300.0)}
    assert np.allclose(matrix(resample.reprojected(cells, "z", meta, cells, meta), "z"), dem)


def test_projections_round_trip(spark):
    df = spark.createDataFrame([(-122.5, 42.3), (-123.9, 41.2), (-120.6, 44.4)], "lon double, lat double")
    for code in (5070, 32610):
        x, y = crs.transformed(F.col("lon"), F.col("lat"), 4326, code)
        there = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = crs.transformed(F.col("x"), F.col("y"), code, 4326)
        for r in there.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
            assert r.a == pytest.approx(r.lon, abs=1e-7) and r.b == pytest.approx(r.lat, abs=1e-7)
    x, y = crs.utm(F.lit(-123.0), F.lit(0.0))
    assert df.select(x.alias("x"), y.alias("y")).first() == (pytest.approx(500000.0), pytest.approx(0.0, abs=1e-6))


def test_albers_at_and_past_the_poles(spark):
    points = [(-124.0, 90.0), (56.0, 90.0), (-124.0, -90.0), (-124.0, 89.98), (-124.0, 90.02), (-124.0, 97.0), (-96.0, -91.0)]
    x, y = crs.transformed(F.col("lon"), F.col("lat"), 4326, 5070)
    there = spark.createDataFrame(points, "lon double, lat double").select("lon", "lat", x.alias("x"), y.alias("y"))
    for r in there.select("*", *[v.alias(k) for k, v in zip("ab", crs.transformed(F.col("x"), F.col("y"), 5070, 4326), strict=True)]).collect():
        if abs(r.lat) <= 90:
            assert r.a == pytest.approx(r.lon, abs=1e-9) and r.b == pytest.approx(r.lat, abs=4e-6)
        else:  # no such point: not that of 180 - lat
            assert (r.x, r.y, r.a, r.b) == (None,) * 4
    # Metres inside the arc of the pole, outside the other's, and none.
    off = spark.createDataFrame([(0.0, crs._albers()[3]), (3e7, 0.0), (float("nan"), 0.0), (None, 0.0)], "x double, y double")
    assert all(tuple(r) == (None, None) for r in off.select(*crs.from_albers(F.col("x"), F.col("y"))).collect())


def test_latitudes_counted_on_past_poles(spark):
    expected = {(-124.0, 41.0): (-124.0, 41.0), (-124.0, 90.0): (-124.0, 90.0), (-124.0, 97.0): (56.0, 83.0), (56.0, 97.0): (-124.0, 83.0), (-124.0, 184.0): (56.0, -4.0), (-124.0, 271.0): (-124.0, -89.0), (-124.0, -97.0): (56.0, -83.0), (10.0, 401.0): (10.0, 41.0)}
    lon, lat = F.col("lon"), F.col("lat")
    df = spark.createDataFrame(list(expected), "lon double, lat double").withColumn("turns", crs.half_turns(lat))
    df = df.select("*", *[v.alias(k) for k, v in zip("ab", crs.on_globe(lon, lat, F.col("turns")), strict=True)])
    rows = df.select("*", *[v.alias(k) for k, v in zip("de", crs.counted_on(F.col("a"), F.col("b"), F.col("turns")), strict=True)]).collect()
    assert len(rows) == len(expected) and all((r.a, r.b) == expected[r.lon, r.lat] and (r.d, r.e) == (r.lon, r.lat) for r in rows)


def drains(z):
    """Whether each cell reaches the edge without ascending."""
    h, w = z.shape
    ok = np.zeros(z.shape, bool)
    ok[[0, -1]] = ok[:, [0, -1]] = True
    while True:
        new = ok.copy()
        for a, b in hydrology.STEPS:
            rows, cols = slice(max(-a, 0), h - max(a, 0)), slice(max(-b, 0), w - max(b, 0))
            to = (slice(max(a, 0), h + min(a, 0)), slice(max(b, 0), w + min(b, 0)))
            new[rows, cols] |= ok[to] & (z[rows, cols] >= z[to])
        if (new == ok).all():
            return ok
        ok = new


def test_pit_fill(spark, dem, cells):
    filled = matrix(hydrology.pit_fill(cells, "z"), "filled")
    assert (filled >= dem).all() and drains(filled).all()
    w = np.where(np.pad(np.zeros((28, 28), bool), 1, constant_values=True), dem, np.inf)
    for _ in range(200):  # the least such surface, by relaxation
        around = np.min([np.pad(w, 1, constant_values=np.inf)[1 + a : 31 + a, 1 + b : 31 + b] for a, b in hydrology.STEPS], axis=0)
        w = np.where(np.isfinite(w) & (w == dem), w, np.maximum(dem, np.minimum(w, around)))
    assert np.allclose(filled, w)


def test_all_flow_ends_in_sinks(spark, cells, dem):
    flow = hydrology.d8(cells, "z").cache()
    area = hydrology.d8_area(flow, edge_contamination=False)
    both = flow.join(area, KEY).toPandas()
    assert both[both.direction == 0].area.sum() == dem.size and both.area.min() == 1
    sca = hydrology.dinf_area(hydrology.dinf(cells, "z"), edge_contamination=False).toPandas()
    assert sca.sca.min() == pytest.approx(10.0)
    tainted = hydrology.d8_area(flow).filter("area is not null").toPandas()
    assert len(tainted) < dem.size and tainted.r.between(1, 28).all()


def test_tiles_with_borders_equal_one_tile(spark, gaps):
    """Flow over many tile borders, with gaps: the same as in one tile."""
    df = frame(spark, gaps).cache()
    for step in (0.0, 0.01):
        whole, parts = (matrix(hydrology.pit_fill(df, "z", step, tile), "filled") for tile in (1024, 7))
        assert np.allclose(whole, parts, equal_nan=True) and (np.isnan(whole) == np.isnan(gaps)).all()
    filled = hydrology.pit_fill(df, "z", 0.01).withColumnRenamed("filled", "z").cache()
    flow = hydrology.dinf(filled, "z").cache()
    d8 = hydrology.d8(filled, "z").cache()
    for edge in (False, True):
        for f, df_, name in ((hydrology.dinf_area, flow, "sca"), (hydrology.d8_area, d8, "area")):
            whole, parts = (matrix(f(df_, edge_contamination=edge, tile=tile), name) for tile in (1024, 7))
            assert np.allclose(whole, parts, equal_nan=True)
    streams = hydrology.streams(hydrology.d8_area(d8, edge_contamination=False), "area", 20)
    joined = filled.join(flow.drop("slope"), KEY).join(streams, KEY).cache()
    for name in ("dd_s", "dd_h", "dd_v"):
        whole, parts = (matrix(hydrology.distances_down(joined, "z", "angle", "stream", tile=tile), name) for tile in (1024, 7))
        assert np.allclose(whole, parts, equal_nan=True) and (~np.isnan(whole)).sum() > 30


def test_distance_down_a_ramp(spark):
    z = np.repeat(np.arange(8.0)[None, :] * 10, 5, axis=0)
    df = frame(spark, z)
    flow = hydrology.dinf(df, "z").drop("slope").withColumn("stream", (F.col("c") == 0).cast("int"))
    out = hydrology.distances_down(df.join(flow, KEY), "z", "angle", "stream")
    assert np.allclose(matrix(out, "dd_h"), np.arange(8) * 10.0) and np.allclose(matrix(out, "dd_v"), z)
    assert np.allclose(matrix(out, "dd_s"), np.arange(8) * math.hypot(10, 10))


def test_feature_stack(spark, gaps):
    stack = plan.features(frame(spark, gaps))
    assert [c for c in stack.columns if c not in KEY] == [f for f in FEATURES if not f.startswith("soil")]
    assert stack.count() == gaps.size


def test_display(spark):
    df = spark.createDataFrame([(0.123, 0.2), (None, 0.0), (1.0, -0.1)], "p double, o double")
    rows = df.select(display.percent(F.col("p")).alias("p"), display.signed_percent(F.col("o")).alias("o"), display.elapsed(F.lit(125)).alias("e"), display.coordinate(F.lit(1.5)).alias("x")).collect()
    assert [tuple(r) for r in rows] == [("12.3%", "+20% wetter", "2m 5s", "1.50000"), ("No data", "Baseline", "2m 5s", "1.50000"), ("100.0%", "-10% drier", "2m 5s", "1.50000")]


def test_from_elevation_to_report(spark, cells, dem):
    labels = cells.select(*KEY, (F.col("z") > float(np.quantile(dem, 0.7))).cast("int").alias("label"))
    found, report, summary = plan.modelled(cells, labels, plan.short_parameters() | {"n_estimators": 3.0})
    assert found.count() == dem.size and found.filter("probability is not null and not probability between 0 and 1").count() == 0
    assert found.filter("probability is not null").count() > dem.size / 2
    assert report.first().auc > 0.9 and summary.count() == 1
