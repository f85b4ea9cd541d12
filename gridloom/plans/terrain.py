"""The whole way from an elevation raster to features, training rows and meadow probabilities, as lazily composed DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import missing, terrain
from gridloom.operators import boosting, focal, hydrology, metrics, ml, resample, sampling, tiled, zonal
from gridloom.operators.fill import median_fill, nearest_fill
from gridloom.operators.graph import checkpointed
from gridloom.schema import FEATURES, KEY, NODATA
from gridloom.sources import files


def twi_100m(dem: DataFrame, sca: DataFrame, z: str, area: str, spacing: float = 10.0, mask_nodata: bool = True) -> DataFrame:
    """Wetness at a tenth of the resolution, brought back to the cells of dem."""
    clean = dem.withColumn(z, missing.to_null(F.col(z), NODATA)) if mask_nodata else dem
    coarse = focal.with_gradient(resample.downsample(clean, z), z, spacing * 10)
    slope = coarse.select(*KEY, terrain.slope(F.col("dx"), F.col("dy")).alias("slope"))
    wet = resample.downsample(sca, area).join(slope, KEY).select(*KEY, terrain.twi(F.col(area), F.col("slope")).alias("twi_100m"))
    return resample.upsample(wet.withColumn("twi_100m", F.when(F.col("twi_100m") != NODATA, F.col("twi_100m"))), "twi_100m", dem)


def terrain_features(dem: DataFrame, z: str = "z", spacing: float = 10.0) -> DataFrame:
    """The focal features of a raster; where the elevation is missing they're NULL.  Gaps are filled by the nearest cell, or the median for the 5 by 5 and slope features."""
    known = dem.select(*KEY, F.col(z).isNotNull().alias("__known"))
    near = tiled.focal_features(nearest_fill(dem.select(*KEY, z), z), z, spacing, like=dem)
    middle = tiled.focal_features(median_fill(dem.select(*KEY, z), z), z, spacing, like=dem)
    by_median = ["slope", "elev_5x5_rel", "elev_5x5_std_dev"]
    both = checkpointed(near.drop(*by_median).join(middle.select(*KEY, *by_median), KEY).join(known, KEY))
    slopes = tiled.focal_features(both.select(*KEY, "slope"), "slope", spacing).select(*KEY, F.col("elev_5x5_std_dev").alias("slope_5x5_std_dev"), F.col("elev_std_9x9").alias("slope_std_9x9"))
    out = both.join(slopes, KEY)
    names = [c for c in out.columns if c not in (*KEY, "__known")]
    return out.select(*KEY, *[F.when(F.col("__known"), F.col(c)).alias(c) for c in names])


def hydrology_features(dem: DataFrame, z: str = "z", spacing: float = 10.0, stream_cells: int = 350, drain_step: float = 0.001) -> DataFrame:
    """filled, slp, sca, twi_10m and the three distances to streams."""
    filled = checkpointed(hydrology.pit_fill(dem.select(*KEY, z), z, drain_step))
    flow = hydrology.dinf(filled, "filled", spacing).withColumnRenamed("slope", "slp")
    sca = hydrology.dinf_area(flow, "angle", "slp", spacing)
    area = hydrology.d8_area(hydrology.d8(filled, "filled", spacing), edge_contamination=False)
    streams = hydrology.streams(area, "area", stream_cells)
    joined = checkpointed(filled.join(flow, KEY).join(streams, KEY).join(sca, KEY))
    distances = hydrology.fixed_distances(hydrology.distances_down(joined, "filled", "angle", "stream", spacing))
    wet = terrain.twi(missing.to_null(F.col("sca")), F.degrees(F.atan("slp"))).alias("twi_10m")
    return joined.select(*KEY, "filled", "slp", "sca", wet).join(distances, KEY)


def stacked(*layers: DataFrame) -> DataFrame:
    """Layers side by side; all are keyed alike, so each is dealt once."""
    out = layers[0]
    for x in layers[1:]:
        out = out.join(x, KEY)
    return out


def features(dem: DataFrame, soil: DataFrame | None = None, z: str = "z", spacing: float = 10.0) -> DataFrame:
    """The stack of a raster: all features that its inputs allow, in order."""
    clean = dem.select(*KEY, missing.to_null(F.col(z).cast("double"), NODATA).alias(z))
    water = checkpointed(hydrology_features(clean, z, spacing))
    coarse = twi_100m(water.select(*KEY, F.col("filled").alias(z)), water.select(*KEY, "sca"), z, "sca", spacing)
    layers = [terrain_features(water.select(*KEY, F.col("filled").alias(z)), z, spacing), water.drop("filled", "slp", "sca"), coarse]
    stack = stacked(*layers, *([soil] if soil is not None else []))
    return stack.select(*KEY, *[f for f in FEATURES if f in stack.columns])


def training_rows(stack: DataFrame, labels: DataFrame, seed: int = 42, **sizes) -> DataFrame:
    """A balanced sample of the valid labelled pixels of a stack."""
    names = [c for c in stack.columns if c not in KEY]
    valid = stack.filter(missing.valid_pixel([F.col(c) for c in names])).join(labels.select(*KEY, "label"), KEY)
    return sampling.balanced(valid, "label", seed, *KEY, **sizes)


def final_statistics(probabilities: DataFrame, by: list[str] | None = None) -> DataFrame:
    valid = ~missing.is_missing(F.col("probability"), NODATA)
    return zonal.meadow_summary(probabilities, "probability", valid, by=by)


def short_parameters(tuned: dict | None = None) -> dict:
    """The parameters of a quick trial: ten trees, else as tuned; without tuning trees of depth 4 at a rate of 0.1."""
    own = {"max_depth": 4.0, "learning_rate": 0.1} if tuned is None else {k: v for k, v in tuned.items() if k != "scale_pos_weight"}
    return files.DEFAULTS | own | {"n_estimators": 10.0}


def trained(rows: DataFrame, names: list[str], params: dict, key: list[str], path: str | None = None, seed: int = 42) -> tuple[boosting.Booster, DataFrame]:
    """Trees of the second order from three quarters of the labelled rows, and a row with the AUC and report of the rest.

    Positives weigh the training part's negatives to positives; with a path the model is saved there.
    """
    split = checkpointed(sampling.stratified_split(rows.select(*key, *names, "label"), "label", seed, *key))
    part = split.filter("is_train")
    ratio = metrics.class_weight(part, "label").first()["scale_pos_weight"]
    model = boosting.train(part, names, params | {"scale_pos_weight": float(ratio or 1.0)}, seed=seed)
    if path is not None:
        boosting.save(rows.sparkSession, model, path)
    return model, ml.evaluate(boosting.probability(model, split.filter("not is_train")))


def modelled(dem: DataFrame, labels: DataFrame, params: dict, soil: DataFrame | None = None, spacing: float = 10.0, path: str | None = None, seed: int = 42, **sizes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From elevation and labels to (probabilities of all cells, the held-out evaluation, the summary of the probabilities).

    sizes are those of the balanced sample.
    """
    stack = checkpointed(features(dem, soil, spacing=spacing))
    names = [f for f in FEATURES if f in stack.columns]
    model, report = trained(training_rows(stack, labels, seed, **sizes), names, params, KEY, path, seed)
    probabilities = checkpointed(ml.predict_raster(model, stack, names))
    return probabilities, report, final_statistics(probabilities)


def predict_each(spark, model, stacks: Iterable[tuple[str, Callable[[], DataFrame]]], names: list[str], path: str) -> list[tuple[str, str, float, str]]:
    """Writes the probabilities of each named stack below path; one that fails is reported and the rest go on."""
    run = lambda name, stack: lambda: files.write_single_band(ml.predict_raster(model, stack(), names), "probability", f"{path}/{name}")
    return batch(spark, [(name, run(name, stack)) for name, stack in stacks])


def step(spark, name: str, action: Callable[[], object]) -> tuple[str, str, float, str]:
    """(name, status, seconds, error) of a step; its jobs run as a group of that name."""
    began = time.time()
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
        return name, "SUCCESS", time.time() - began, ""
    except Exception as e:  # the error is the step's result: later steps and other rasters go on
        return name, "FAILED", time.time() - began, f"{type(e).__name__}: {e}"[:500]


def batch(spark, steps: Iterable[tuple[str, Callable[[], object]]], keep_going: bool = True) -> list[tuple[str, str, float, str]]:
    """The results of steps in turn; after a failure the rest is skipped, unless they keep going."""
    out, failed = [], False
    for name, action in steps:
        out.append((name, "SKIPPED", 0.0, "") if failed and not keep_going else step(spark, name, action))
        failed |= out[-1][1] == "FAILED"
    return out
