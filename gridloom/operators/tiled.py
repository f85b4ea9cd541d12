"""Focal features on tiles with a halo: one shuffle for all features, array code inside, for rasters of millions of cells.

Cells are sent to their tile and, near its border, to the neighbours that see them; each tile computes all features of its own
cells at once.  The results equal those of the window operators in gridloom.operators.focal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.focal import with_size
from gridloom.schema import COL, KEY, RASTER, ROW
from gridloom.ship import ship

TILE = 256
#: The widest box is 21 by 21; gradients of gradients reach 2.
HALO = 10
NAMES = ["slope", "elev_5x5_rel", "elev_5x5_std_dev", "aspect", "curvature_profile", "curvature_plan", "tpi_3x3", "tpi_11x11", "tpi_21x21", "tri", "elev_std_3x3", "elev_std_9x9"]


def box_mean(z: np.ndarray, k: int) -> np.ndarray:
    """Means of k by k boxes whose whole lies in the array; the rest is cut off."""
    for axis in (0, 1):
        sums = np.cumsum(np.concatenate((np.zeros_like(np.take(z, [0], axis)), z), axis), axis)
        z = (np.take(sums, range(k, sums.shape[axis]), axis) - np.take(sums, range(sums.shape[axis] - k), axis)) / k
    return z


def gradient(z: np.ndarray, spacing: float) -> list[np.ndarray]:
    """Derivatives along rows and columns of cells; zero along an axis of one cell."""
    return [np.gradient(z, spacing, axis=k) if z.shape[k] > 1 else np.zeros_like(z) for k in (0, 1)]


def edge_aware(block: np.ndarray, top: int, left: int, height: int, width: int, at: tuple[int, int, int, int], spacing: float) -> dict[str, np.ndarray]:
    """Features of the cells at (first row, first column, rows, columns) of a raster of height by width, from a block at (top, left)."""
    r0, c0, n_r, n_c = at

    def cut(reach: int, mode: str) -> np.ndarray:
        """The cells with reach more on each side, mirrored beyond the raster, again and again if it's smaller."""

        def index(first: int, n: int, size: int) -> np.ndarray:
            i = np.arange(first - reach, first + n + reach)
            period = 2 * size if mode == "symmetric" else max(2 * size - 2, 1)
            i %= period
            return np.minimum(i, period - 1 - i if mode == "symmetric" else (period - i) % period if size > 1 else i)

        return block[np.ix_(index(r0, n_r, height) - top, index(c0, n_c, width) - left)]

    shift = float(block[r0 - top, c0 - left])  # keeps sums of squares small
    z = block[r0 - top : r0 - top + n_r, c0 - left : c0 - left + n_c]
    means = {k: box_mean(cut(k // 2, "symmetric") - shift, k) + shift for k in (3, 5, 9, 11, 21)}
    squares = {k: box_mean((cut(k // 2, "symmetric") - shift) ** 2, k) for k in (3, 5, 9)}
    std = {k: np.sqrt(np.maximum(squares[k] - (means[k] - shift) ** 2, 0)) for k in squares}

    lo_r, lo_c = max(r0 - 2, 0), max(c0 - 2, 0)
    hi_r, hi_c = min(r0 + n_r + 2, height), min(c0 + n_c + 2, width)
    part = block[lo_r - top : hi_r - top, lo_c - left : hi_c - left]
    own = (slice(r0 - lo_r, r0 - lo_r + n_r), slice(c0 - lo_c, c0 - lo_c + n_c))
    # One-sided at the raster's edges; within it, the outermost cells of the part are wrong and lie outside own.
    zy, zx = gradient(part, spacing)
    zxy, zxx = gradient(zx, spacing)
    zyy = gradient(zy, spacing)[0]
    zx, zy, zxx, zxy, zyy = (x[own] for x in (zx, zy, zxx, zxy, zyy))
    flat = (zx**2 + zy**2 + 1e-10) ** 1.5
    near = cut(1, "reflect")
    tri = sum(np.abs(near[1 + a : 1 + a + n_r, 1 + b : 1 + b + n_c] - z) for a in (-1, 0, 1) for b in (-1, 0, 1))
    return {
        "slope": np.degrees(np.arctan(np.sqrt(zx**2 + zy**2))),
        "elev_5x5_rel": means[5] - z,
        "elev_5x5_std_dev": std[5],
        "aspect": np.mod(np.degrees(np.arctan2(-zx, zy)) + 360, 360),
        "curvature_profile": -((zxx * zy**2 + zyy * zx**2 - 2 * zxy * zx * zy) / flat),
        "curvature_plan": -((zxx * zx**2 + zyy * zy**2 + 2 * zxy * zx * zy) / flat),
        "tpi_3x3": z - means[3],
        "tpi_11x11": z - means[11],
        "tpi_21x21": z - means[21],
        "tri": tri,
        "elev_std_3x3": std[3],
        "elev_std_9x9": std[9],
    }


def focal_features(df: DataFrame, value: str, spacing: float = 10.0, tile: int = TILE, like: DataFrame | None = None) -> DataFrame:
    """All features of NAMES for each cell; value must have no NULL.  The sizes of rasters are those of like, if given, so that df is computed once."""
    side = lambda at, n: F.filter(F.array_distinct(F.array(*[F.floor((at + k) / tile) for k in (-HALO, 0, HALO)])), lambda t: (t >= 0) & (t * tile < n))
    sent = with_size(df.select(*KEY, F.col(value).cast("double").alias("z")), like)
    sent = sent.withColumn("tr", F.explode(side(F.col(ROW), F.col("n_r")))).withColumn("tc", F.explode(side(F.col(COL), F.col("n_c"))))
    types = {k: df.schema[k].dataType.simpleString() for k in KEY}

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        r, c = cells[ROW].to_numpy(), cells[COL].to_numpy()
        top, left = int(r.min()), int(c.min())
        block = np.full((int(r.max()) - top + 1, int(c.max()) - left + 1), np.nan)
        block[r - top, c - left] = cells["z"].to_numpy()
        height, width = int(cells["n_r"].iloc[0]), int(cells["n_c"].iloc[0])
        r0, c0 = int(cells["tr"].iloc[0]) * tile, int(cells["tc"].iloc[0]) * tile
        n_r, n_c = min(tile, height - r0), min(tile, width - c0)
        found = edge_aware(block, top, left, height, width, (r0, c0, n_r, n_c), spacing)
        rows, cols = np.meshgrid(np.arange(r0, r0 + n_r), np.arange(c0, c0 + n_c), indexing="ij")
        return pd.DataFrame({RASTER: cells[RASTER].iloc[0], ROW: rows.ravel(), COL: cols.ravel(), **{n: found[n].ravel() for n in NAMES}})

    ship(df.sparkSession)
    schema = ", ".join([f"{k} {t}" for k, t in types.items()] + [f"{n} double" for n in NAMES])
    return sent.groupBy(RASTER, "tr", "tc").applyInPandas(run, schema)
