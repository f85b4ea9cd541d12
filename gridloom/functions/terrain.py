"""Expressions over the cells of elevation rasters and their derivatives."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.schema import NODATA

#: Keeps curvature finite on flat ground (fixed value).
FLAT = 1e-10
#: Stands for the tangent of flat ground in the wetness index (fixed value).
LEAST_TANGENT = 0.001


def twi(sca: Column, slope: Column, unit: str = "degrees", nodata: float = NODATA) -> Column:
    """Wetness index ln(area / tan(slope)); the sentinel where it isn't finite."""
    tangent = {"degrees": lambda: F.tan(F.radians(slope)), "radians": lambda: F.tan(slope), "tangent": lambda: slope}[unit]()
    ratio = sca / F.when(tangent <= 0, LEAST_TANGENT).otherwise(tangent)
    return F.coalesce(F.when(ratio > 0, F.ln(ratio)), F.lit(nodata))


def slope(dx: Column, dy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))


def aspect(dx: Column, dy: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(-dx, dy)) + 360, F.lit(360.0))


def profile_curvature(zx: Column, zy: Column, zxx: Column, zxy: Column, zyy: Column) -> Column:
    return -((zxx * zy * zy + zyy * zx * zx - 2 * zxy * zx * zy) / F.pow(zx * zx + zy * zy + FLAT, F.lit(1.5)))


def plan_curvature(zx: Column, zy: Column, zxx: Column, zxy: Column, zyy: Column) -> Column:
    return -((zxx * zx * zx + zyy * zy * zy + 2 * zxy * zx * zy) / F.pow(zx * zx + zy * zy + FLAT, F.lit(1.5)))


def hillshade(dx: Column, dy: Column, azimuth: float = 270.0, altitude: float = 45.0) -> Column:
    """Light on a surface, 0 to 255."""
    steep, facing, zenith = F.atan(F.sqrt(dx * dx + dy * dy)), F.radians(aspect(dx, dy)), math.radians(90 - altitude)
    light = math.cos(zenith) * F.cos(steep) + math.sin(zenith) * F.sin(steep) * F.cos(math.radians(azimuth) - facing)
    return F.greatest(F.lit(0.0), 255 * light)


def std_from_moments(mean: Column, mean_of_squares: Column) -> Column:
    return F.sqrt(F.greatest(mean_of_squares - mean * mean, F.lit(0.0)))


def hectares(pixels: Column, pixel_size: float = 10.0) -> Column:
    return pixels * (pixel_size * pixel_size) / 10000


def coverage_percent(part: Column, whole: Column) -> Column:
    return 100.0 * part / F.greatest(whole, F.lit(1))


def acres(square_metres: Column) -> Column:
    return square_metres / 4046.86


def square_kilometres(square_metres: Column) -> Column:
    return square_metres / 1e6


def estimated_pixels(square_kilometres_: Column) -> Column:
    """Pixels of 10 m in an area."""
    return square_kilometres_ * 10000


def estimated_megabytes(pixels: Column) -> Column:
    return pixels * 0.00004


def world_x(transform: Column, row: Column, col: Column) -> Column:
    """Of a cell's centre."""
    return transform["a"] * (col + 0.5) + transform["b"] * (row + 0.5) + transform["c"]


def world_y(transform: Column, row: Column, col: Column) -> Column:
    return transform["d"] * (col + 0.5) + transform["e"] * (row + 0.5) + transform["f"]


def pixel_col(transform: Column, x: Column, y: Column) -> Column:
    """Column of the cell that holds a point."""
    det = transform["a"] * transform["e"] - transform["b"] * transform["d"]
    return F.floor((transform["e"] * (x - transform["c"]) - transform["b"] * (y - transform["f"])) / det).cast("int")


def pixel_row(transform: Column, x: Column, y: Column) -> Column:
    det = transform["a"] * transform["e"] - transform["b"] * transform["d"]
    return F.floor((transform["a"] * (y - transform["f"]) - transform["d"] * (x - transform["c"])) / det).cast("int")
