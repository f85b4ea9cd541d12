"""Image collections: rows (img_id, ts, r, c, value), reduced over time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASONS = {"spring": (3, 5), "summer": (6, 8), "autumn": (9, 11), "winter": (12, 2)}


def in_months(ts: Column, first: int, last: int) -> Column:
    """Calendar months first to last; from a later to an earlier one across the new year."""
    m = F.month(ts)
    return m.between(first, last) if first <= last else (m >= first) | (m <= last)


def on_day(ts: Column, month: int, day: int) -> Column:
    return (F.month(ts) == month) & (F.dayofmonth(ts) == day)


def trailing(ts: Column, end: datetime, months: int = 6) -> Column:
    """From so many months before end up to, but without, end."""
    stop = F.lit(end).cast("timestamp")
    return (ts >= F.add_months(stop, -months)) & (ts < stop)


def trailing_mean(value: str, keys: list[str], ts: str, months: int = 6) -> Column:
    """The mean over the rows of the same keys from so many months before a row's time up to it."""
    return F.expr(f"avg({value}) over (partition by {', '.join(keys)} order by cast({ts} as timestamp) range between interval {months} months preceding and current row)")


def composite(images: DataFrame, keys: list[str], how: str = "mean", value: str = "value") -> DataFrame:
    """One value for each place: the mean or sum of the images."""
    return images.groupBy(*keys).agg({"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[how](value).alias(value))


def climatology(images: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """The mean of each calendar month over all years, by place."""
    return images.groupBy(*keys, F.month("ts").alias("month")).agg(F.avg(value).alias(value))


def latest(images: DataFrame, keys: list[str], order: list[str], value: str = "value") -> DataFrame:
    """The value of the most recent image by place, whether measured or not."""
    best = F.max_by(F.struct(F.col(value)), F.struct(*order))
    return images.groupBy(*keys).agg(best.alias("__last")).select(*keys, F.col(f"__last.{value}").alias(value))


def mosaic(images: DataFrame, keys: list[str], order: list[str], value: str = "value") -> DataFrame:
    """The last measured value by place: later images lie on top."""
    return latest(images.filter(F.col(value).isNotNull()), keys, order, value)


def area_under_mask(df: DataFrame, by: list[str], mask: Column, cell_area: float) -> DataFrame:
    """Sum of the areas of cells in the mask."""
    return df.groupBy(*by).agg((F.count_if(mask) * cell_area).alias("area"))
