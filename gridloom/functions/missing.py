"""Missing data: every encoding becomes NULL on the way in, and a sentinel only on the way out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.schema import HUGE, LEAST_VALID, NODATA


def is_missing(x: Column, nodata: float | None = None) -> Column:
    """NULL, NaN, infinite, beyond HUGE or the sentinel.  NaN is tested for itself: it compares as larger than anything."""
    out = x.isNull() | F.isnan(x.cast("double")) | (x > HUGE) | (x < -HUGE)
    return out if nodata is None else out | (x == nodata)


def to_null(x: Column, nodata: float | None = None) -> Column:
    return F.when(~is_missing(x, nodata), x)


def fix_nodata(x: Column, nodata: float = NODATA, old: float | None = None) -> Column:
    """One sentinel for all encodings; applying it twice changes nothing."""
    return F.when(is_missing(x, old), F.lit(nodata)).otherwise(x)


def to_sentinel(x: Column, nodata: float = NODATA) -> Column:
    return F.coalesce(x.cast("double"), F.lit(nodata))


def valid_pixel(bands: list[Column], strict: bool = False) -> Column:
    """All bands are measured; the sentinel passes, as models were trained with it, unless strict."""
    least = NODATA + 0.5 if strict else LEAST_VALID
    return reduce(lambda a, b: a & b, [b.isNotNull() & ~F.isnan(b.cast("double")) & (F.abs(b) != float("inf")) & (b >= least) for b in bands])


def unbleed(x: Column, nodata: float = NODATA) -> Column:
    """NULL where interpolation has mixed the sentinel in."""
    return F.when(x > nodata * 0.9, x)
