"""Expressions that a viewer shows: stretches, palettes, labels and searches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_range(low: Column, high: Column, offset: Column) -> Column:
    """A display range moved by half its width times an offset of -1 to 1."""
    shift = offset * (high - low) * 0.5
    return F.struct((low + shift).alias("min"), (high + shift).alias("max"))


def palette_index(x: Column, low: Column, high: Column, colours: int) -> Column:
    """Which colour a linear stretch gives, from 0; values beyond the range take the first or last."""
    return F.least(F.greatest(F.floor((x - low) / (high - low) * colours), F.lit(0)), F.lit(colours - 1)).cast("int")


def palette_colour(x: Column, low: Column, high: Column, colours: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, colours)), palette_index(x, low, high, len(colours)) + 1)


def percent(p: Column) -> Column:
    return F.when(p.isNotNull(), F.format_string("%.1f%%", p * 100)).otherwise("No data")


def signed_percent(offset: Column, up: str = "wetter", down: str = "drier") -> Column:
    """Label of a scenario offset: Baseline, or the signed percentage and its sense."""
    whole = F.round(offset * 100).cast("int")
    return F.when(whole == 0, "Baseline").when(whole > 0, F.concat(F.lit("+"), whole, F.lit(f"% {up}"))).otherwise(F.concat(whole, F.lit(f"% {down}")))


def coordinate(x: Column) -> Column:
    return F.format_string("%.5f", x)


def safe_name(name: Column) -> Column:
    """A file name: what is neither letter nor digit becomes an underscore."""
    return F.regexp_replace(F.coalesce(name, F.lit("unnamed")), "[^a-zA-Z0-9]", "_")


def matches_search(name: Column, query: str) -> Column:
    return F.contains(F.lower(name), F.lower(F.trim(F.lit(query))))


def reclass(code: Column, table: dict[int, str]) -> Column:
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def elapsed(seconds: Column) -> Column:
    return F.format_string("%dm %ds", F.floor(seconds / 60).cast("int"), (seconds % 60).cast("int"))
