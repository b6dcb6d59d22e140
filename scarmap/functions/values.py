"""Scalar expressions on bands, predictions, dates and packed strings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from scarmap.config import LEVELS, Period


def clamp(value: Column, low, high) -> Column:
    """``value`` limited to [low, high]; null stays null (least and greatest alone would skip it)."""
    low, high = (b if isinstance(b, Column) else F.lit(b) for b in (low, high))
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def in_period(ts: Column, period: Period) -> Column:
    return (ts >= F.lit(period.start)) & (ts < F.lit(period.end))


def nan_to_null(value: Column) -> Column:
    """NaN compares greater than every number in Spark; a missing value must not pass a filter."""
    return F.nullif(value, F.lit(float("nan")))


def masked(value: Column, keep: Column) -> Column:
    return F.when(keep, value)


def quantised(probability: Column) -> Column:
    """Probability to 0..255, fraction cut off."""
    return clamp((probability * LEVELS).cast("int"), 0, LEVELS).cast("short")


def json_value(text: Column, path: str) -> Column:
    """Text of the value at a path; null where there is none or the text is not JSON."""
    return F.get_json_object(text, path)


def int_list(packed: Column) -> Column:
    """``"43,94"`` to an array of integers."""
    return F.transform(F.split(packed, ","), lambda s: F.trim(s).cast("int"))


def period_text(path: Column) -> tuple[Column, Column]:
    """Start and end of the first ``YYYY-MM-DD_YYYY-MM-DD`` in a name, as dates."""
    pattern = r"(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})"
    return tuple(F.to_date(F.nullif(F.regexp_extract(path, pattern, g), F.lit(""))) for g in (1, 2))


def tile_name(path: Column) -> Column:
    """Tile id of a file name such as ``qk_1203.tif``."""
    return F.nullif(F.regexp_extract(path, r"qk_([0-3]+)", 1), F.lit(""))


def window_label(end_post: Column, event: date) -> Column:
    """0 for windows that end by the event date, 1 for later ones."""
    return F.when(end_post <= F.lit(event), 0).otherwise(1)


def cell(value: Column, origin: float, step: float) -> Column:
    """Index of the half-open grid interval that holds ``value``."""
    return F.floor((value - origin) / step).cast("int")
