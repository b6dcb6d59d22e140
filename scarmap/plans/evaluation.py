"""Evaluation of a prediction raster: all label points and windows, threshold sweep, best threshold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.config import AREAS_TEST, DAMAGE_CLASSES, EVENT_DATE, THRESHOLDS
from scarmap.operators import evaluate as E
from scarmap.operators import labels as L
from scarmap.operators import raster as R
from scarmap.operators.raster import Grid

KEYS = ["aoi", "unosat_id"]


def point_values(
    pixels: DataFrame, labels: DataFrame, grid: Grid, extent: tuple[int, int, int, int], starts: list[date],
    aois: list[str] | None = AREAS_TEST, damages: list[int] | None = DAMAGE_CLASSES, size: int = 3, how: str = "max",
) -> DataFrame:
    """(aoi, unosat_id, date, start_post, pred): every label point with every window; 0 where no pixel has a value."""
    points = L.keep_aoi(L.keep_damage(labels, damages), aois).select(*KEYS, "date", "lon", "lat")
    values = R.nearest_values(points, pixels, grid, extent, [*KEYS, "date"], size=size, how=how, dates=starts, fill=0)
    return values.withColumnsRenamed({"post_date": "start_post", "value": "pred"})


def wide_points(values: DataFrame, starts: list[date]) -> DataFrame:
    """One row per point, a ``pred_`` column per window."""
    return R.spread_dates(values, [*KEYS, "date"], starts, "start_post", "pred", fill=0, agg=F.max)


def sweep_raster(values: DataFrame, starts: list[date], event: date = EVENT_DATE, positive_year: int | None = None, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Metrics of the raster at every threshold; ``evaluate.best_threshold`` picks one."""
    return E.threshold_sweep(E.judged(values, starts, event=event, positive_year=positive_year), thresholds)
