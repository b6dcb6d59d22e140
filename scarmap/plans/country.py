"""Country statistics: building predictions -> damage per region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from scarmap.operators import regions as A


def region_report(preds: DataFrame, regions: DataFrame, region: str, damaged: Column | None = None) -> DataFrame:
    """Damaged and all buildings and the rate of every region."""
    return A.damage_rate(regions, A.count_per_region(preds, region, damaged), region)
