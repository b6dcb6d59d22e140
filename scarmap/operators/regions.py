"""Damaged buildings, counted per administrative region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.config import DAMAGE_THRESHOLD, LEVELS, MIN_AREA, NEGATIVE_STARTS, POSITIVE_STARTS
from scarmap.functions.values import nan_to_null
from scarmap.operators.raster import all_of, any_of

TOP = 10


def is_damaged(negative=NEGATIVE_STARTS, positive=POSITIVE_STARTS, threshold=DAMAGE_THRESHOLD, min_area=MIN_AREA, prefix="pred_") -> Column:
    """Below the threshold in every window before the event, at or above it in any after, and large enough.

    A missing value is below nothing and above nothing: it fails "every" and is ignored by "any".
    """
    limit = threshold * LEVELS

    def value(d):
        return nan_to_null(F.col(f"{prefix}{d}").cast("double"))

    before = all_of([F.coalesce(value(d) < limit, F.lit(False)) for d in negative])
    after = any_of([F.coalesce(value(d) >= limit, F.lit(False)) for d in positive])
    return before & after & F.coalesce(F.col("area") > min_area, F.lit(False))


def count_per_region(preds: DataFrame, region: str, damaged: Column | None = None, min_area=MIN_AREA) -> DataFrame:
    """Damaged and all buildings above the minimum area, per region id."""
    damaged = is_damaged() if damaged is None else damaged
    rows = preds.where(F.col(region).isNotNull() & (F.col("area") > min_area))
    return rows.groupBy(region).agg(F.count_if(damaged).alias("n_buildings_damaged"), F.count(F.lit(1)).alias("n_buildings"))


def damage_rate(regions: DataFrame, counts: DataFrame, region: str) -> DataFrame:
    """Counts onto all regions. A region without buildings has 0 damaged and no total or rate."""
    out = regions.join(counts, region, "left")
    damaged = F.coalesce(F.col("n_buildings_damaged"), F.lit(0))
    return out.withColumn("n_buildings_damaged", damaged).withColumn(
        "perc_destroyed", F.try_divide(F.lit(100.0) * damaged, F.col("n_buildings"))
    )


def total_damaged(rates: DataFrame) -> DataFrame:
    return rates.agg(F.sum("n_buildings_damaged").alias("n_buildings_damaged"))


def top_regions(rates: DataFrame, region: str, n: int = TOP, more_than: int | None = None) -> DataFrame:
    """The ``n`` regions of highest rate, optionally among those with more than so many buildings."""
    if more_than is not None:
        rates = rates.where(F.col("n_buildings") > more_than)
    return rates.orderBy(F.desc_nulls_last("perc_destroyed"), region).limit(n)


def regions_above(rates: DataFrame, rate: float) -> DataFrame:
    return rates.where(F.col("perc_destroyed") > rate)


def admin_hierarchy(adm1: DataFrame, adm2: DataFrame, adm3: DataFrame) -> DataFrame:
    """Level 3 with the ids of its parents, joined on the full name path."""
    one = adm1.select("ADM1_EN", F.col("admin_id").alias("adm1_id"))
    two = adm2.select("ADM1_EN", "ADM2_EN", F.col("admin_id").alias("adm2_id"))
    three = adm3.withColumnRenamed("admin_id", "adm3_id")
    return three.join(one, "ADM1_EN").join(two, ["ADM1_EN", "ADM2_EN"])
