"""Exact medians of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scarmap.cluster import HOT_GROUP_ROWS, checked_broadcast, join_null_safe, settle

# The sketch may miss a rank by 1/ACCURACY of the rows; the bracket is wider on both sides.
ACCURACY = 10_000
MARGIN = 10 / ACCURACY
# Ranges per group when a bracket is narrowed.
RANGES = 32


def sketches(values: list[str]) -> list[Column]:
    """Aggregates that bracket the median of every value column, beside others of the same pass."""
    at = [i / 1000 for i in range(1001)]
    return [
        F.struct(F.count(v).alias("n"), F.percentile_approx(F.col(v).cast("double"), at, ACCURACY).alias("q"), F.min(F.col(v).cast("double")).alias("min"), F.max(F.col(v).cast("double")).alias("max")).alias(f"_{v}_sketch")
        for v in values
    ]


def large_medians(df: DataFrame, sketched: DataFrame, keys: list[str], values: list[str], limit: int = HOT_GROUP_ROWS) -> DataFrame:
    """Exact median (mean of the two middle values) of every value column per group.

    Groups are never gathered. ``sketched`` has the ``sketches`` of every group of ``df``, mergeable ones from a pass over its
    rows, and so a bracket around the middle ranks; a second pass merges equal values inside the bracket and counts the rows
    below it. What is left, some thousandths of the rows, is narrowed range by range until it fits ``limit``.
    """
    by = [*keys, "_band"]
    each = lambda of: F.explode(F.array(*[F.struct(F.lit(v).alias("_band"), of(v)) for v in values])).alias("_b")
    rows = df.select(*keys, each(lambda v: F.col(v).cast("double").alias("_v"))).select(*keys, "_b.*").where("_v is not null")
    parts = sketched.select(*keys, each(lambda v: F.col(f"_{v}_sketch").alias("_s"))).select(*keys, "_b._band", "_b._s.*").where("n > 0")

    bracket = checked_broadcast(_bracket(parts, by))
    near = join_null_safe(rows, bracket, by).where(F.col("_v") <= F.col("_to"))
    # one row per distinct value; the rows below the bracket are one row whose value is null
    runs = settle(_merged(near, by, F.col("_v") >= F.col("_from"), F.count(F.lit(1))))
    while (runs.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) > limit:
        runs = settle(_narrowed(runs, by))

    ends = _cumulated(runs, by, "_v")
    middle = ends.groupBy(*by).agg(
        ((F.max(F.when(_holds("_lo"), F.col("_v"))) + F.max(F.when(_holds("_hi"), F.col("_v")))) / 2).alias("_median")
    )
    medians = middle.groupBy(*keys).pivot("_band", values).agg(F.first("_median"))
    return medians.withColumnsRenamed({v: f"{v}_median" for v in values})


def _bracket(parts: DataFrame, by: list[str]) -> DataFrame:
    """Per group: the two middle ranks, counted from 0, and values certainly below and above them."""
    lo, hi = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    first = F.floor((lo / F.col("n") - MARGIN) * 1000).cast("int")
    last = F.ceil(((hi + 1) / F.col("n") + MARGIN) * 1000).cast("int")
    return parts.select(
        *by,
        lo.alias("_lo"),
        hi.alias("_hi"),
        F.when(first <= 0, F.col("min")).otherwise(F.get("q", first)).alias("_from"),
        F.when(last >= 1000, F.col("max")).otherwise(F.get("q", last)).alias("_to"),
    )


def _merged(rows: DataFrame, by: list[str], inside, count) -> DataFrame:
    value = F.when(inside, F.col("_v")).alias("_v")
    return rows.groupBy(*by, value).agg(count.alias("_c"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))


def _cumulated(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_end", F.sum("_c").over(w))


def _holds(rank: str):
    return (F.col("_end") - F.col("_c") <= F.col(rank)) & (F.col(rank) < F.col("_end"))


def _narrowed(runs: DataFrame, by: list[str]) -> DataFrame:
    """Runs of the ranges that hold the middle ranks; ranges split the distinct values evenly."""
    cuts = runs.groupBy(*by).agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], ACCURACY).alias("_cuts"))
    placed = join_null_safe(runs, checked_broadcast(cuts), by)
    index = F.when(F.col("_v").isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    placed = placed.withColumn("_r", index).drop("_cuts")
    ranges = placed.groupBy(*by, "_r").agg(F.sum("_c").alias("_c"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    kept = _cumulated(ranges, by, "_r").where(_holds("_lo") | _holds("_hi"))
    kept = kept.groupBy(*by).agg(F.min("_r").alias("_first"), F.max("_r").alias("_last"))
    both = join_null_safe(placed, checked_broadcast(kept), by).where(F.col("_r") <= F.col("_last"))
    return _merged(both, by, F.col("_r") >= F.col("_first"), F.sum("_c"))
