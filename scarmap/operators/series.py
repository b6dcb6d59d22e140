"""Statistics of time series: per group, per period, per pair of periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.cluster import HOT_GROUP_ROWS, checked_broadcast, join_null_safe, settle, split_hot
from scarmap.config import Period, feature_names
from scarmap.functions.values import in_period
from scarmap.operators.quantiles import large_medians, sketches

# Population moments; kurtosis is the excess over the normal distribution.
STATISTICS = {
    "mean": F.avg,
    "stdDev": F.stddev_pop,
    "median": F.median,
    "min": F.min,
    "max": F.max,
    "skew": F.skewness,
    "kurtosis": F.kurtosis,
}


def reducers(names: list[str], value: str, prefix: str | None = None) -> list[Column]:
    """Aggregates of one column, all for one ``agg`` call, named ``{prefix}_{reducer}``."""
    unknown = [n for n in names if n not in STATISTICS]
    if unknown:
        raise ValueError(f"unknown reducer {unknown[0]}")
    return [STATISTICS[n](value).alias(f"{prefix or value}_{n}") for n in names]


def reduce_groups(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    names: list[str],
    cluster_by: list[str] | None = None,
    count_as: str | None = None,
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """All reducers of all value columns per group.

    Without a median, map-side partial aggregates are shuffled. A median has to see its values, so
    rows are shuffled once on ``cluster_by`` (a subset of ``keys``) and every aggregate is finished
    in that stage; later groupings on ``cluster_by`` need no shuffle. Groups of ``cluster_by`` above
    ``hot_rows`` rows take another way: one pass of partial aggregates for the moments and for sketches that bracket the
    median, one more over the rows inside the brackets. Finding hot groups costs one scan of the key columns, and one that
    writes the rows if there are any; None leaves it out, for groups known to be small.
    """
    cluster_by = cluster_by or keys
    count = [F.count(F.lit(1)).alias(count_as)] if count_as else []

    def aggregates(reducer_names):
        return [*count, *[a for v in values for a in reducers(reducer_names, v)]]

    df = df.select(*dict.fromkeys([*keys, *values]))
    if "median" not in names:
        return df.groupBy(*keys).agg(*aggregates(names))

    def gathered(rows):
        return rows.repartition(*cluster_by).groupBy(*keys).agg(*aggregates(names))

    usual, hot = (df, None) if hot_rows is None else split_hot(df, cluster_by, hot_rows)
    usual = gathered(usual)
    if hot is None:
        return usual
    moments = settle(hot.groupBy(*keys).agg(*aggregates([n for n in names if n != "median"]), *sketches(values)))
    medians = large_medians(hot, moments, keys, values, hot_rows)
    return usual.unionByName(join_null_safe(moments, medians, keys, "left").select(*usual.columns))


def tag_periods(df: DataFrame, periods: list[Period], ts: str = "ts", out: str = "period") -> DataFrame:
    """One row per observation and period that holds it; ``out`` is the index in ``periods``.

    The outer bounds go to the scan as a plain range filter.
    """
    t = F.col(ts)
    first, last = min(p.start for p in periods), max(p.end for p in periods)
    rows = df.where(in_period(t, Period(first, last)))
    inside = [F.when(in_period(t, p), F.lit(i)) for i, p in enumerate(periods)]
    in_order = sorted(periods, key=lambda p: p.start)
    if all(a.end <= b.start for a, b in zip(in_order, in_order[1:])):
        # no day in two periods: a plain expression is enough
        return rows.withColumn(out, F.coalesce(*inside)).where(F.col(out).isNotNull())
    return rows.withColumn(out, F.explode(F.array_compact(F.array(*inside))))


def period_pairs(df: DataFrame, pre: list[Period], post: list[Period]) -> DataFrame:
    """Every row once per (pre, post) pair, with the four bounds as columns."""
    pairs = [
        F.struct(*[F.lit(d).alias(n) for d, n in zip((a.start, a.end, b.start, b.end), BOUNDS)]) for a in pre for b in post
    ]
    return df.withColumn("_pair", F.explode(F.array(*pairs))).select(*df.columns, "_pair.*")


BOUNDS = ("start_pre", "end_pre", "start_post", "end_post")


def period_features(
    obs: DataFrame,
    keys: list[str],
    bands: list[str],
    pre: list[Period],
    post: list[Period],
    names: list[str],
    window: str = "1x1",
    count_as: str | None = None,
    ts: str = "ts",
    hot_rows: int | None = HOT_GROUP_ROWS,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """One row per key and (pre, post) pair; columns ``{band}_{pre|post}_{window}_{reducer}``.

    Each observation is reduced once per period that holds it, whatever the number of pairs. A
    period without observations gives nulls; ``count_as`` adds ``{count_as}_pre`` and ``_post``.
    Rows are shuffled on ``cluster_by``, a subset of the keys, so that a later grouping on it needs
    no shuffle. Key columns must not be null.
    """
    periods = list(dict.fromkeys([*pre, *post]))
    tagged = tag_periods(obs, periods, ts)
    stats = reduce_groups(tagged, [*keys, "period"], bands, names, cluster_by or keys, "_rows", hot_rows)
    fields = [f"{b}_{n}" for b in bands for n in names]
    per_period = [
        F.first(F.when(F.col("period") == i, F.struct("_rows", *fields)), ignorenulls=True).alias(f"_p{i}")
        for i in range(len(periods))
    ]
    wide = stats.groupBy(*keys).agg(*per_period)
    pairs = [
        F.struct(
            *[F.lit(d).alias(n) for d, n in zip((a.start, a.end, b.start, b.end), BOUNDS)],
            F.col(f"_p{periods.index(a)}").alias("_pre"),
            F.col(f"_p{periods.index(b)}").alias("_post"),
        )
        for a in pre
        for b in post
    ]
    rows = wide.select(*keys, F.explode(F.array(*pairs)).alias("_pair")).select(*keys, "_pair.*")
    counts = [F.coalesce(F.col(f"_{p}._rows"), F.lit(0)).alias(f"{count_as}_{p}") for p in ("pre", "post")]
    stats_columns = [
        F.col(f"_{p}.{b}_{n}").alias(f"{b}_{p}_{window}_{n}") for b in bands for p in ("pre", "post") for n in names
    ]
    return rows.select(*keys, *BOUNDS, *(counts if count_as else []), *stats_columns)


def rename_features(stats: DataFrame, bands: list[str], names: list[str], period: str, window: str) -> DataFrame:
    """Statistics of one period named as model inputs: ``{band}_{period}_{window}_{reducer}``."""
    plain = [f"{b}_{n}" for b in bands for n in names]
    return stats.withColumnsRenamed(dict(zip(plain, feature_names(bands, window, names, (period,)), strict=True)))


def series_of_points(obs: DataFrame, points: DataFrame, columns: list[str]) -> DataFrame:
    """Stored observations of the given points, with ``columns`` of the points; a point without observations has no row."""
    keys = ["aoi", "unosat_id"]
    return obs.join(checked_broadcast(points.select(*keys, *columns)), keys)


def fill_gaps(df: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Missing values become the mean over time of the same key and band.

    Means are partial aggregates joined back, so a long series is never held by one task.
    """
    means = df.groupBy(*keys).agg(*[F.avg(b).alias(f"_{b}") for b in bands])
    filled = [F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in bands else F.col(c) for c in df.columns]
    return join_null_safe(df, means, keys, "left").select(*filled)


def join_features(left: DataFrame, right: DataFrame, columns_left=None, columns_right=None) -> DataFrame:
    """Inner join of two feature tables of the same points, pairs of windows and, where both have them, orbits.

    The right one wins on a name clash.
    """
    keys = ["aoi", "unosat_id", "start_pre", "start_post", *(["orbit"] if "orbit" in left.columns and "orbit" in right.columns else [])]
    keep_right = [c for c in (columns_right or right.columns) if c not in keys]
    keep_left = [c for c in (columns_left or left.columns) if c not in keys and c not in keep_right]
    return left.select(*keys, *keep_left).join(right.select(*keys, *keep_right), keys)


def join_sensors(s1: DataFrame, s2: DataFrame) -> DataFrame:
    """Adds the orbit-free features of the second sensor to each row of the first."""
    keys = ["aoi", "unosat_id", "start_pre", "start_post"]
    extra = [c for c in s2.columns if c not in s1.columns]
    return s1.join(s2.select(*keys, *extra), keys, "left")
