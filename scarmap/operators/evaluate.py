"""Predictions against labels: confusion counts, metrics, threshold sweep."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scarmap.config import EVENT_DATE, LEVELS, THRESHOLDS
from scarmap.operators.raster import spread_dates
from scarmap.functions.values import quantised

METHODS = ("date-wise", "date-wise-mean", "date-wise-median")
COUNTS = ("tp", "fp", "tn", "fn")


def point_predictions(scored: DataFrame, keys=("aoi", "unosat_id"), score: str = "classification") -> DataFrame:
    """Mean over orbits per point and window, 0..255 with the fraction cut off."""
    mean = scored.groupBy(*keys, "start_post").agg(F.avg(score).alias("_m"))
    return mean.select(*keys, "start_post", quantised(F.col("_m")).cast("int").alias("pred"))


def wide_predictions(preds: DataFrame, starts: list[date]) -> DataFrame:
    """One row per point, one ``pred_`` column per window start, sorted by area and id."""
    return spread_dates(preds, ["unosat_id", "aoi"], starts, "start_post", "pred", agg=F.max).orderBy("aoi", "unosat_id")


def judged(
    preds: DataFrame, starts: list[date], method: str = "date-wise", event: date = EVENT_DATE,
    positive_year: int | None = 2022, keys=("aoi", "unosat_id"),
) -> DataFrame:
    """(y_true, pred) rows of long predictions (keys, date, start_post, pred) over the window ``starts``.

    Windows that start on or after the label date are positive (of one year only, if given), windows
    before the event negative, others unknown; points without a label date are left out. With mean or
    median each point gives one row per side. A window or side without a value gives a null, which
    counts as not damaged. One shuffle: every point becomes one row with a value per window.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    values = [F.max(F.when(F.col("start_post") == F.lit(s), F.col("pred"))).alias(f"_{i}") for i, s in enumerate(starts)]
    points = preds.where(F.col("date").isNotNull()).groupBy(*keys).agg(F.max("date").alias("date"), *values)
    windows = F.array(*[F.struct(F.lit(s).alias("start"), F.col(f"_{i}").cast("double").alias("pred")) for i, s in enumerate(starts)])

    def after(w: Column) -> Column:
        late = w["start"] >= F.col("date")
        return late if positive_year is None else late & (F.year(w["start"]) == positive_year)

    def before(w: Column) -> Column:
        return w["start"] < F.lit(event)

    def side(y: int, belongs) -> Column:
        return F.struct(F.lit(y).alias("y_true"), F.transform(F.filter("_w", belongs), lambda w: w["pred"]).alias("preds"))

    sides = points.withColumn("_w", windows).select(F.explode(F.array(side(1, after), side(0, before))).alias("s")).select("s.*")
    if method == "date-wise":
        return sides.select("y_true", F.explode("preds").alias("pred"))
    present = sides.select("y_true", F.array_sort(F.array_compact("preds")).alias("p"))
    n = F.size("p")
    if method == "date-wise-mean":
        pred = F.try_divide(F.aggregate("p", F.lit(0.0), lambda s, v: s + v), n)
    else:
        pred = (F.get("p", F.floor((n - 1) / 2).cast("int")) + F.get("p", F.floor(n / 2).cast("int"))) / 2
    return present.select("y_true", pred.alias("pred"))


def confusion(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: tp, fp, tn, fn. A missing prediction counts as not damaged."""
    hit = F.coalesce(F.col("pred") >= threshold * LEVELS, F.lit(False))
    return rows.agg(*_counts(hit))


def _counts(hit: Column) -> list[Column]:
    positive = F.col("y_true") == 1
    cases = {"tp": positive & hit, "fp": ~positive & hit, "tn": ~positive & ~hit, "fn": positive & ~hit}
    return [F.count_if(cases[c]).alias(c) for c in COUNTS]


def with_metrics(counts: DataFrame) -> DataFrame:
    """precision, recall, f1, roc_auc, accuracy; 0 where a denominator is empty.

    The area under the curve is that of the hard decision: the mean of both class recalls.
    """
    tp, fp, tn, fn = (F.col(c).cast("double") for c in COUNTS)

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return counts.withColumns({
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
        "roc_auc": (share(tp, tp + fn) + share(tn, tn + fp)) / 2,
        "accuracy": share(tp + tn, tp + fp + tn + fn),
    })


def class_report(counts: DataFrame) -> DataFrame:
    """precision, recall, f1, support per class, then their plain and support-weighted means."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in COUNTS)

    def row(name, hit, wrong, missed):
        return F.struct(F.lit(name).alias("class"), hit.alias("hit"), wrong.alias("wrong"), missed.alias("missed"))

    classes = counts.select(F.explode(F.array(row("no damage", tn, fn, fp), row("damaged", tp, fp, fn))).alias("r")).select("r.*")

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    hit, wrong, missed = F.col("hit"), F.col("wrong"), F.col("missed")
    scores = classes.select(
        "class",
        share(hit, hit + wrong).alias("precision"),
        share(hit, hit + missed).alias("recall"),
        share(2 * hit, 2 * hit + wrong + missed).alias("f1"),
        (hit + missed).cast("long").alias("support"),
    )
    names = ("precision", "recall", "f1")
    macro = scores.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = scores.agg(*[share(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names], F.sum("support").alias("support"))
    for name, df in (("macro avg", macro), ("weighted avg", weighted)):
        scores = scores.unionByName(df.withColumn("class", F.lit(name)))
    return scores


def threshold_sweep(rows: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Metrics at every threshold, in one pass: rows are counted per number of thresholds they reach.

    ``thresholds`` ascend, in any steps. Equal predictions are merged before they are compared with the limits.
    """
    if not thresholds or any(a >= b for a, b in zip(thresholds, thresholds[1:])):
        raise ValueError("thresholds must ascend")
    limits = F.array(*[F.lit(float(t * LEVELS)) for t in thresholds])
    pred = F.col("pred").cast("double")
    merged = rows.groupBy(pred.alias("_v")).agg(F.count_if(F.col("y_true") == 1).alias("_p"), F.count_if(F.col("y_true") == 0).alias("_q"))
    reached = F.size(F.filter(limits, lambda t: F.coalesce(t <= F.col("_v"), F.lit(False))))
    bins = merged.groupBy(reached.alias("_bin")).agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    # at most one bin more than there are thresholds, so one row holds them all
    whole = bins.agg(F.collect_list(F.struct("_bin", "_p", "_q")).alias("_b"))
    every = whole.select("_b", F.posexplode(F.array(*[F.lit(t) for t in thresholds])).alias("_k", "threshold"))

    def total(name: str, reached: bool) -> Column:
        counted = lambda b: (b["_bin"] > F.col("_k")) if reached else (b["_bin"] <= F.col("_k"))
        return F.aggregate(F.filter("_b", counted), F.lit(0).cast("long"), lambda s, b: s + b[name])

    counts = every.select(
        "threshold", total("_p", True).alias("tp"), total("_q", True).alias("fp"),
        total("_q", False).alias("tn"), total("_p", False).alias("fn"),
    )
    return with_metrics(counts)


def best_threshold(sweep: DataFrame, metric: str = "precision", target: float = 0.9) -> DataFrame:
    """The threshold nearest to the target; if it is not above the target, the next one.

    The last threshold has no next one and stands for itself.
    """
    following = Window.orderBy("threshold")
    gap = F.col(metric) - target
    nearest = sweep.withColumn("_next", F.coalesce(F.lead("threshold").over(following), F.col("threshold"))).agg(
        F.min_by(F.struct(gap.alias("gap"), "threshold", "_next"), F.struct(F.abs(gap), F.col("threshold"))).alias("_b")
    )
    pick = F.when(F.col("_b.gap") > 0, F.col("_b.threshold")).otherwise(F.col("_b._next"))
    return nearest.select(F.lit(metric).alias("metric"), F.lit(target).alias("target"), pick.alias("threshold"))
