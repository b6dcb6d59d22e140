"""Damage labels: one per place, class and area filters, labels by time, labels onto buildings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from scarmap.functions.values import window_label
from scarmap.operators.series import period_pairs


def dedupe_labels(labels: DataFrame, place: list[str], how: str = "last") -> DataFrame:
    """One whole row per place: the latest epoch (``last``) or the strongest damage (``min``).

    Ties go to the smallest ``unosat_id``. Partial aggregation keeps one row per place and task.
    """
    if how == "last":
        rank = -(F.unix_date("ep") if isinstance(labels.schema["ep"].dataType, DateType) else F.col("ep"))
    elif how == "min":
        rank = F.col("damage")
    else:
        raise ValueError(f"labels are reduced by latest epoch (last) or strongest damage (min), not by {how!r}")
    best = F.min_by(F.struct(*labels.columns), F.struct(rank.isNull(), rank, F.col("unosat_id")))
    return labels.groupBy(*[F.col(c).alias(f"_{c}") for c in place]).agg(best.alias("_row")).select("_row.*")


def keep_damage(df: DataFrame, classes: list[int] | None) -> DataFrame:
    """Rows of the given classes; None keeps all."""
    return df if classes is None else df.where(F.col("damage").isin(list(classes)))


def keep_aoi(df: DataFrame, aois: str | list[str] | None) -> DataFrame:
    aois = [aois] if isinstance(aois, str) else aois
    return df if aois is None else df.where(F.col("aoi").isin(list(aois)))


def labels_for(labels: DataFrame, place: list[str], aois=None, classes=(1, 2), how: str | None = "last") -> DataFrame:
    """Deduplicate first, then the class filter, then the area filter: the order changes the answer."""
    one = dedupe_labels(labels, place, how) if how else labels
    return keep_aoi(keep_damage(one, classes), aois)


def label_windows(points: DataFrame, pre, post, event: date) -> DataFrame:
    """Every point with every (pre, post) pair and its label.

    Windows that end by the event are negative for all points. Later ones are positive, and only
    points whose damage was dated by the end of the window are kept.
    """
    rows = period_pairs(points, pre, post).withColumn("label", window_label(F.col("end_post"), event))
    return rows.where((F.col("label") == 0) | (F.col("date") <= F.col("end_post")))


def labelled_features(points: DataFrame, features: DataFrame, pre, post, event: date, orbits: DataFrame | None = None) -> DataFrame:
    """Training rows: labels x orbits of their area x period pairs, with features where there are any."""
    spine = label_windows(points if orbits is None else points.join(orbits, "aoi"), pre, post, event)
    keys = ["aoi", "unosat_id", *([] if orbits is None else ["orbit"]), "start_pre", "start_post"]
    return spine.join(features.drop("end_pre", "end_post"), keys, "left")


def attach_labels(preds: DataFrame, labels: DataFrame, columns=("date", "geometry")) -> DataFrame:
    """Adds label columns to predictions; predictions without a label keep nulls."""
    keys = ["aoi", "unosat_id"]
    return preds.join(labels.select(*keys, *columns), keys, "left")


def worst_label_per_building(hits: DataFrame) -> DataFrame:
    """The label of lowest class per building, all columns from that one label."""
    row = F.struct("damage", "unosat_id", "date", "aoi")
    best = hits.groupBy("building_id").agg(F.min_by(row, F.struct("damage", "unosat_id")).alias("_b"))
    return best.select("building_id", *[F.col(f"_b.{c}").alias(n) for c, n in LABEL_COLUMNS.items()])


LABEL_COLUMNS = {"damage": "unosat_damage", "unosat_id": "unosat_id", "date": "unosat_date", "aoi": "unosat_aoi"}


def add_label_info(buildings: DataFrame, best: DataFrame) -> DataFrame:
    return buildings.join(best, "building_id", "left")
