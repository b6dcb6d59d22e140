"""Damage per region, and predictions against labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import standins as D
from checks.registry import query
from checks.standins import DAMAGED_SQL, EVENT, NEGATIVE, POSITIVE, STARTS, rounded, sql
from scarmap.config import THRESHOLDS
from scarmap.operators import evaluate as E
from scarmap.operators import regions as A
from scarmap.plans import evaluation as V
from scarmap.plans import country
from scarmap.sources import readers

DAMAGED = lambda: A.is_damaged(NEGATIVE, POSITIVE)


@query("building_preds_wide", sql("SELECT building_id, area, adm3_id, " + ", ".join(f"pred_{y}" for y in D.YEARS) + " FROM wide", "wide"))
def building_preds_wide(spark, sf):
    return D.wide(spark, sf).select("building_id", "area", "adm3_id", *[f"pred_{y}" for y in D.YEARS])


@query("buildings_of_admin", sql("SELECT building_id, area, adm3_id FROM buildings WHERE adm3_id = '5-BUILDING'", "buildings"))
def buildings_of_admin(spark, sf):
    return readers.scan_buildings_of_admin(D.buildings(spark, sf), "5-BUILDING").select("building_id", "area", "adm3_id")


@query("damaged_buildings", sql(f"SELECT building_id FROM wide WHERE {DAMAGED_SQL}", "wide"))
def damaged_buildings(spark, sf):
    return D.wide(spark, sf).where(DAMAGED()).select("building_id")


def _regions(spark, sf, level):
    """All regions of a level, and one without buildings."""
    b = D.buildings(spark, sf).select(f"adm{level}_id").distinct()
    empty = D.read(spark, sf, "region").where("r_regionkey = 0").select(F.lit("none").alias(f"adm{level}_id"))
    return b.unionByName(empty)


def _counts_sql(level):
    return f"SELECT adm{level}_id, count(*) FILTER ({DAMAGED_SQL}) AS n_buildings_damaged, count(*) AS n_buildings FROM wide WHERE area > 50 GROUP BY 1"


def _rates_sql(level):
    return (
        f"SELECT adm{level}_id, coalesce(n_buildings_damaged, 0) AS n_buildings_damaged, n_buildings, 100.0::DOUBLE * coalesce(n_buildings_damaged, 0) / n_buildings AS perc_destroyed"
        f" FROM (SELECT DISTINCT adm{level}_id FROM buildings UNION ALL SELECT 'none' FROM region WHERE r_regionkey = 0) LEFT JOIN ({_counts_sql(level)}) USING (adm{level}_id)"
    )


def _rates(spark, sf, level):
    return country.region_report(D.wide(spark, sf), _regions(spark, sf, level), f"adm{level}_id", DAMAGED())


def _levels(level):
    @query(f"count_per_region_adm{level}", sql(_counts_sql(level), "wide"))
    def counts(spark, sf):
        return A.count_per_region(D.wide(spark, sf), f"adm{level}_id", DAMAGED())

    @query(
        f"damage_rate_adm{level}",
        sql(f"SELECT adm{level}_id, n_buildings_damaged, n_buildings, round(perc_destroyed + 1e-9, 6) + 0.0 AS perc_destroyed FROM ({_rates_sql(level)})", "wide", "buildings"),
    )
    def rates(spark, sf):
        return rounded(_rates(spark, sf, level))


for _level in (1, 2, 3):
    _levels(_level)

_RATE_COLS = "adm3_id, n_buildings_damaged, n_buildings, round(perc_destroyed + 1e-9, 6) + 0.0 AS perc_destroyed"


@query("total_damaged", sql(f"SELECT CAST(sum(n_buildings_damaged) AS BIGINT) AS n_buildings_damaged FROM ({_rates_sql(3)})", "wide", "buildings"))
def total_damaged(spark, sf):
    return A.total_damaged(_rates(spark, sf, 3))


@query("top_regions", sql(f"SELECT {_RATE_COLS} FROM ({_rates_sql(3)}) r ORDER BY r.perc_destroyed DESC NULLS LAST, adm3_id LIMIT 10", "wide", "buildings"))
def top_regions(spark, sf):
    return rounded(A.top_regions(_rates(spark, sf, 3), "adm3_id"))


@query("top_large_regions", sql(f"SELECT {_RATE_COLS} FROM ({_rates_sql(3)}) r WHERE n_buildings > 10 ORDER BY r.perc_destroyed DESC NULLS LAST, adm3_id LIMIT 10", "wide", "buildings"))
def top_large_regions(spark, sf):
    return rounded(A.top_regions(_rates(spark, sf, 3), "adm3_id", more_than=10))


@query("regions_above", sql(f"SELECT {_RATE_COLS} FROM ({_rates_sql(3)}) r WHERE r.perc_destroyed > 0", "wide", "buildings"))
def regions_above(spark, sf):
    return rounded(A.regions_above(_rates(spark, sf, 3), 0.0))


# ---- evaluation


@query("mean_pred_per_point", sql("SELECT aoi, unosat_id, start_post, pred FROM point_preds", "point_preds"))
def mean_pred_per_point(spark, sf):
    return D.point_preds(spark, sf)


@query(
    "wide_predictions",
    sql("SELECT unosat_id, aoi, " + ", ".join(f"max(CASE WHEN start_post = DATE '{s}' THEN pred END) AS \"pred_{s}\"" for s in STARTS) + " FROM point_preds GROUP BY 1, 2 ORDER BY aoi, unosat_id", "point_preds"),
)
def wide_predictions(spark, sf):
    return E.wide_predictions(D.point_preds(spark, sf), STARTS)


# Windows on or after the label date, and windows before the event; only points that have a label.
_EVERY = "(SELECT * FROM (SELECT DISTINCT aoi, unosat_id, date FROM preds_labelled WHERE date IS NOT NULL) CROSS JOIN (VALUES {}) w(start_post)) e LEFT JOIN point_preds p USING (aoi, unosat_id, start_post)".format(
    ", ".join(f"(DATE '{s}')" for s in STARTS)
)
_SIDES = f"""SELECT 1 AS y_true, aoi, unosat_id, pred FROM {_EVERY} WHERE start_post >= date
  UNION ALL SELECT 0, aoi, unosat_id, pred FROM {_EVERY} WHERE start_post < DATE '{EVENT}'"""


def _confusion_sql(rows, limit):
    hit = f"coalesce(pred >= {limit}, false)"
    cases = {"tp": f"y_true = 1 AND {hit}", "fp": f"y_true = 0 AND {hit}", "tn": f"y_true = 0 AND NOT {hit}", "fn": f"y_true = 1 AND NOT {hit}"}
    return f"SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in cases.items()) + f" FROM ({rows})"


def _metrics_sql(counts, extra=""):
    def share(a, b):
        return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"

    m = {
        "precision": share("tp", "tp + fp"),
        "recall": share("tp", "tp + fn"),
        "f1": share("2 * tp", "2 * tp + fp + fn"),
        "roc_auc": f"({share('tp', 'tp + fn')} + {share('tn', 'tn + fp')}) / 2",
        "accuracy": share("tp + tn", "tp + fp + tn + fn"),
    }
    return f"SELECT {extra}tp, fp, tn, fn, " + ", ".join(f"round({e} + 1e-9, 6) + 0.0 AS {n}" for n, e in m.items()) + f" FROM ({counts})"


def _method_rows(agg):
    points = "(SELECT DISTINCT aoi, unosat_id FROM preds_labelled WHERE date IS NOT NULL)"
    return (
        f"SELECT s.y_true, v.pred FROM (SELECT * FROM {points} CROSS JOIN (VALUES (0), (1)) t(y_true)) s"
        f" LEFT JOIN (SELECT y_true, aoi, unosat_id, {agg}(pred) AS pred FROM ({_SIDES}) GROUP BY ALL) v USING (aoi, unosat_id, y_true)"
    )


_METHODS = {"date-wise": _SIDES, "date-wise-mean": _method_rows("avg"), "date-wise-median": _method_rows("median")}


def _judged(spark, sf, method="date-wise"):
    return E.judged(D.preds_labelled(spark, sf), STARTS, method, EVENT, None)


def _methods(method):
    name = method.replace("-", "_")

    @query(f"confusion_{name}", sql(_confusion_sql(_METHODS[method], "0.3::DOUBLE * 255"), "preds_labelled", "point_preds"))
    def confusion(spark, sf):
        return E.confusion(_judged(spark, sf, method), 0.3)

    @query(f"metrics_{name}", sql(_metrics_sql(_confusion_sql(_METHODS[method], "0.3::DOUBLE * 255")), "preds_labelled", "point_preds"))
    def metrics(spark, sf):
        return rounded(E.with_metrics(E.confusion(_judged(spark, sf, method), 0.3)))


for _method in E.METHODS:
    _methods(_method)


def _class_rows():
    c = _confusion_sql(_SIDES, "0.3::DOUBLE * 255")
    one = "SELECT '{}' AS class, {h} AS h, {w} AS w, {m} AS m FROM ({c})"
    rows = one.format("no damage", h="tn", w="fn", m="fp", c=c) + " UNION ALL " + one.format("damaged", h="tp", w="fp", m="fn", c=c)
    scores = f"SELECT class, coalesce(h::DOUBLE / nullif(h + w, 0), 0) AS precision, coalesce(h::DOUBLE / nullif(h + m, 0), 0) AS recall, coalesce(2 * h::DOUBLE / nullif(2 * h + w + m, 0), 0) AS f1, h + m AS support FROM ({rows})"
    names = ("precision", "recall", "f1")
    macro = "SELECT 'macro avg', " + ", ".join(f"avg({n})" for n in names) + ", sum(support) FROM s"
    weighted = "SELECT 'weighted avg', " + ", ".join(f"sum({n} * support) / sum(support)" for n in names) + ", sum(support) FROM s"
    cols = ", ".join(f"round({n} + 1e-9, 6) + 0.0 AS {n}" for n in names)
    return f"SELECT class, {cols}, CAST(support AS BIGINT) AS support FROM (WITH s AS MATERIALIZED ({scores}) SELECT * FROM s UNION ALL {macro} UNION ALL {weighted})"


@query("class_report", sql(_class_rows(), "preds_labelled", "point_preds"))
def class_report(spark, sf):
    return rounded(E.class_report(E.confusion(_judged(spark, sf), 0.3)))


_GRID = f"SELECT 0.1::DOUBLE + i * 0.005::DOUBLE AS threshold FROM range({len(THRESHOLDS)}) g(i)"
_SWEEP_COUNTS = f"""SELECT threshold, count(*) FILTER (y_true = 1 AND coalesce(pred >= threshold * 255, false)) AS tp,
  count(*) FILTER (y_true = 0 AND coalesce(pred >= threshold * 255, false)) AS fp,
  count(*) FILTER (y_true = 0 AND NOT coalesce(pred >= threshold * 255, false)) AS tn,
  count(*) FILTER (y_true = 1 AND NOT coalesce(pred >= threshold * 255, false)) AS fn
  FROM ({_GRID}) CROSS JOIN ({_SIDES}) GROUP BY 1"""
_SWEEP = _metrics_sql(_SWEEP_COUNTS, "round(threshold + 1e-9, 6) + 0.0 AS threshold, ")


@query("threshold_sweep", sql(_SWEEP, "preds_labelled", "point_preds"))
def threshold_sweep(spark, sf):
    return rounded(E.threshold_sweep(_judged(spark, sf)))


# A raster under the buildings' positions: 3 x 3 windows, windows start with the years.
_YEAR_STARTS = [date(y, 1, 1) for y in D.YEARS]
_YEAR_EVENT = date(D.POSITIVE[0], 1, 1)
_SITES = "SELECT building_id AS unosat_id, adm1_id AS aoi, DATE '1995-01-01' + CAST(building_id * 37 % 2500 AS INT) AS date, lon, lat FROM buildings"
_SITE_VALUES = f"""SELECT unosat_id, date, y AS start_post, coalesce(max(value), 0) AS pred FROM ({_SITES}) s
  CROSS JOIN (VALUES {", ".join(f"(DATE '{d}')" for d in _YEAR_STARTS)}) w(y)
  LEFT JOIN pred_pixels p ON p.post_date = year(y) AND abs(p.cx - floor((lon - 22) / 0.01::DOUBLE)) <= 1 AND abs(p.cy - floor((lat - 44.4::DOUBLE) / 0.01::DOUBLE)) <= 1
  GROUP BY ALL"""
_SITE_SIDES = f"""SELECT 1 AS y_true, pred FROM ({_SITE_VALUES}) WHERE start_post >= date
  UNION ALL SELECT 0, pred FROM ({_SITE_VALUES}) WHERE start_post < DATE '{_YEAR_EVENT}'"""


@query("evaluate_raster", sql(_metrics_sql(_SWEEP_COUNTS.replace(_SIDES, _SITE_SIDES), "round(threshold + 1e-9, 6) + 0.0 AS threshold, "), "buildings", "pred_pixels"))
def evaluate_raster(spark, sf):
    """Raster and labels to the sweep: all points and windows, missing pixels as 0."""
    b = D.buildings(spark, sf)
    when = F.date_add(F.lit(date(1995, 1, 1)), (F.col("building_id") * 37 % 2500).cast("int"))
    labels = b.select(F.col("building_id").alias("unosat_id"), F.col("adm1_id").alias("aoi"), F.lit(1).alias("damage"), when.alias("date"), "lon", "lat")
    pixels = D.pred_pixels(spark, sf).withColumn("post_date", F.make_date("post_date", F.lit(1), F.lit(1)))
    values = V.point_values(pixels, labels, D.PIXEL_GRID, (0, 1799, 0, 799), _YEAR_STARTS, aois=None)
    return rounded(V.sweep_raster(values, _YEAR_STARTS, _YEAR_EVENT))


@query(
    "best_threshold",
    sql(
        f"""SELECT 'accuracy' AS metric, 0.45::DOUBLE AS target, CASE WHEN gap > 0 THEN threshold ELSE nxt END AS threshold FROM (
  SELECT *, accuracy - 0.45::DOUBLE AS gap, coalesce(lead(threshold) OVER (ORDER BY threshold), threshold) AS nxt FROM ({_SWEEP}))
  ORDER BY abs(gap), threshold LIMIT 1""",
        "preds_labelled", "point_preds",
    ),
)
def best_threshold(spark, sf):
    return rounded(E.best_threshold(rounded(E.threshold_sweep(_judged(spark, sf))), "accuracy", 0.45))
