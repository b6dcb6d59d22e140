import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from scarmap.config import THRESHOLDS
from scarmap.operators import evaluate as E
from scarmap.operators import regions as A

EVENT = date(2022, 2, 24)
STARTS = [date(2021, 2, 24), date(2021, 8, 24), date(2022, 2, 24), date(2022, 8, 24), date(2023, 2, 24)]
SCHEMA = "aoi string, unosat_id int, date date, start_post date, pred int"


def random_preds(spark, seed=1, n=40):
    rng = random.Random(seed)
    rows = []
    for p in range(n):
        d = rng.choice([None, EVENT + timedelta(days=rng.randint(-30, 500))])
        for s in STARTS:
            if rng.random() < 0.9:
                rows.append(("A", p, d, s, rng.randint(0, 255)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def by_hand(rows, threshold, method, year):
    """(y_true, y_pred) pairs from a table with one column per window; a missing value is not damaged."""
    table = {}
    for _, p, d, s, v in rows:
        table.setdefault(p, (d, {}))[1][s] = v
    out = []
    for d, values in table.values():
        if d is None:
            continue
        sides = {1: [s for s in STARTS if s >= d and (year is None or s.year == year)], 0: [s for s in STARTS if s < EVENT]}
        for y, starts in sides.items():
            got = [values.get(s, math.nan) for s in starts]
            if method != "date-wise":
                real = sorted(v for v in got if not math.isnan(v))
                if not real:
                    got = [math.nan]
                elif method.endswith("mean"):
                    got = [sum(real) / len(real)]
                else:
                    got = [(real[(len(real) - 1) // 2] + real[len(real) // 2]) / 2]
            out += [(y, int(v >= threshold * 255)) for v in got]
    return out


@pytest.mark.parametrize("method", E.METHODS)
@pytest.mark.parametrize("year", [None, 2022])
def test_confusion_and_metrics(spark, method, year):
    rows, df = random_preds(spark)
    want = by_hand(rows, 0.5, method, year)
    r = E.with_metrics(E.confusion(E.judged(df, STARTS, method, EVENT, year), 0.5)).first()
    counts = {"tp": want.count((1, 1)), "fp": want.count((0, 1)), "tn": want.count((0, 0)), "fn": want.count((1, 0))}
    assert {c: r[c] for c in counts} == counts
    tpr, tnr = counts["tp"] / (counts["tp"] + counts["fn"]), counts["tn"] / (counts["tn"] + counts["fp"])
    assert r.roc_auc == pytest.approx((tpr + tnr) / 2)
    assert r.accuracy == pytest.approx((counts["tp"] + counts["tn"]) / len(want))


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        E.judged(random_preds(spark)[1], STARTS, "weekly")


def test_metrics_with_empty_denominators(spark):
    r = E.with_metrics(spark.createDataFrame([(0, 0, 3, 0)], "tp long, fp long, tn long, fn long")).first()
    assert (r.precision, r.recall, r.f1, r.accuracy, r.roc_auc) == (0, 0, 0, 1, 0.5)


def test_sweep_equals_one_confusion_per_threshold(spark):
    _, df = random_preds(spark, 5)
    rows = E.judged(df, STARTS, "date-wise", EVENT, 2022)
    # values on and next to the limits
    edge = [(1, float(t * 255)) for t in THRESHOLDS] + [(0, math.nextafter(t * 255, 0)) for t in THRESHOLDS]
    rows = rows.unionByName(spark.createDataFrame(edge, "y_true int, pred double")).cache()
    sweep = E.threshold_sweep(rows).orderBy("threshold").collect()
    assert [r.threshold for r in sweep] == THRESHOLDS
    local = [(r.y_true, r.pred) for r in rows.collect()]
    for r in sweep:
        hits = [(y, p is not None and p >= r.threshold * 255) for y, p in local]
        assert (r.tp, r.fp, r.tn, r.fn) == tuple(hits.count(c) for c in ((1, True), (0, True), (0, False), (1, False)))
    recalls = [r.recall for r in sweep]
    assert recalls == sorted(recalls, reverse=True)


@pytest.mark.parametrize(
    "precisions, want", [([0.5, 0.85, 0.95, 0.99], 0.3), ([0.5, 0.6, 0.7, 0.8], 0.4), ([0.5, 0.6, 0.7, 0.9001], 0.4), ([0.5, 0.89, 0.93, 0.99], 0.3)]
)
def test_best_threshold(spark, precisions, want):
    sweep = spark.createDataFrame([(0.1 * (i + 1), p) for i, p in enumerate(precisions)], "threshold double, precision double")
    assert E.best_threshold(sweep).first().threshold == pytest.approx(want)


@pytest.mark.parametrize("thresholds", [[0.1, 0.11, 0.12, 0.13, 0.9], [0.5]])
def test_sweep_of_uneven_and_single_thresholds(spark, thresholds):
    rows = spark.createDataFrame([(1, v) for v in (20, 28, 30, 31, 128, 230, None)] + [(0, 29), (0, 127)], "y_true int, pred int")
    got = {round(r.threshold, 2): (r.tp, r.fp, r.tn, r.fn) for r in E.threshold_sweep(rows, thresholds).collect()}
    for t in thresholds:
        c = E.confusion(rows, t).first()
        assert got[round(t, 2)] == (c.tp, c.fp, c.tn, c.fn)
    with pytest.raises(ValueError):
        E.threshold_sweep(rows, [0.5, 0.5])


def test_class_report(spark):
    got = {r["class"]: r for r in E.class_report(spark.createDataFrame([(3, 1, 4, 2)], "tp long, fp long, tn long, fn long")).collect()}
    assert got["damaged"].precision == pytest.approx(3 / 4) and got["damaged"].recall == pytest.approx(3 / 5) and got["damaged"].support == 5
    assert got["no damage"].precision == pytest.approx(4 / 6) and got["no damage"].support == 5
    assert got["macro avg"].recall == pytest.approx((3 / 5 + 4 / 5) / 2) and got["weighted avg"].support == 10


def test_mean_over_orbits_then_cut(spark):
    df = spark.createDataFrame([("A", 1, 7, EVENT, 0.2), ("A", 1, 8, EVENT, 0.4)], "aoi string, unosat_id int, orbit int, start_post date, classification double")
    assert E.point_predictions(df).first().pred == 76
    wide = E.wide_predictions(E.point_predictions(df), STARTS)
    assert wide.columns == ["unosat_id", "aoi", *[f"pred_{s}" for s in STARTS]]


def test_damage_predicate(spark):
    nan = float("nan")
    rows = [
        ("hit", 10.0, 10.0, 167.025, None, 51.0),
        ("below", 10.0, 10.0, 167.0, 100.0, 60.0),
        ("dirty before", 10.0, 168.0, 200.0, 200.0, 60.0),
        ("missing before", None, 10.0, 200.0, 200.0, 60.0),
        ("nan before", nan, 10.0, 200.0, 200.0, 60.0),
        ("nan after", 10.0, 10.0, nan, None, 60.0),
        ("nan and hit", 10.0, 10.0, nan, 168.0, 60.0),
        ("small", 10.0, 10.0, 200.0, 200.0, 50.0),
    ]
    df = spark.createDataFrame(rows, "n string, pred_1 double, pred_2 double, pred_3 double, pred_4 double, area double")
    assert sorted(r.n for r in df.where(A.is_damaged([1, 2], [3, 4])).collect()) == ["hit", "nan and hit"]


def test_region_without_buildings(spark):
    preds = spark.createDataFrame([("r1", 10.0, 200.0, 60.0), ("r1", 10.0, 20.0, 60.0), ("r2", 10.0, 200.0, 10.0)], "adm3_id string, pred_1 double, pred_2 double, area double")
    regions = spark.createDataFrame([("r1",), ("r2",)], "adm3_id string")
    counts = A.count_per_region(preds, "adm3_id", A.is_damaged([1], [2]))
    got = {r.adm3_id: (r.n_buildings_damaged, r.n_buildings, r.perc_destroyed) for r in A.damage_rate(regions, counts, "adm3_id").collect()}
    assert got == {"r1": (1, 2, 50.0), "r2": (0, None, None)}


def test_same_district_name_in_two_regions(spark):
    adm1 = spark.createDataFrame([("1_0", "N"), ("1_1", "S")], "admin_id string, ADM1_EN string")
    adm2 = spark.createDataFrame([("2_0", "N", "D"), ("2_1", "S", "D")], "admin_id string, ADM1_EN string, ADM2_EN string")
    adm3 = spark.createDataFrame([("3_0", "N", "D", "a"), ("3_1", "S", "D", "b")], "admin_id string, ADM1_EN string, ADM2_EN string, ADM3_EN string")
    got = {r.adm3_id: (r.adm1_id, r.adm2_id) for r in A.admin_hierarchy(adm1, adm2, adm3).collect()}
    assert got == {"3_0": ("1_0", "2_0"), "3_1": ("1_1", "2_1")}
