import random
import statistics
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from scarmap.config import POST_QUARTERS, POST_YEARS, REDUCERS, Period, RunConfig, feature_names, period_name
from scarmap.functions import values as V
from scarmap.operators import labels as L
from scarmap.operators import quantiles
from scarmap.operators import raster as R
from scarmap.operators import scenes as S
from scarmap.operators import series as T

KEYS = ["aoi", "unosat_id", "orbit"]
PRE, POST = [Period.of("2024-01-01", "2024-01-08")], [Period.of("2024-01-08", "2024-01-12"), Period.of("2024-01-13", "2024-01-17")]


def series(spark, rows):
    return spark.createDataFrame(rows, "aoi string, unosat_id int, orbit int, ts timestamp_ntz, VV double")


def test_period_start_is_in_and_end_is_out(spark):
    days = ["2024-01-01 00:00:00", "2024-01-07 23:59:59", "2024-01-08 00:00:00", "2024-01-12 00:00:00", "2024-01-12 12:00:00", "2024-01-13 00:00:00"]
    df = series(spark, [("A", 1, 0, datetime.fromisoformat(d), float(i)) for i, d in enumerate(days)])
    got = T.period_features(df, KEYS, ["VV"], PRE, POST, ["mean", "max"], count_as="n").orderBy("start_post").collect()
    assert [(r.n_pre, r.n_post, r.VV_pre_1x1_max, r.VV_post_1x1_max) for r in got] == [(2, 1, 1.0, 2.0), (2, 1, 1.0, 5.0)]


def test_empty_period_gives_nulls_and_zero_count(spark):
    df = series(spark, [("A", 1, 0, datetime(2024, 1, 2), 1.0), ("A", 2, 0, datetime(2024, 2, 2), 1.0)])
    got = T.period_features(df, KEYS, ["VV"], PRE, POST, REDUCERS, count_as="n").collect()
    assert len(got) == 2 and {r.unosat_id for r in got} == {1}
    assert all(r.n_post == 0 and r.VV_post_1x1_mean is None and r.VV_pre_1x1_median == 1.0 for r in got)
    assert all(r.VV_pre_1x1_skew is None for r in got)


def test_statistics(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 4, 9)], "k int, v double")
    r = T.reduce_groups(df, ["k"], ["v"], REDUCERS).first()
    assert (r.v_mean, r.v_median, r.v_min, r.v_max) == (4, 3, 1, 9)
    assert r.v_stdDev == pytest.approx(statistics.pstdev([1, 2, 4, 9]))
    assert r.v_skew == pytest.approx(0.7684, abs=1e-4)
    with pytest.raises(ValueError):
        T.reducers(["mode"], "v")


@pytest.mark.parametrize("limit", [5, 60])
def test_medians_of_large_groups(spark, limit):
    rng = random.Random(7)
    rows = [(k if k else None, rng.choice([rng.gauss(0, 1e6), rng.random(), 3.0, 3.0, None]), rng.gauss(5, 1)) for k in (0, 1, 2) for _ in range(150 + 151 * k)]
    rows += [(9, None, 1.0)] * 100 + [(8, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, v double, w double")
    got = {r.k: (r.v_median, r.w_median) for r in quantiles.large_medians(df, df.groupBy("k").agg(*quantiles.sketches(["v", "w"])), ["k"], ["v", "w"], limit).collect()}
    for k in {r[0] for r in rows}:
        for i, m in enumerate(got[k]):
            values = [r[i + 1] for r in rows if r[0] == k and r[i + 1] is not None]
            assert m == (pytest.approx(statistics.median(values)) if values else None), (k, i)


def test_hot_and_ordinary_groups_together(spark):
    rng = random.Random(3)
    rows = [(None if k == 0 else k, rng.random(), rng.gauss(0, 3) if i % 9 else None) for k in range(6) for i in range(2000 if k < 2 else 30)]
    df = spark.createDataFrame(rows, "k int, v double, w double")
    plain = T.reduce_groups(df, ["k"], ["v", "w"], REDUCERS, count_as="n")
    split = T.reduce_groups(df, ["k"], ["v", "w"], REDUCERS, count_as="n", hot_rows=500)
    a, b = ({r.k: r for r in x.collect()} for x in (plain, split))
    assert plain.columns == split.columns and a.keys() == b.keys() and len(a) == 6
    for k in a:
        assert list(a[k]) == pytest.approx(list(b[k]))


def test_one_shuffle_for_all_features(spark):
    rows = [("A", i % 5, i % 2, datetime(2024, 1, 1 + i % 16), float(i)) for i in range(200)]
    plan = T.period_features(series(spark, rows), KEYS, ["VV"], PRE, POST, REDUCERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_fill_gaps(spark):
    df = series(spark, [("A", 1, 0, datetime(2024, 1, i), v) for i, v in ((1, 2.0), (2, None), (3, 4.0))] + [("A", None, 0, datetime(2024, 1, 1), None), ("A", None, 0, datetime(2024, 1, 2), 7.0)])
    got = sorted(r.VV for r in T.fill_gaps(df, KEYS, ["VV"]).collect())
    assert got == [2.0, 3.0, 4.0, 7.0, 7.0]


def test_label_by_time(spark):
    points = spark.createDataFrame([(1, "A", date(2024, 1, 9)), (2, "A", date(2024, 2, 1)), (3, "A", None)], "unosat_id int, aoi string, date date")
    got = {(r.unosat_id, str(r.start_post)): r.label for r in L.label_windows(points, PRE, POST, date(2024, 1, 12)).collect()}
    assert got == {(1, "2024-01-08"): 0, (2, "2024-01-08"): 0, (3, "2024-01-08"): 0, (1, "2024-01-13"): 1}


LABELS = "unosat_id string, place int, aoi string, damage int, ep int, date date"


def labels(spark):
    d = date(2022, 3, 1)
    return spark.createDataFrame(
        [("b", 1, "A", 3, 2, d), ("a", 1, "A", 1, 2, d), ("c", 1, "A", 1, 1, d), ("e", 2, "B", 2, 1, d), ("d", 2, "B", 4, 3, d), ("f", 3, "A", 2, None, d)], LABELS
    )


def test_dedupe_then_filter(spark):
    ids = lambda df: sorted(r.unosat_id for r in df.collect())
    assert ids(L.dedupe_labels(labels(spark), ["place"], "last")) == ["a", "d", "f"]
    assert ids(L.dedupe_labels(labels(spark), ["place"], "min")) == ["a", "e", "f"]
    # place 2: the newest label is class 4, so the place is gone; filtering first would keep "e"
    assert ids(L.labels_for(labels(spark), ["place"])) == ["a", "f"]
    assert ids(L.labels_for(labels(spark), ["place"], "B", None)) == ["d"]
    assert ids(L.labels_for(labels(spark), ["place"], classes=None, how=None)) == list("abcdef")
    with pytest.raises(ValueError):
        L.dedupe_labels(labels(spark), ["place"], "first")


def test_worst_label_is_one_whole_row(spark):
    hits = spark.createDataFrame(
        [(7, 1, "y", date(2022, 5, 1), "A"), (7, 1, "x", None, "B"), (7, 3, "a", date(2022, 1, 1), "A")],
        "building_id int, damage int, unosat_id string, date date, aoi string",
    )
    r = L.worst_label_per_building(hits).first()
    assert (r.unosat_damage, r.unosat_id, r.unosat_date, r.unosat_aoi) == (1, "x", None, "B")


def test_orbits_need_enough_images_in_both_periods(spark):
    rows = []
    for orbit, (a, b) in enumerate([(4, 6), (5, 5), (6, 4), (6, 6)]):
        rows += [(orbit, datetime(2024, 1, 2, i)) for i in range(a)] + [(orbit, datetime(2024, 1, 9, i)) for i in range(b)]
    scenes = spark.createDataFrame(rows, "orbit int, ts timestamp_ntz")
    assert sorted(r.orbit for r in S.orbit_counts(scenes, [PRE[0], POST[0]]).collect()) == [1, 3]
    assert S.on_common_orbits(scenes, scenes, [PRE[0], POST[0]]).select("orbit").distinct().count() == 2


def test_bad_orbit_is_dropped_for_its_area_only(spark):
    packed = spark.createDataFrame([("36,87,109,160", 36, "UKR8"), ("36,87,109,160", 36, "UKR9")], "valid_orbits string, best_orbit int, aoi string")
    got = {r.aoi: r.valid_orbits for r in S.valid_orbits(packed).collect()}
    assert got == {"UKR8": [36, 87, 160], "UKR9": [36, 87, 109, 160]}
    assert S.aoi_orbits(S.valid_orbits(packed)).count() == 7


def test_clouds_without_score_mask_the_pixel(spark):
    px = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 4.0)], "scene_id int, B1 double")
    cs = spark.createDataFrame([(1, 0.6), (2, 0.59)], "scene_id int, cs double")
    got = {r.scene_id: r.B1 for r in S.mask_clouds(S.link_scores(px, cs, ["scene_id"]), ["B1"]).collect()}
    assert got == {1: 2.0, 2: None, 3: None}


def test_focal_mean_across_block_edges(spark):
    rng = random.Random(2)
    cells = {(x, y): rng.choice([None, rng.random()]) for x in range(-4, 5) for y in range(250, 262) if rng.random() < 0.8}
    df = spark.createDataFrame([(1, x, y, v) for (x, y), v in cells.items()], "scene_id int, cx int, cy int, v double")
    got = {(r.cx, r.cy): r.v for r in R.focal_mean(df, ["scene_id"], ["v"]).collect()}
    assert got.keys() == cells.keys()
    for x, y in cells:
        near = [cells.get((x + i, y + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        near = [v for v in near if v is not None]
        assert got[x, y] == (pytest.approx(sum(near) / len(near)) if near else None)


def test_nearest_outside_the_raster_takes_the_edge(spark):
    grid = R.Grid(0.0, 0.0, 1.0, 1.0)
    px = spark.createDataFrame([(x, y, date(2022, 1, 1), float(10 * x + y)) for x in range(3) for y in range(3)], "cx int, cy int, post_date date, value double")
    pts = spark.createDataFrame([("in", 1.2, 1.9), ("west", -5.0, 0.5), ("corner", 9.0, 9.0)], "id string, lon double, lat double")

    def values(size, how):
        return {r.id: r.value for r in R.nearest_values(pts, px, grid, (0, 2, 0, 2), ["id"], size=size, how=how).collect()}

    assert values(1, "mean") == {"in": 11, "west": 0, "corner": 22}
    assert values(3, "max") == {"in": 22, "west": 11, "corner": 22}
    assert values(3, "mean") == {"in": 11, "west": 5.5, "corner": 16.5}
    with pytest.raises(ValueError):
        R.nearest_values(pts, px, grid, (0, 2, 0, 2), ["id"], how="sum")


def test_mosaic_and_orbits(spark):
    df = spark.createDataFrame([(1, 1, 1, 5.0), (1, 1, 2, 3.0), (2, 1, 1, 7.0)], "cx int, cy int, tile int, value double")
    assert {r.cx: r.value for r in R.mosaic(df, ["cx", "cy"], "tile").collect()} == {1: 3.0, 2: 7.0}
    assert {r.cx: r.value for r in R.combine_orbits(df, ["cx"], "median").collect()} == {1: 4.0, 2: 7.0}
    with pytest.raises(ValueError):
        R.combine_orbits(df, ["cx"], "mode")


def test_a_missing_value_never_wins_a_mosaic(spark):
    rows = spark.createDataFrame([(0, 0, 1, 5.0), (0, 0, 2, None), (1, 0, 1, None)], "cx int, cy int, tile int, value double")
    assert {r.cx: r.value for r in R.mosaic(rows, ["cx", "cy"], "tile").collect()} == {0: 5.0, 1: None}


def test_points_without_a_pixel_are_kept(spark):
    grid = R.Grid(0.0, 0.0, 1.0, 1.0)
    points = spark.createDataFrame([("a", 0.5, 0.5), ("b", 5.5, 5.5)], "id string, lon double, lat double")
    pixels = spark.createDataFrame([(0, 0, 1, 7.0)], "cx int, cy int, post_date int, value double")
    got = {(r.id, r.post_date): r.value for r in R.nearest_values(points, pixels, grid, (0, 9, 0, 9), ["id"], dates=[1, 2], fill=0.0).collect()}
    assert got == {("a", 1): 7.0, ("a", 2): 0.0, ("b", 1): 0.0, ("b", 2): 0.0}
    assert {(r.id, r.value) for r in R.nearest_values(points, pixels, grid, (0, 9, 0, 9), ["id"]).collect()} == {("a", 7.0), ("b", None)}


def test_quantise_cuts_the_fraction(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.9999,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(V.quantised(F.col("p"))).collect()] == [0, 127, 254, 255, None]


def test_names_and_config():
    assert feature_names(["VV"], "1x1", ["mean", "max"]) == ["VV_pre_1x1_mean", "VV_pre_1x1_max", "VV_post_1x1_mean", "VV_post_1x1_max"]
    assert len(RunConfig().features) == 28
    assert len(RunConfig(s1_bands=None, s2_bands=[]).features) == 168
    assert RunConfig().sensors == "s1" and RunConfig(s2_bands=[]).sensors == "s1_s2"
    assert period_name(POST_QUARTERS) == "3months" and period_name(POST_YEARS) == "1year"
    with pytest.raises(ValueError):
        RunConfig(s1_bands=None).sensors


def test_hot_groups_are_evaluated_twice(spark):
    names = ["mean", "stdDev", "median", "min", "max", "skew", "kurtosis"]
    rows = spark.range(6000).select((F.col("id") % 7 % 3).alias("k"), (F.col("id") * 7919 % 1009).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, F.sqrt("id")).alias("b"))
    times = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            times.add(batch.num_rows)
            yield batch

    seen = rows.mapInArrow(count, rows.schema)
    got = T.reduce_groups(seen, ["k"], ["a", "b"], names, hot_rows=2000)
    got.write.format("noop").mode("overwrite").save()
    assert times.value == 2 * 6000  # the keys' counts, then the rows that are written
    columns = [c for c in got.columns if c != "k"]
    whole = {r.k: r for r in T.reduce_groups(rows, ["k"], ["a", "b"], names, hot_rows=None).collect()}
    for r in got.collect():
        assert [r[c] for c in columns] == pytest.approx([whole[r.k][c] for c in columns])


@pytest.mark.parametrize("radius", [1, 3, 10, 300])
def test_focal_mean_is_the_mean_of_the_window(spark, radius):
    rng = random.Random(radius)
    cells = {(s, x, y): rng.choice([None, rng.uniform(-30, 5), 4.0]) for s in (1, None) for x in range(-20, 12) for y in range(250, 268) if rng.random() < 0.7}
    df = spark.createDataFrame([(*k, v, v and -v, f"p{k[1]}") for k, v in cells.items()], "s int, cx int, cy int, a double, b double, p string")
    got = {(r.s, r.cx, r.cy): (r.a, r.b, r.p) for r in R.focal_mean(df, ["s"], ["a", "b"], radius, ["p"]).collect()}
    assert got.keys() == cells.keys()
    for (s, x, y), (a, b, p) in got.items():
        window = [v for (t, i, j), v in cells.items() if t == s and abs(i - x) <= radius and abs(j - y) <= radius and v is not None]
        assert p == f"p{x}" and (a is None) == (not window)
        if window:
            assert a == pytest.approx(sum(window) / len(window), abs=1e-9) and b == pytest.approx(-a, abs=1e-9)


def test_focal_mean_keeps_odd_values_in_their_windows(spark):
    rows = [(1, x, 0, float("nan") if x == 0 else float("inf") if x == 10 else 1.0) for x in range(20)] + [(2, 0, 0, 7.0), (2, 0, 0, 9.0)]
    got = {(r.s, r.cx): r.v for r in R.focal_mean(spark.createDataFrame(rows, "s int, cx int, cy int, v double"), ["s"], ["v"]).collect()}
    assert got[1, 0] != got[1, 0] and got[1, 1] != got[1, 1] and got[1, 10] == float("inf") == got[1, 9]
    assert all(got[1, x] == pytest.approx(1.0) for x in range(20) if x not in (0, 1, 9, 10, 11)) and got[2, 0] == pytest.approx(8.0)
    assert R.focal_mean(spark.createDataFrame([], "s int, cx int, cy int, v double"), ["s"], ["v"]).count() == 0


def test_a_wide_focal_mean_takes_little_longer(spark):
    rng = random.Random(0)
    n = 256
    cells = spark.createDataFrame([(1, i % n, i // n, rng.random()) for i in range(n * n)], "s int, cx int, cy int, v double").repartition(1)
    took = {}
    for radius in (1, 10, 1, 10, 1, 10):
        began = time.time()
        assert R.focal_mean(cells, ["s"], ["v"], radius).count() == n * n
        took[radius] = min(took.get(radius, 99), time.time() - began)
    assert took[10] < 2 * took[1] + 0.3
