"""What a task holds and what is moved must not grow faster than the tables."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.series_queries import Step
from scarmap import cluster
from scarmap.config import Period, RunConfig
from scarmap.functions import geometry as G
from scarmap.operators import cells as K
from scarmap.operators import cover as C
from scarmap.operators import labels as L
from scarmap.operators import raster as R
from scarmap.operators import zonal as Z
from scarmap.operators.raster import Grid
from scarmap.plans import buildings as B
from scarmap.plans import inference
from scarmap.sources.readers import with_geometry

NEAR = Grid(-180.0, -90.0, 0.0005, 0.0005)


def boxes(spark, rows, schema):
    """Rows that end with (minx, miny, width, height), as polygons."""
    shapes = [(*keys, [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]) for *keys, (x, y, w, h) in rows]
    return with_geometry(spark.createDataFrame(shapes, f"{schema}, rings {G.RINGS_DDL}"))


def test_many_points_meet_edges_without_a_table_of_pairs(spark, monkeypatch):
    rng = random.Random(5)
    shapes = boxes(spark, [(k % 35 if k < 40 else None, (30 + rng.random() * 0.01, 50 + rng.random() * 0.01, rng.random() * 0.01, 0.001)) for k in range(42)], "building_id int")
    points = spark.createDataFrame([(i, 30 + rng.random() * 0.02, 50 + rng.random() * 0.01) for i in range(300)] * 2, "id int, lon double, lat double")
    rows = lambda: sorted(tuple(r) for r in C.points_near_polygons(points, shapes, ["building_id"], NEAR, 5.0).select("id", "building_id").collect())
    want = rows()  # few points: by pairs
    monkeypatch.setattr(C, "FEW_POINTS_BYTES", 0)
    assert rows() == want and want  # keys that repeat or are null count as before

    def refused(*_):
        raise AssertionError("pairs are written")

    monkeypatch.setattr(C, "checked_broadcast", refused)
    once = shapes.where("building_id > 4")
    got = C.points_near_polygons(points, once, ["building_id"], NEAR, 5.0).select("id", "building_id").collect()
    assert sorted(tuple(r) for r in got) == [r for r in want if r[1] > 4]


def test_the_worst_label_is_found_without_rows_of_pairs(spark, monkeypatch):
    rng = random.Random(6)
    shapes = boxes(spark, [(k, (30 + k % 6 * 0.004, 50 + k // 6 * 0.004, 0.003 * (1 + k % 3), 0.003)) for k in range(30)], "building_id int")
    aois = boxes(spark, [("A", (29.9, 49.9, 0.11, 1)), ("B", (30.015, 49.9, 1, 1))], "aoi string")
    labels = [(f"u{i:04}", rng.choice(["A", "B", "C", None]), rng.choice([1, 2, 3, None]), date(2022, 3, 1 + i % 28), 30 + rng.random() * 0.03, 50 + rng.random() * 0.03) for i in range(900)]
    labels = spark.createDataFrame(labels, "unosat_id string, aoi string, damage int, date date, lon double, lat double")
    near = labels.crossJoin(shapes).where(G.within_metres(F.col("edges"), F.col("lon"), F.col("lat"), 5.0)).select("unosat_id", "damage", "date", "aoi", "building_id")
    want = L.worst_label_per_building(near.join(B.buildings_in_aoi(shapes, aois), ["building_id", "aoi"], "left_semi"))
    want = sorted(want.collect(), key=str)
    assert len(want) > 20
    for few, pieces in ((0, 1_000), (0, 20), (8 << 20, 1_000)):
        monkeypatch.setattr(C, "FEW_POINTS_BYTES", few)
        monkeypatch.setattr(C, "MAX_PIECES", pieces)
        assert sorted(B.worst_labels(shapes, labels, aois).collect(), key=str) == want
    monkeypatch.setattr(B, "labels_near_buildings", None)  # makes a row of every label that is near
    assert B.worst_labels(shapes, labels, aois).count() == len(want)
    found = C.first_points_near(labels, shapes, ["building_id"], NEAR, 5.0, ["damage", "unosat_id"])
    assert found.count() < near.count() / 5


def test_images_of_no_period_are_not_smoothed(spark, monkeypatch):
    rows = [(s, s % 2, date(1996 + s % 4, 1, 5), "0", x, y, 1.0) for s in range(80) for x in range(2) for y in range(2)]
    pixels = spark.createDataFrame(rows, "scene_id int, orbit int, ts date, qk string, cx int, cy int, B2 double")
    pre, post = Period.of("1996-01-01", "1996-02-01"), Period.of("1998-01-01", "1998-02-01")
    cfg = RunConfig(s1_bands=["B2"], pre=[pre], post=[post], reducers=["mean"], window=["3x3"])
    smoothed, smooth = [], R.focal_mean
    monkeypatch.setattr(R, "focal_mean", lambda p, *args, **more: smoothed.append(p.count()) or smooth(p, *args, **more))
    scenes = pixels.select("qk", "scene_id", "orbit", "ts").distinct()
    got = inference.predict_area(pixels, scenes, Step("B2_post_3x3_mean", 0.5), cfg, cfg.post).collect()
    assert {(r.cx, r.cy): r.value for r in got} == {(x, y): 0.75 for x in range(2) for y in range(2)}
    assert smoothed == [len(rows) // 2]


def test_overlapping_tiles_are_settled_per_cell(spark, monkeypatch):
    shapes = boxes(spark, [(k, (k % 5 + 0.5, 0.0, 3.0, 2.0)) for k in range(40)], "building_id int")
    tiles = spark.createDataFrame([(x, y, 1999, qk, 10.0 * x + int(qk)) for x in range(9) for y in range(2) for qk in ("0", "1")], "cx int, cy int, post_date int, qk string, value double")
    held, settled = [], R.mosaic
    monkeypatch.setattr(R, "mosaic", lambda *args, **more: held.append(settled(*args, **more)) or held[-1])
    got = {r.building_id: r.pred_1999 for r in B.predictions_to_buildings(shapes, tiles, Grid(0.0, 0.0, 1.0, 1.0), [1999]).collect()}
    assert got == {k: pytest.approx(10 * (k % 5) + 16) for k in range(40)}
    assert held[0].count() == 8 * 2 + 2  # cells near buildings, not their overlaps


def test_more_overlaps_are_joined_in_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "TASK_ROWS", 50)
    shapes = boxes(spark, [(k, (k % 5 + 0.5, 0.5, 3.0, 2.0)) for k in range(40)], "building_id int")
    pixels = spark.createDataFrame([(x, y, 1999, 1.0) for x in range(9) for y in range(4)], "cx int, cy int, post_date int, value double")
    grid = Grid(0.0, 0.0, 1.0, 1.0)
    assert Z.pixels_x_buildings(shapes, pixels, grid).rdd.getNumPartitions() == 40 * 4 * 3 // 50 + 1
    assert Z.zonal_stats(shapes, pixels, grid).where("abs(weighted_mean - 1) < 1e-9 and max = 1").count() == 40


def test_whole_polygons_meet_once_without_a_deduplication(spark, monkeypatch):
    rng = random.Random(8)
    some = lambda n, wide: [(rng.random() * 4, rng.random() * 4, rng.random() * wide, rng.random() * wide) for _ in range(n)]
    ring = lambda x, y, n: [(x + math.cos(t) * (1 + k % 2), y + math.sin(t) * (1 + k % 2)) for k in range(n) for t in [2 * math.pi * k / n]]
    many = with_geometry(spark.createDataFrame([(k, [[*(r := ring(k % 4, 2, 40)), r[0]]]) for k in (2, 90, 91)], f"k int, rings {G.RINGS_DDL}"))
    left = boxes(spark, [(k if k else None, b) for k, b in enumerate(some(60, 0.9))], "k int")
    right = boxes(spark, [(k if k else None, b) for k, b in enumerate(some(30, 2.0))], "k int")
    grid = Grid(0.0, 0.0, 0.4, 0.3)

    def both(a, b):
        b = b.withColumnRenamed("k", "o")
        got = [tuple(r) for r in C.polygons_meeting(a, ["k"], C.cell_cover(b, ["o"], grid, whole=C.FEW_EDGES), grid).collect()]
        pairs = a.select("k", F.col("edges").alias("a")).crossJoin(b.select("o", "edges")).where(G.intersects(F.col("a"), F.col("edges")))
        want = {tuple(r) for r in pairs.select("k", "o").collect()}
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 20

    twice = left.limit(5).unionByName(left)
    for a, b in ((left.unionByName(many), right), (twice, right.unionByName(many))):
        both(a, b)

    def refused(*_):
        raise AssertionError("pairs are found cell by cell and deduplicated")

    monkeypatch.setattr(C, "_pieces_meeting", refused)
    for listed, at_once in ((1_000, 1 << 18), (2, 3)):
        monkeypatch.setattr(K, "MAX_LISTED", listed)
        monkeypatch.setattr(K, "PAIRS", at_once)
        both(left, right)
        both(boxes(spark, [(k, (0.1, 0.1, 0.1, 0.1)) for k in range(9)], "k int"), boxes(spark, [(k, (0.0, 0.0, 0.3, 0.2)) for k in range(9)], "k int"))


def test_buildings_meet_areas_as_whole_polygons(spark, monkeypatch):
    shapes = boxes(spark, [(k, (k * 0.01, 0.0, 0.03, 0.03)) for k in range(40)], "building_id int")
    aois = boxes(spark, [("A", (0.0, 0.0, 0.1, 1.0)), ("B", (0.2, 0.0, 0.2, 1.0))], "aoi string")
    monkeypatch.setattr(C, "_pieces_meeting", None)
    got = {tuple(r) for r in B.buildings_in_aoi(shapes, aois).collect()}
    assert {k for k, a in got if a == "A"} == set(range(11)) and {k for k, a in got if a == "B"} == set(range(17, 40))


def test_many_points_are_tested_in_arrays(spark, monkeypatch):
    rng = random.Random(9)
    lon, lat = 30.0, 50.0
    at = lambda: (lon + rng.random() * 0.004, lat + rng.random() * 0.004)
    shapes = boxes(spark, [(k, (*at(), rng.random() * 0.002, rng.random() * 0.001)) for k in range(30)], "building_id int")
    turn = [2 * math.pi * k / 40 for k in range(40)] + [0.0]
    large = with_geometry(spark.createDataFrame([(99, [[(lon + 0.002 + math.cos(t) * 0.001, lat + 0.002 + math.sin(t) * 0.001) for t in turn]])], f"building_id int, rings {G.RINGS_DDL}"))
    corners = [(r.x, r.y) for r in shapes.select(F.explode(F.flatten("rings")).alias("p")).select("p.*").collect()]
    places = [at() for _ in range(150)] + [(x + rng.uniform(-1, 1) * 1e-4, y + rng.uniform(-1, 1) * 1e-4) for x, y in corners] + [(None, lat), (lon, None)]
    points = spark.createDataFrame([(f"u{i}", date(2022, 3, 1), x, y) for i, (x, y) in enumerate(places)], "id string, day date, lon double, lat double")
    monkeypatch.setattr(C, "FEW_POINTS_BYTES", 0)

    def rows(shapes):
        near = points.crossJoin(shapes).where(G.within_metres(F.col("edges"), F.col("lon"), F.col("lat"), 5.0))
        want = sorted(tuple(r) for r in near.select(*points.columns, "building_id").collect())
        got = C.points_near_polygons(points, shapes, ["building_id"], NEAR, 5.0)
        assert got.columns == [*points.columns, "building_id"]
        assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100

    rows(shapes.unionByName(large))

    monkeypatch.setattr(G, "within_metres", lambda *_: F.raise_error(F.lit("pairs are tested one by one")).cast("boolean"))
    got = C.points_near_polygons(points, shapes, ["building_id"], NEAR, 5.0).select("id", "building_id")
    found = sorted(tuple(r) for r in got.collect())
    monkeypatch.undo()
    monkeypatch.setattr(C, "FEW_POINTS_BYTES", 0)
    monkeypatch.setattr(K, "MAX_LISTED", 3)
    again = C.points_near_polygons(points, shapes, ["building_id"], NEAR, 5.0).select("id", "building_id").collect()
    assert sorted(tuple(r) for r in again) == found and len(found) > 100
