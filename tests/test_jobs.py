"""Sources, sinks and whole jobs on small made-up worlds."""

import json
import os
import pathlib
import random
import re
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scarmap.config import OBSERVED, POST_QUARTERS, PRE, Period, RunConfig
from scarmap.functions import geometry as G
from scarmap.functions import tiles as T
from scarmap.operators import cover as C
from scarmap.operators import model as M
from scarmap.operators import scenes as S
from scarmap.operators.raster import Grid
from scarmap.operators.tiles import tiles_of_boxes
from scarmap.operators.zonal import pixels_near
from scarmap.plans import buildings as B
from scarmap.plans import experiment as X
from scarmap.plans import inference as I
from scarmap.plans.stages import Stages
from scarmap.sources import readers as R
from scarmap.sources import writers as W

CELLS = 12


def feature(properties, kind, coordinates):
    return json.dumps({"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}})


def box(x, y, w, h):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


def test_geojson_collection_with_one_feature_per_line(spark, tmp_path):
    lines = [
        '{ "type": "FeatureCollection", "name": "labels", "features": [',
        feature({"unosat_id": "u1", "aoi": "UKR1", "damage": 1, "date": "2022-03-14", "ep": 2}, "Point", [30.5, 50.25]) + ",",
        feature({"unosat_id": "u2", "aoi": "UKR5", "damage": 3, "date": None, "ep": 1}, "Point", [31, 49]),
        "]}",
    ]
    (tmp_path / "labels.geojson").write_text("\n".join(lines))
    rows = R.scan_labels(spark, str(tmp_path / "labels.geojson")).orderBy("unosat_id").collect()
    assert [tuple(r) for r in rows] == [("u1", "UKR1", 1, date(2022, 3, 14), 2, 30.5, 50.25), ("u2", "UKR5", 3, None, 1, 31.0, 49.0)]
    labels = R.scan_labels(spark, str(tmp_path / "labels.geojson"))
    assert R.scan_labels_by_aoi(labels, "UKR5").count() == 0 and R.scan_labels_by_aoi(labels, "UKR5", True).count() == 1


def test_polygons_of_both_kinds_and_any_orientation(spark, tmp_path):
    outer, hole = box(0, 0, 4, 4), box(1, 1, 2, 2)
    lines = [
        feature({"aoi": "a"}, "Polygon", [outer[::-1], hole]),
        feature({"aoi": "b"}, "MultiPolygon", [[outer, hole[::-1]], [box(9, 9, 1, 1)[::-1]]]),
    ]
    (tmp_path / "aois.geojson").write_text("\n".join(lines))
    aois = R.scan_aois(spark, str(tmp_path / "aois.geojson"))
    got = {r.aoi: r.a for r in aois.select("aoi", G.area(F.col("edges")).alias("a")).collect()}
    assert got == {"a": pytest.approx(12), "b": pytest.approx(13)}
    assert R.aoi_geometry(aois, "b").first().bbox.maxx == 10

    W.write_geojson(aois, str(tmp_path / "out"), W.polygon_geometry(), ["aoi"])
    back = R.scan_aois(spark, str(tmp_path / "out"))
    assert {r.aoi: r.a for r in back.select("aoi", G.area(F.col("edges")).alias("a")).collect()} == got
    written = sorted(spark.read.text(str(tmp_path / "out")).collect())
    assert [len(json.loads(r.value)["geometry"]["coordinates"]) for r in written] == [1, 2]


def test_admin_and_country(spark, tmp_path):
    lines = [feature({"row_id": i, "ADM1_EN": "N", "ADM2_EN": f"D'{i}"}, "Polygon", [box(i, 0, 1, 1)]) for i in range(3)]
    (tmp_path / "adm2.geojson").write_text("\n".join(lines))
    got = R.scan_admin(spark, str(tmp_path / "adm2.geojson"), 2)
    assert {(r.admin_id, r.ADM2_EN) for r in got.collect()} == {("2_0", "D'0"), ("2_1", "D'1"), ("2_2", "D'2")}
    (tmp_path / "c.geojson").write_text(feature({"name": "Land"}, "Polygon", [box(0, 0, 3, 1)]) + "\n" + feature({"name": "Other"}, "Polygon", [box(5, 5, 1, 1)]))
    assert R.country_boundary(spark, str(tmp_path / "c.geojson"), "Land").count() == 1


def test_orbits_csv(spark, tmp_path):
    (tmp_path / "orbits.csv").write_text('valid_orbits,best_orbit,aoi\n"43,94",43,UKR1\n"36,87,109,160",36,UKR8\n')
    got = {(r.aoi, r.orbit) for r in S.aoi_orbits(R.scan_orbits(spark, str(tmp_path / "orbits.csv"))).collect()}
    assert got == {("UKR1", 43), ("UKR1", 94), ("UKR8", 36), ("UKR8", 87), ("UKR8", 160)}


def test_building_scan_pushes_the_box_down(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("id"),
        F.struct(*[(F.col("id") + d).cast("double").alias(n) for n, d in (("minX", 0), ("minY", 1), ("maxX", 2), ("maxY", 3))]).alias("bbox"),
    )
    W.write_parquet(df, str(tmp_path / "b"))
    out = R.scan_buildings(spark, str(tmp_path / "b"), (10.0, 11.0, 20.0, 30.0))
    assert out.count() == 9
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = R.scan_buildings(spark, str(tmp_path / "b"), (10.0, 11.0, 20.0, 30.0))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bbox.minX,10.0)" in plan and "LessThanOrEqual(bbox.maxX,20.0)" in plan
    with pytest.raises(Exception, match="(?i)exists"):
        W.write_parquet(df, str(tmp_path / "b"))


# ---- a world of pixels: half of the cells change at the event


def world(spark, seed=0):
    rng = random.Random(seed)
    event = datetime(2022, 2, 24)
    scenes, pixels = [], []
    k = 0
    for orbit in (7, 8):
        at = datetime(2020, 2, 25) + timedelta(days=orbit)
        while at < datetime(2023, 2, 20):
            k += 1
            scenes.append((k, at, orbit, ["VV", "VH"], "IW", "A" if k % 17 else "B"))
            for x in range(CELLS):
                for y in range(CELLS):
                    shift = 4.0 if x < CELLS // 2 and at >= event else 0.0
                    gap = rng.random() < 0.03
                    pixels.append((k, x, y, None if gap else rng.gauss(-8 + shift, 0.5), rng.gauss(-15 - shift, 0.5)))
            at += timedelta(days=24)
    s = spark.createDataFrame(scenes, "scene_id int, ts timestamp_ntz, orbit int, transmitterReceiverPolarisation array<string>, instrumentMode string, platform_number string")
    p = spark.createDataFrame(pixels, "scene_id int, cx int, cy int, VV double, VH double")
    points = [(f"UKR{1 if y % 2 else 5}", f"u{x}_{y}", 1, date(2022, 3, 10), x, y) for x in range(CELLS // 2) for y in range(CELLS)]
    return s, p, spark.createDataFrame(points, "aoi string, unosat_id string, damage int, date date, cx int, cy int")


def test_experiment_from_pixels_to_metrics(spark, tmp_path):
    scenes, pixels, points = world(spark)
    cfg = RunConfig(run_id="t", aois_train=["UKR1"], aois_test=["UKR5"], reducers=["mean", "stdDev", "median"], model_kwargs={"trees": 10, "min_leaf": 3})
    store = X.Store(str(tmp_path))
    series = X.build_series_s1(scenes, pixels, points, ["VV", "VH"])
    assert series.where("VV is null").count() == 0
    W.write_observations(series, store.observations, "s1", "1x1")
    obs = R.scan_observations(spark, store.observations, "s1", "1x1", damages=[1, 2])
    assert obs.count() == series.count() and R.scan_observations(spark, store.observations, "s1", "1x1", "UKR5", 7).select("orbit").distinct().count() == 1
    orbits = spark.createDataFrame([(a, o) for a in ("UKR1", "UKR5") for o in (7, 8)], "aoi string, orbit int")
    labels = points.select("aoi", "unosat_id", "damage", "date")
    feats = X.build_features(obs, labels, cfg, "s1", "1x1", orbits)
    assert feats.count() == points.count() * 2 * len(POST_QUARTERS)
    for split in ("train", "test"):
        X.write_split(store, feats, cfg, "s1", "1x1", split)
    with pytest.raises(Exception):
        R.scan_features(spark, store.root, "s2", "train", "3months", "1x1")
    got = X.run_experiment(spark, store, labels, cfg)
    r = got.first()
    assert r.precision > 0.95 and r.recall > 0.95 and r.tp + r.fn == points.where("aoi = 'UKR5'").count() * 3
    # a second run loads the stored model
    again = X.run_experiment(spark, store, labels, cfg).first()
    assert r == again


def test_two_sensors_and_two_windows(spark, tmp_path):
    keys = [("A", "u", o, pre, date(2022, 2, 24)) for o in (7, 8) for pre in (date(2020, 2, 24), date(2021, 2, 24))]
    columns = "aoi string, unosat_id string, orbit int, start_pre date, start_post date"
    one = spark.createDataFrame([(*k, 1.0, 1) for k in keys], f"{columns}, VV_pre_1x1_mean double, label int")
    two = spark.createDataFrame([(*k, 2.0, 1) for k in keys], f"{columns}, VV_pre_3x3_mean double, label int")
    plain = [(*k[:2], *k[3:]) for k in keys[:2]]
    s2 = spark.createDataFrame([(*k, 3.0, 1) for k in plain], "aoi string, unosat_id string, start_pre date, start_post date, B1_pre_1x1_mean double, label int")
    wide = s2.withColumnRenamed("B1_pre_1x1_mean", "B1_pre_3x3_mean")
    root = str(tmp_path)
    for df, sat, w in ((one, "s1", "1x1"), (two, "s1", "3x3"), (s2, "s2", "1x1"), (wide, "s2", "3x3")):
        W.write_features(df, root, sat, w, POST_QUARTERS, "test")
    both = R.scan_features(spark, root, "s1", "test", "3months", ["1x1", "3x3"])
    assert both.count() == 4 and {"VV_pre_1x1_mean", "VV_pre_3x3_mean"} < set(both.columns)
    assert R.scan_features(spark, root, "s2", "test", "3months", ["1x1", "3x3"]).count() == 2
    joined = X.load_split(spark, X.Store(root), RunConfig(s2_bands=[]), "test")
    assert joined.count() == 4 and joined.where("B1_pre_1x1_mean = 3").count() == 4


def test_s2_series(spark):
    px = spark.createDataFrame(
        [(1, 0, 0, datetime(2021, 1, 1), 1.0, 2.0, 3.0), (2, 0, 0, datetime(2021, 2, 1), 1.0, 2.0, 3.0), (3, 0, 0, datetime(2019, 1, 1), 1.0, 2.0, 3.0), (4, 0, 0, datetime(2021, 3, 1), 1.0, None, 3.0)],
        "scene_id int, cx int, cy int, ts timestamp_ntz, B1 double, B2 double, B8 double",
    )
    cs = spark.createDataFrame([(1, 0, 0, 0.9), (2, 0, 0, 0.1), (3, 0, 0, 0.9), (4, 0, 0, 0.9)], "scene_id int, cx int, cy int, cs double")
    pts = spark.createDataFrame([("A", "u", 1, date(2022, 3, 1), 0, 0)], "aoi string, unosat_id string, damage int, date date, cx int, cy int")
    got = X.build_series_s2(px, cs, pts, ["B1", "B2", "B8"], period=OBSERVED).collect()
    assert [r.scene_id for r in got] == [1]


def test_country_run_resumes(spark, tmp_path):
    scenes, pixels, _ = world(spark, 1)
    pixels = pixels.join(scenes.select("scene_id", "orbit", "ts"), "scene_id").withColumn("qk", F.when(F.col("cy") < CELLS // 2, "0").otherwise("1"))
    tiles = spark.createDataFrame([("0",), ("1",)], "qk string")
    seen = pixels.select("qk", "scene_id", "orbit", "ts").distinct()
    post = [Period.of("2021-08-24", "2022-02-23"), Period.of("2022-02-24", "2022-08-23")]
    cfg = RunConfig(post=post, reducers=["mean", "median"])
    from scarmap.operators.series import period_features

    feats = period_features(pixels, ["qk", "cx", "cy", "orbit"], cfg.bands, PRE, post, cfg.reducers)
    changed = (F.col("cx") < CELLS // 2) & (F.col("start_post") >= date(2022, 2, 24))
    model = M.fit(feats.withColumn("label", changed.cast("int")), cfg.features, M.make_classifier("random_forest", 0, trees=10))
    path = str(tmp_path / "tiles")
    I.predict_country(spark, pixels, seen, tiles.where("qk = '0'"), model, cfg, path)
    assert {r.qk for r in I.written_units(spark, path).collect()} == {"0"}
    files = {f.name for f in (tmp_path / "tiles").rglob("*.parquet")}
    I.predict_country(spark, pixels, seen, tiles, model, cfg, path)
    kept = {f.name for f in (tmp_path / "tiles").rglob("*.parquet")}
    assert files < kept and I.written_units(spark, path).count() == 4
    I.predict_country(spark, pixels, seen, tiles, model, cfg, path)
    assert {f.name for f in (tmp_path / "tiles").rglob("*.parquet")} == kept
    out = spark.read.parquet(path)
    assert out.count() == CELLS * CELLS * 2
    hit = out.withColumn("want", (F.col("cx") < CELLS // 2) & (F.col("post_date") == date(2022, 2, 24)))
    assert hit.where("want != (value > 127)").count() == 0
    assert R.discover_periods(spark, path) == post


def test_orbit_without_enough_images_is_left_out(spark):
    rows = [("0", 7, datetime(2020, 3, d)) for d in range(1, 6)] + [("0", 7, datetime(2022, 3, d)) for d in range(1, 5)]
    rows += [("0", 8, datetime(2020, 3, d)) for d in range(1, 6)] + [("0", 8, datetime(2022, 3, d)) for d in range(1, 6)]
    got = I.qualifying_orbits(spark.createDataFrame(rows, "qk string, orbit int, ts timestamp_ntz"), PRE, POST_QUARTERS).collect()
    assert [(r.orbit, r.start_post) for r in got] == [(8, date(2022, 2, 24))]


# ---- buildings


def polygons(spark, rows, schema):
    data = [(*r[:-1], [[(float(x), float(y)) for x, y in ring] for ring in r[-1]]) for r in rows]
    return R.with_geometry(spark.createDataFrame(data, f"{schema}, rings {G.RINGS_DDL}"))


def test_enrich_buildings(spark):
    d = 0.0002
    shapes = {"in": (30.1, 50.1), "two": (30.6, 50.1), "border": (30.9997, 50.4), "out": (40.0, 50.0)}
    raw = polygons(spark, [(k, '[{"dataset": "src"}]', None, [box(x, y, d, d)]) for k, (x, y) in shapes.items()], "id string, sources string, class string")
    country = polygons(spark, [(1, [box(30, 50, 1, 1)]), (2, [box(31, 50, 1, 1)])], "part int")
    adm1 = spark.createDataFrame([("1_0", "N")], "admin_id string, ADM1_EN string")
    adm2 = spark.createDataFrame([("2_0", "N", "D")], "admin_id string, ADM1_EN string, ADM2_EN string")
    # the second polygon lies over the right half of the first and comes later
    adm3 = polygons(spark, [("3_0", 0, "N", "D", "left", [box(30, 50, 1, 1)]), ("3_1", 1, "N", "D", "right", [box(30.5, 50, 0.6, 1)])], "admin_id string, row_id int, ADM1_EN string, ADM2_EN string, ADM3_EN string").drop("edges", "bbox")
    adm3 = R.with_geometry(adm3)
    aois = polygons(spark, [("A", [box(30, 50, 0.5, 1)]), ("B", [box(30.5, 50, 0.2, 1)])], "aoi string")
    m = 1 / G.METRES_PER_DEGREE
    labels = spark.createDataFrame(
        [("a1", "A", 3, date(2022, 3, 1), 30.1001, 50.1001), ("a2", "A", 2, date(2022, 4, 1), 30.1001, 50.1 - 4 * m), ("a3", "A", 1, date(2022, 4, 1), 30.1001, 50.1 - 6 * m),
         ("wrong area", "A", 1, date(2022, 4, 1), 30.6001, 50.1001), ("b1", "B", 4, date(2022, 4, 1), 30.6001, 50.1001)],
        "unosat_id string, aoi string, damage int, date date, lon double, lat double",
    )
    out = B.enrich_buildings(raw, country, labels, aois, adm1, adm2, adm3)
    got = {r.building_id: r for r in out.collect()}
    assert got.keys() == {"in", "two", "border"}
    assert (got["in"].unosat_id, got["in"].unosat_damage, got["in"].ADM3_EN, got["in"].adm2_id, got["in"].dataset) == ("a2", 2, "left", "2_0", "src")
    assert (got["two"].unosat_id, got["two"].adm3_id) == ("b1", "3_1")
    assert got["border"].unosat_id is None and got["border"].adm3_id == "3_1"
    assert got["in"].area == pytest.approx((d * G.METRES_PER_DEGREE) ** 2 * 0.6415, rel=0.01)


def test_buildings_are_evaluated_once_and_a_rerun_goes_on(spark, tmp_path):
    n, d = 60, 0.0001
    raw = polygons(spark, [(f"b{i}", "[]", "house", [box(30.0 + i * 0.01, 50.1, d, d)]) for i in range(n)], "id string, sources string, class string")
    raw, times = counted(raw)
    country = polygons(spark, [("c", [box(29.0, 49.0, 4, 3)])], "name string")
    adm1, adm2 = (spark.createDataFrame([(f"{k}_0", "N", "D")], "admin_id string, ADM1_EN string, ADM2_EN string") for k in (1, 2))
    adm3 = polygons(spark, [("3_0", 0, "N", "D", "all", [box(29, 49, 4, 3)])], "admin_id string, row_id int, ADM1_EN string, ADM2_EN string, ADM3_EN string")
    aois = polygons(spark, [("A", [box(29, 49, 4, 3)])], "aoi string")
    labels = spark.createDataFrame([(f"u{i}", "A", 1, date(2022, 3, 1), 30.00005 + i * 0.01, 50.10005) for i in range(0, n, 2)], "unosat_id string, aoi string, damage int, date date, lon double, lat double")
    run = lambda: B.enrich_buildings(raw, country, labels, aois, adm1.drop("ADM2_EN"), adm2, adm3, folder=str(tmp_path / "run"))
    out = run()
    out.write.parquet(str(tmp_path / "out"))
    assert times.value == n
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == n and got.where("unosat_id is not null").count() == n / 2 and got.where("adm3_id = '3_0'").count() == n
    assert run().count() == n and times.value == n  # a rerun reads the stages
    assert Stages(spark, str(tmp_path / "run")).finished("inside")["rows"] == n
    # a stage that was left without its note is written anew
    shutil.rmtree(tmp_path / "run/_manifest/inside")
    assert run().count() == n and times.value == 2 * n


def test_points_meet_boxes_before_edges(spark):
    shapes = polygons(spark, [(k, [box(30 + k * 0.01, 50, 0.001 * 4 ** (k % 6), 0.001)]) for k in range(12)], "building_id int")
    points = spark.createDataFrame([(i, 30 + i * 0.0007, 50.0005) for i in range(400)], "id int, lon double, lat double")
    grid = Grid(-180.0, -90.0, 0.0005, 0.0005)
    near = C.points_near_polygons(points, shapes, ["building_id"], grid, 5.0)
    pairs = points.crossJoin(shapes).where(G.within_metres(F.col("edges"), F.col("lon"), F.col("lat"), 5.0))
    got = sorted((r.id, r.building_id) for r in near.collect())
    assert got == sorted((r.id, r.building_id) for r in pairs.select("id", "building_id").collect()) and got
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    first_join = plan[plan.index("Join"):].count("Join")
    assert first_join == 1  # the join with boxes is settled; only its pairs meet edges


def test_predictions_to_buildings(spark):
    grid = Grid(0.0, 0.0, 1.0, 1.0)
    b = polygons(spark, [(1, [box(0.5, 0, 1, 1)]), (2, [box(50, 50, 1, 1)])], "building_id int")
    d1, d2 = date(2021, 2, 24), date(2022, 2, 24)
    tiles = spark.createDataFrame(
        [(0, 0, d1, "0", 100.0), (0, 0, d1, "1", 10.0), (1, 0, d1, "0", 30.0), (0, 0, d2, "0", 200.0)], "cx int, cy int, post_date date, qk string, value double"
    )
    got = {r.building_id: (r[f"pred_{d1}"], r[f"pred_{d2}"]) for r in B.predictions_to_buildings(b, tiles, grid, [d1, d2]).collect()}
    assert got == {1: (pytest.approx(20.0), 200.0), 2: (None, None)}
    plan = B.predictions_to_buildings(b, tiles, grid, [d1, d2])._jdf.queryExecution().executedPlan().toString()
    raster = [line for line in plan.split("\n") if "Exchange hashpartitioning(cx" in line]
    assert len(raster) == 2  # the raster by cell, and the overlaps to meet it


def test_only_tiles_and_blocks_with_buildings_are_read(spark, tmp_path):
    grid = Grid(30.0, 50.0, 0.01, 0.01)
    d1 = date(2022, 2, 24)
    b = polygons(spark, [(1, [box(31.0, 51.0, 0.02, 0.02)]), (2, [box(31.5, 51.2, 0.005, 0.005)])], "building_id int")
    x, y = T.tile_holding(F.col("cx") * 0.01 + 30.005, F.col("cy") * 0.01 + 50.005, 8)
    cells = spark.range(400).select(F.col("id").cast("int").alias("cx")).crossJoin(spark.range(200).select(F.col("id").cast("int").alias("cy")))
    cells = cells.select("cx", "cy", F.lit(d1).alias("post_date"), T.quadkey(x, y, 8).alias("qk"), (F.col("cx") + F.col("cy")).cast("double").alias("value"))
    path = str(tmp_path / "tiles")
    cells.write.partitionBy("qk").parquet(path)
    want = {r.building_id: r[f"pred_{d1}"] for r in B.predictions_to_buildings(b, spark.read.parquet(path), grid, [d1], zoom=8).collect()}
    assert want == {1: pytest.approx(201.0), 2: pytest.approx(270.0)}
    tiles = spark.read.parquet(path)
    wanted = tiles_of_boxes(b, 8, 0.01)
    others = [f for f in (tmp_path / "tiles").glob("qk=*/*.parquet") if f.parent.name[3:] not in wanted]
    assert others and wanted
    for f in others:  # a scan that opened them would fail
        f.write_bytes(b"no table")
    job = B.predictions_to_buildings(b, tiles, grid, [d1], zoom=8)
    assert {r.building_id: r[f"pred_{d1}"] for r in job.collect()} == want
    plan = job._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*qk#\d+", plan) and "LeftSemi" in plan and "BroadcastHashJoin [_bx" in plan
    near = pixels_near(cells, b, grid)
    assert 0 < near.count() < cells.count() / 4 and near.columns == cells.columns


def test_a_spatial_join_from_another_folder(tmp_path):
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {str(pathlib.Path(R.__file__).resolve().parents[2])!r})
from scarmap.cluster import own_checkpoint_folder, session
from scarmap.functions import geometry as G
from scarmap.operators import cover as C
from scarmap.operators.raster import Grid
from scarmap.sources.readers import with_geometry
spark = session("elsewhere", spark__master="local[2]", spark__sql__shuffle__partitions="2", spark__ui__showConsoleProgress="false")
own_checkpoint_folder(spark)
box = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
shape = with_geometry(spark.createDataFrame([(1, [box])], "k int, rings " + G.RINGS_DDL))
points = spark.createDataFrame([(1, 1.0, 1.5), (2, 5.0, 5.0)], "id int, lon double, lat double")
grid = Grid(0.0, 0.0, 1.0, 1.0)
print("found", C.points_in_polygons(points, C.cell_cover(shape, ["k"], grid), grid).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 1" in done.stdout, done.stderr[-2000:]


# ---- models


def test_models_separate_a_simple_set(spark, tmp_path):
    rng = random.Random(0)
    rows = [(i, i % 2, rng.gauss(3 * (i % 2), 0.4), rng.gauss(0, 1)) for i in range(200)] + [(200, 1, None, 0.0)]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double")
    for name, kwargs in (("random_forest", {"trees": 10}), ("svm", {}), ("boosted_trees", {"trees": 5})):
        model = M.fit(df, ["a", "b"], M.make_classifier(name, 0, **kwargs))
        out = M.classify(df, model)
        assert out.columns == ["id", "label", "a", "b", "classification"] and out.count() == 201
        assert M.unscored(out) == 1 and out.where("a is null and classification is null").count() == 1
        assert out.where("(classification >= 0.5) = (label = 1)").count() >= 190, name
        assert out.where("classification < 0 or classification > 1").count() == 0
    M.save_model(model, str(tmp_path / "m"))
    loaded = M.classify(df, M.load_or_fit(str(tmp_path / "m"), None, spark))
    assert sorted(r.classification for r in loaded.dropna().collect()) == sorted(r.classification for r in out.dropna().collect())
    a, b = (M.fit(df, ["a", "b"], M.make_classifier("random_forest", 3, trees=5)) for _ in range(2))
    assert M.classify(df, a).collect() == M.classify(df, b).collect()
    with pytest.raises(ValueError):
        M.make_classifier("nearest_neighbour")


def test_model_that_saw_one_class_only(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(20)], "label int, a double")
    model = M.fit(df, ["a"], M.make_classifier("random_forest", 0, trees=2))
    assert {r.classification for r in M.classify(df, model).collect()} == {0.0}


# ---- plans


@pytest.mark.parametrize("name", ["point_in_polygon", "assign_admin", "buildings_in_aoi", "labels_near_buildings", "nearest_pixel", "pixels_x_buildings", "extract_points", "extract_points_3x3", "threshold_sweep"])
def test_no_cross_or_nested_loop_join(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_inference_shuffles_pixels_once(spark):
    scenes, pixels, _ = world(spark, 1)
    pixels = pixels.join(scenes.select("scene_id", "orbit", "ts"), "scene_id").withColumn("qk", (F.col("cy") % 2).cast("string"))
    cfg = RunConfig(post=POST_QUARTERS[:2], reducers=["mean", "median"])
    from scarmap.operators.series import period_features

    feats = period_features(pixels, ["qk", "cx", "cy", "orbit"], cfg.bands, PRE, cfg.post, cfg.reducers)
    train = feats.withColumn("label", (F.col("cx") % 2).cast("int"))
    model = M.fit(train, cfg.features, M.make_classifier("random_forest", 0, trees=3))
    seen = pixels.select("qk", "scene_id", "orbit", "ts").distinct()
    plan = I.predict_area(pixels, seen, model, cfg, cfg.post)._jdf.queryExecution().executedPlan().toString()
    # besides the joins that make the test's own table and the scene counts, pixels move once
    assert plan.count("REPARTITION_BY_COL") == 1
    top = plan.split("REPARTITION_BY_COL")[0]
    assert top.count("Exchange hashpartitioning(") == 1


def test_box_test_agrees_with_polygon_test(spark):
    rng = random.Random(8)
    tri = [[(x := rng.uniform(0, 9), y := rng.uniform(0, 9)), (x + rng.uniform(-3, 3), y + rng.uniform(-3, 3)), (x + rng.uniform(-3, 3), y + 3), (x, y)] for _ in range(60)]
    a = polygons(spark, [(i, [t]) for i, t in enumerate(tri)] + [(99, [box(0, 0, 12, 12)])], "id int")
    boxes = spark.createDataFrame([(i, rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(40)], "b int, x double, y double")
    b = boxes.select("b", *[c.alias(n) for c, n in ((F.col("x"), "x0"), (F.col("y"), "y0"), (F.col("x") + 1.5, "x1"), (F.col("y") + 0.7, "y1"))])
    c = [F.col(n) for n in ("x0", "y0", "x1", "y1")]
    pairs = a.crossJoin(b).select(G.meets_box(F.col("edges"), *c).alias("m"), G.intersects(F.col("edges"), G.edges_of(G.box_rings(*c))).alias("i"))
    counts = {(r.m, r.i): r["count"] for r in pairs.groupBy("m", "i").count().collect()}
    assert counts.keys() == {(True, True), (False, False)}


# ---- readers: nothing is lost without a word


def test_geojson_in_any_form(spark, tmp_path):
    one = feature({"unosat_id": "u1", "aoi": "A", "damage": 1, "date": "2022-03-14", "ep": 2}, "Point", [30.5, 50.25])
    two = json.loads(feature({"unosat_id": "u2", "aoi": "A", "damage": 3, "date": None, "ep": 1}, "Point", [31, 49]))
    turned = json.dumps({"id": 7, "geometry": two["geometry"], "properties": two["properties"], "type": "Feature"})
    whole = json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "features": [json.loads(one), two]})
    lines = ['{', '"type": "FeatureCollection",', '"crs": { "type": "name", "properties": { "name": "urn" } },', '"features": [', one + ",", "  " + turned, "]", "}"]
    for text in (whole, "\n".join(lines), one + "\n" + turned):
        (tmp_path / "x.geojson").write_text(text)
        assert sorted(r.unosat_id for r in R.scan_labels(spark, str(tmp_path / "x.geojson")).collect()) == ["u1", "u2"]
    for broken in (one[:-3], json.dumps(two, indent=1), '{"type": "Feature", "properties": {}}', "no json"):
        (tmp_path / "x.geojson").write_text(one + "\n" + broken)
        with pytest.raises(Exception, match="not a GeoJSON feature"):
            R.scan_labels(spark, str(tmp_path / "x.geojson")).collect()


def test_admin_files_to_buildings(spark, tmp_path):
    d = 0.0002
    shapes = {1: [({"row_id": 0, "ADM1_EN": "N"}, box(30, 50, 2, 1))], 2: [({"row_id": i, "ADM1_EN": "N", "ADM2_EN": f"D{i}"}, box(30 + i, 50, 1, 1)) for i in range(2)]}
    shapes[3] = [({"row_id": i, "ADM1_EN": "N", "ADM2_EN": f"D{i // 2}", "ADM3_EN": f"P{i}"}, box(30 + i / 2, 50, 0.5, 1)) for i in range(4)]
    admin = []
    for level, rows in shapes.items():
        (tmp_path / f"adm{level}.geojson").write_text("\n".join(feature(p, "Polygon", [ring]) for p, ring in rows))
        admin.append(R.scan_admin(spark, str(tmp_path / f"adm{level}.geojson"), level))
    raw = polygons(spark, [(f"b{i}", '[{"dataset": "s"}]', None, [box(30.25 + i / 2, 50.5, d, d)]) for i in range(4)], "id string, sources string, class string")
    country = polygons(spark, [(1, [box(29, 49, 5, 5)])], "part int")
    aois = polygons(spark, [("A", [box(29, 49, 5, 5)])], "aoi string")
    labels = spark.createDataFrame([("l", "A", 1, date(2022, 3, 1), 30.25, 50.5)], "unosat_id string, aoi string, damage int, date date, lon double, lat double")
    got = {r.building_id: (r.adm1_id, r.adm2_id, r.adm3_id, r.unosat_id) for r in B.enrich_buildings(raw, country, labels, aois, *admin).collect()}
    assert got == {f"b{i}": ("1_0", f"2_{i // 2}", f"3_{i}", "l" if i == 0 else None) for i in range(4)}
    (tmp_path / "none.geojson").write_text(feature({"ADM1_EN": "N"}, "Polygon", [box(0, 0, 1, 1)]))
    with pytest.raises(Exception, match="no row_id"):
        R.scan_admin(spark, str(tmp_path / "none.geojson"), 1).collect()


# ---- country inference


class Post:
    """A fixed model: the post mean itself, so that scores show what the features were."""

    def __init__(self, column):
        self.column = column

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector

        return df.withColumn("probability", array_to_vector(F.array(1 - F.col(self.column), F.col(self.column))))


def line_of_cells(spark):
    """Cells 0..3 over two tiles with values 0..3 in every image."""
    days = [datetime(2020, 3, d) for d in range(1, 7)] + [datetime(2022, 3, d) for d in range(1, 7)]
    scenes = [(q, k, 7, t) for k, t in enumerate(days) for q in ("0", "1")]
    cells = [("0" if x < 2 else "1", k, 7, t, x, 0, float(x), 1.0) for k, t in enumerate(days) for x in range(4)]
    s = spark.createDataFrame(scenes, "qk string, scene_id int, orbit int, ts timestamp_ntz")
    return s, spark.createDataFrame(cells, "qk string, scene_id int, orbit int, ts timestamp_ntz, cx int, cy int, VV double, VH double")


def counted(df):
    """``df``, and an accumulator of how many of its rows have been evaluated."""
    rows = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), rows


def test_orbits_and_broadcast_sides_are_evaluated_once(spark):
    from scarmap.cluster import checked_broadcast
    from scarmap.operators.raster import combine_orbits

    preds = spark.createDataFrame([(i % 50, i % 4, float(i)) for i in range(200)], "cx int, orbit int, value double")
    watched, rows = counted(preds)
    assert combine_orbits(watched, ["cx"], "median").count() == 50 and rows.value == 200
    watched, rows = counted(preds)
    for limit in (0, 1 << 20):
        watched, rows = counted(preds)
        joined = preds.join(checked_broadcast(watched, limit), ["cx", "orbit"])
        assert joined.count() == 400 and rows.value == 200
        assert ("BroadcastExchange" in joined._jdf.queryExecution().executedPlan().toString()) == (limit > 0) or limit == 0


def test_windows_cross_tile_borders_and_nothing_runs_on_pixels_before(spark, tmp_path):
    scenes, pixels = line_of_cells(spark)
    post = [Period.of("2022-02-24", "2022-08-23")]
    cfg = RunConfig(post=post, reducers=["mean"], window=["3x3"])
    watched, rows = counted(pixels)
    out = I.predict_area(watched, scenes, Post("VV_post_3x3_mean"), cfg, post)
    assert rows.value == 0
    got = {r.cx: (r.qk, r.value) for r in out.collect()}
    assert rows.value == pixels.count()
    assert got == {0: ("0", 0.5), 1: ("0", 1.0), 2: ("1", 2.0), 3: ("1", 2.5)}
    # named orbits are used whatever their images; others are not
    assert I.predict_area(pixels, scenes.limit(0), Post("VV_post_3x3_mean"), cfg, post, orbits=[7]).count() == 4
    assert I.predict_area(pixels, scenes, Post("VV_post_3x3_mean"), cfg, post, orbits=[8]).count() == 0
    # a run that lacks one tile sees its neighbour's cells
    path = str(tmp_path / "out")
    tiles = spark.createDataFrame([("0",), ("1",)], "qk string")
    scaled = pixels.withColumn("VV", F.col("VV") / 4)
    I.predict_country(spark, scaled, scenes, tiles.where("qk = '1'"), Post("VV_post_3x3_mean"), cfg, path)
    I.predict_country(spark, scaled, scenes, tiles, Post("VV_post_3x3_mean"), cfg, path)
    assert {r.cx: r.value for r in spark.read.parquet(path).collect()} == {x: int(v / 4 * 255) for x, (_, v) in got.items()}


def test_one_odd_window_only():
    assert I.window_size(["3x3"]) == 3 and I.window_size("11x11") == 11
    for bad in (["1x1", "3x3"], "2x2", "3x5", "three", []):
        with pytest.raises(ValueError):
            I.window_size(bad)


def test_resume_reads_only_folders_of_missing_tiles_and_notes_empty_ones(spark, tmp_path):
    scenes, pixels = line_of_cells(spark)
    pixels.write.partitionBy("qk").parquet(str(tmp_path / "px"))
    stored = spark.read.schema(pixels.schema).parquet(str(tmp_path / "px"))
    plan = I.of_tiles(stored, ["1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(qk" in plan.replace("isnotnull(qk#", "isnotnull(q") or "(qk" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    cfg = RunConfig(post=[Period.of("2022-02-24", "2022-08-23")], reducers=["mean"])
    tiles = spark.createDataFrame([("1",), ("3",)], "qk string")
    path = str(tmp_path / "out")
    I.predict_country(spark, stored, scenes, tiles, Post("VH_post_1x1_mean"), cfg, path)
    assert {r.qk for r in I.written_units(spark, path).collect()} == {"1", "3"} and spark.read.parquet(path).count() == 2


def test_neighbours_of_tiles():
    from scarmap.operators.tiles import with_neighbours

    assert with_neighbours(["0"]) == ["0", "1", "2", "3"]
    assert with_neighbours(["00"]) == ["00", "01", "02", "03"]
    assert set(with_neighbours(["03"])) == {"00", "01", "02", "03", "10", "12", "20", "21", "30"}


def test_cluster_without_a_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    from scarmap import cluster

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077")
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    for call in (cluster.checkpoint_folder, cluster.own_checkpoint_folder):
        with pytest.raises(RuntimeError):
            call(bare)


def test_stored_predictions_are_used_again(spark, tmp_path):
    store, cfg = X.Store(str(tmp_path)), RunConfig(run_id="old")
    rows = [("UKR5", "u", p.start, 200, date(2022, 3, 1), 1) for p in cfg.post]
    spark.createDataFrame(rows, "aoi string, unosat_id string, start_post date, pred int, date date, damage int").write.parquet(store.predictions(cfg))
    got = X.run_experiment(spark, store, None, cfg).first()
    assert got.tp > 0 and got.fn == 0


def test_a_window_reads_few_rows_of_a_tile(spark, tmp_path):
    from scarmap.operators.raster import morton, pixels_in

    side = 640
    cells = spark.range(side * side).select(F.lit("2022-02-24_2022-05-23").alias("period"), F.lit("1").alias("qk"), (F.col("id") % side - 100).cast("int").alias("cx"), F.floor(F.col("id") / side).cast("int").alias("cy"), (F.col("id") % 256).cast("short").alias("value"))
    path = str(tmp_path / "tiles")
    W.write_pred_tiles(cells, path)
    stored = spark.read.parquet(path)
    assert stored.count() == side * side
    for x, y in ((-100, 0), (57, 311), (400, 500)):
        window = pixels_in(stored, x, y, x + side // 10 - 1, y + side // 10 - 1, "cx", "cy")
        assert window.count() == (side // 10) ** 2
        window.write.format("noop").mode("overwrite").save()
        plan = window._jdf.queryExecution().executedPlan()
        window._jdf.queryExecution().toRdd().count()
        leaf = plan.collectLeaves().head()
        assert 0 < leaf.metrics().apply("numOutputRows").value() < 0.05 * side * side
    codes = cells.select(morton(F.col("cx"), F.col("cy")).alias("m")).distinct()
    assert codes.count() == side * side
    near = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (-1, -1)], "cx int, cy int")
    assert [tuple(r) for r in near.orderBy(morton(F.col("cx"), F.col("cy"))).collect()] == [(-1, -1), (0, 0), (1, 0), (0, 1), (1, 1), (2, 0)]


def _scene_pixels(spark):
    rows = [(s, x, y, float(s * 100 + x * 10 + y) if (x + y + s) % 4 else None) for s in (1, 2) for x in range(-2, 68) for y in range(5) if (x * y + s) % 3]
    rows += [rows[7], (None, 1, 1, 5.0), (3, None, 1, 7.0)]
    return rows, spark.createDataFrame(rows, "scene_id long, cx int, cy int, B1 double")


def test_window_means_at_points(spark):
    """Points that share a cell, lie at a block's border, repeat, are in two cells, or lack a key or a cell."""
    rows, pixels = _scene_pixels(spark)
    points = [(1, 0, 0), (2, 0, 0), (3, 63, 2), (4, 64, 2), (5, 9, 1), (5, 9, 1), (6, 1, 1), (6, 40, 3), (None, 20, 2), (7, None, 2), (8, 500, 500)]
    got = S.extract_points(pixels, spark.createDataFrame(points, "unosat_id long, cx int, cy int"), ["unosat_id"], ["scene_id"], ["B1"], 3)
    hits = {}
    for p, px, py in points:
        for s, x, y, v in rows:
            if None not in (px, py, x, y) and abs(x - px) <= 1 and abs(y - py) <= 1:
                hits.setdefault((p, s), []).append(v)
    present = {k: [v for v in vs if v is not None] for k, vs in hits.items()}
    want = {k: pytest.approx(sum(v) / len(v)) if v else None for k, v in present.items()}
    found = [tuple(r) for r in got.select("unosat_id", "scene_id", "B1").collect()]
    assert len(found) == len(want) and {(p, s): v for p, s, v in found} == want


@pytest.mark.parametrize("size", [1, 3])
def test_many_points_of_a_cell_follow_each_other(spark, monkeypatch, size):
    """Rows of a result that is much larger than the tables come cell by cell, in tiles of a bounded number of rows."""
    rows, pixels = _scene_pixels(spark)
    pixels = pixels.repartition(7)
    points = [(i, i % 23, i % 3) for i in range(900)] + [(7, 7, 1), (None, 20, 2), (901, None, 2), (902, 500, 500)]
    table = spark.createDataFrame(points, "unosat_id long, cx int, cy int")
    take = lambda: S.extract_points(pixels, table, ["unosat_id"], ["scene_id"], ["B1"], size, finish=lambda c: F.round(c, 3)).select("unosat_id", "scene_id", "B1")
    want = sorted(map(tuple, take().collect()), key=str)
    if size == 1:
        assert want == sorted(((p, s, v) for p, px, py in points for s, x, y, v in rows if (px, py) == (x, y) and None not in (x, y)), key=str)
    for per_task, held in ((300, 100_000), (5, 9)):
        monkeypatch.setattr(S, "RESULT_ROWS", per_task)
        monkeypatch.setattr(S, "POINTS_HELD", held)
        found = take()
        parts = found.rdd.glom().collect()
        assert sorted((tuple(r) for p in parts for r in p), key=str) == want and len(want) > 900
    monkeypatch.setattr(S, "RESULT_ROWS", 300)
    parts = take().rdd.glom().collect()
    cells = [[dict((p, (x, y)) for p, x, y in points).get(r.unosat_id) for r in p] for p in parts]
    changes = sum(a != b for c in cells for a, b in zip(c, c[1:], strict=False))
    assert changes < 2 * len({c for p in cells for c in p})


def test_what_window_means_move_does_not_grow_with_the_points(spark):
    """Points of a cell meet its means; nothing is grouped or moved behind that join."""
    _, pixels = _scene_pixels(spark)
    points = spark.createDataFrame([(i, i % 60, 2) for i in range(600)], "unosat_id long, cx int, cy int")
    plan = S.extract_points(pixels, points, ["unosat_id"], ["scene_id"], ["B1"], 3)._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Join")]
    assert "Aggregate" not in top and "Exchange" not in top


def test_a_side_beyond_the_limit_is_not_broadcast(spark):
    """Spark would take the side, whose rows a range makes, for small."""
    from scarmap.cluster import checked_broadcast

    made = spark.range(10).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(50_000))))
    left = spark.range(100).withColumn("k", F.col("id"))
    for how in ("inner", "left_semi"):
        plan = left.join(checked_broadcast(made, 1 << 20), "k", how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    plan = left.join(checked_broadcast(made.limit(5)), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
