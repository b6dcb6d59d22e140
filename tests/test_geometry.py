import math
import random
import time
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scarmap.functions import geometry as G
from scarmap.functions import tiles as T
from scarmap.operators import cover as C
from scarmap.operators.raster import Grid
from scarmap.operators.zonal import pixel_overlaps
from scarmap.sources.readers import normalise_geometry, with_geometry

U_SHAPE = [(0, 0), (6, 0), (6, 5), (4, 5), (4, 1.5), (2, 1.5), (2, 5), (0, 5), (0, 0)]
SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]
FAR = [(10, 10), (11, 10), (11, 12), (10, 12), (10, 10)]
RINGS = f"id int, rings {G.RINGS_DDL}"


def polygons(spark, *shapes):
    rows = [(i, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in enumerate(shapes)]
    return with_geometry(spark.createDataFrame(rows, RINGS))


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            side = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
            if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            if (ay > y) != (by > y) and (side > 0) == (by > ay):
                odd = not odd
    return odd


def star(rng, n=40):
    """Spiky polygon: concave, many thin parts."""
    pts = []
    for i in range(n):
        r = rng.uniform(0.3, 5)
        a = 2 * math.pi * i / n
        pts.append((5 + r * math.cos(a), 5 + r * math.sin(a)))
    return [pts + pts[:1]]


def test_area_centroid_bounds(spark):
    df = polygons(spark, [U_SHAPE], [SQUARE, HOLE], [SQUARE, HOLE, FAR])
    got = df.select(G.area(F.col("edges")).alias("a"), G.centroid(F.col("edges")).alias("c"), "bbox").collect()
    assert [r.a for r in got] == pytest.approx([23.0, 12.0, 14.0])
    assert (got[1].c.x, got[1].c.y) == pytest.approx((2, 2))
    assert (got[2].c.x, got[2].c.y) == pytest.approx(((12 * 2 + 2 * 10.5) / 14, (12 * 2 + 2 * 11) / 14))
    assert tuple(got[2].bbox) == (0, 0, 11, 12)


def test_spheroid_area_of_a_degree_cell(spark):
    # closed form of the ellipsoid's zone between two parallels
    f = G.FLATTENING
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(lat):
        s = math.sin(math.radians(lat))
        return (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)

    want = G.SEMI_MAJOR**2 / 2 * math.radians(1) * (q(49) - q(48))
    box = [(30, 48), (31, 48), (31, 49), (30, 49), (30, 48)]
    got = polygons(spark, [box]).select(G.area_spheroid(F.col("edges"))).first()[0]
    assert got == pytest.approx(want, rel=1e-9)
    assert got == pytest.approx(8.2e9, rel=0.01)


def test_clip_areas_sum_to_the_area(spark):
    rng = random.Random(1)
    df = polygons(spark, [U_SHAPE], [SQUARE, HOLE], star(rng), star(rng, 9))
    grid = Grid(-0.3, -0.7, 0.7, 0.9)
    got = {r.id: r.s for r in pixel_overlaps(df, ["id"], grid).groupBy("id").agg(F.sum("overlap_area").alias("s")).collect()}
    want = {r.id: r.a for r in df.select("id", G.area(F.col("edges")).alias("a")).collect()}
    assert got == pytest.approx(want)
    one = df.select("id", G.clip_area(F.col("edges"), F.lit(1.0), F.lit(1.0), F.lit(5.0), F.lit(4.0)).alias("a"))
    got = {r.id: r.a for r in one.where("id < 2").collect()}
    assert got == pytest.approx({0: 4 * 3 - 2 * 2.5, 1: 3 * 3 - 4})


def test_large_polygons_are_cut_into_blocks_without_loss(spark):
    rng = random.Random(5)
    df = polygons(spark, star(rng), [SQUARE], [[(0, 0), (9, 0.01), (9, 0.02), (0, 0.02), (0, 0)]])
    grid = Grid(0.0, 0.0, 0.01, 0.013)
    parts = pixel_overlaps(df, ["id"], grid)
    assert parts.groupBy("id", "cx", "cy").count().where("count > 1").count() == 0
    got = {r.id: r.s for r in parts.groupBy("id").agg(F.sum("overlap_area").alias("s")).collect()}
    want = {r.id: r.a for r in df.select("id", G.area(F.col("edges")).alias("a")).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_cover_agrees_with_brute_force(spark):
    rng = random.Random(3)
    shapes = [[U_SHAPE], [SQUARE, HOLE], [SQUARE, HOLE, FAR], star(rng, 60), star(rng, 7)]
    # grid lines through vertices, and points on vertices, edges and grid lines
    grid = Grid(-1.0, -1.0, 0.5, 0.5)
    pts = [(rng.uniform(-1, 12), rng.uniform(-1, 13)) for _ in range(1500)]
    pts += [(x / 2, y / 2) for x in range(-2, 24) for y in range(-2, 26)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid int, lon double, lat double")
    df = polygons(spark, *shapes)
    cover = C.cell_cover(df, ["id"], grid)
    got = {(r.id, r.pid) for r in C.points_in_polygons(points, cover, grid).select("id", "pid").collect()}
    want = {(s, p) for s, rings in enumerate(shapes) for p, (x, y) in enumerate(pts) if inside(rings, x, y)}
    assert got == want

    ordered = C.cell_cover(df.withColumn("rank", F.col("id")), ["id", "rank"], grid)
    last = {p: max((s for s, q in want if q == p), default=None) for p in range(len(pts))}
    for limit in (1000, 1):
        out = C.locate(points, ordered, grid, ["pid"], "rank", max_pieces=limit).select("pid", "id").collect()
        assert len(out) == len(pts)
        assert {r.pid: r.id for r in out} == last


def test_polygons_meeting_agrees_with_brute_force(spark):
    rng = random.Random(4)
    boxes = []
    for _ in range(120):
        x, y, w, h = rng.uniform(-1, 11), rng.uniform(-1, 11), rng.uniform(0.01, 1.5), rng.uniform(0.01, 1.5)
        boxes.append([[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]])
    left = polygons(spark, *boxes)
    right = polygons(spark, [SQUARE, HOLE], star(rng), [U_SHAPE]).withColumnRenamed("id", "other")
    grid = Grid(0.0, 0.0, 0.4, 0.4)
    got = {(r.id, r.other) for r in C.polygons_meeting(left, ["id"], C.cell_cover(right, ["other"], grid), grid).collect()}
    l, r = left.select("id", F.col("edges").alias("a")), right.select("other", F.col("edges").alias("b"))
    want = {(r.id, r.other) for r in l.crossJoin(r).where(G.intersects(F.col("a"), F.col("b"))).collect()}
    assert got == want and 20 < len(want) < 300


def test_points_near_polygons(spark):
    m = 1 / G.METRES_PER_DEGREE
    lon, lat = 30.0, 60.0
    k = 1 / math.cos(math.radians(lat))
    box = [(lon, lat), (lon + 20 * m * k, lat), (lon + 20 * m * k, lat + 10 * m), (lon, lat + 10 * m), (lon, lat)]
    pts = [("in", 5, 5), ("east 4", 24, 5), ("east 6", 26, 5), ("south 4.9", 3, -4.9), ("south 5.2", 3, -5.2), ("corner 4.2", -3, -3), ("corner 5.6", -4, -4)]
    points = spark.createDataFrame([(n, lon + x * m * k, lat + y * m) for n, x, y in pts], "n string, lon double, lat double")
    got = C.points_near_polygons(points, polygons(spark, [box]), ["id"], Grid(0.0, 0.0, 1e-4, 1e-4), 5.0)
    assert sorted(r.n for r in got.collect()) == ["corner 4.2", "east 4", "in", "south 4.9"]


def wkb(kind, body, order="<"):
    return struct.pack(order + "BI", 1 if order == "<" else 0, kind) + body


def ring_bytes(ring, order):
    return struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "2d", *p) for p in ring)


def polygon_bytes(rings, order="<"):
    return wkb(3, struct.pack(order + "I", len(rings)) + b"".join(ring_bytes(r, order) for r in rings), order)


def test_wkb_both_byte_orders_and_orientation(spark):
    rows = []
    for order in "<>":
        rows.append(polygon_bytes([SQUARE[::-1], HOLE[::-1]], order))
        rows.append(wkb(6, struct.pack(order + "I", 2) + polygon_bytes([SQUARE, HOLE], order) + polygon_bytes([FAR[::-1]], order), order))
        rows.append(wkb(1, struct.pack(order + "2d", 3.0, 4.0), order))
    rows.append(None)
    df = normalise_geometry(spark.createDataFrame([(i, b) for i, b in enumerate(rows)], "id int, geometry binary"))
    got = {r.id: r for r in df.withColumn("a", F.when(F.size("edges") > 0, G.area(F.col("edges")))).collect()}
    for k in (0, 3):
        assert got[k].a == pytest.approx(12) and got[k + 1].a == pytest.approx(14)
        assert got[k + 2].rings[0][0].x == 3 and got[k + 2].rings[0][0].y == 4
        assert [len(r) for r in got[k + 1].rings] == [5, 5, 5]
    assert got[6].rings is None


def test_tiles(spark):
    df = spark.range(1)
    q = lambda x, y, z: T.quadkey(F.lit(x), F.lit(y), z)
    assert df.select(q(3, 5, 3)).first()[0] == "213"
    box = df.select(T.tile_box(F.lit(0), F.lit(0), 0).alias("b")).first().b
    assert box.minx == -180 and box.maxy == pytest.approx(T.LAT_LIMIT, abs=1e-6)
    assert box.maxx == pytest.approx(180 - 360 / 256)  # one pixel short
    at = spark.createDataFrame([(0.0, 90.0), (0.0, -90.0), (180.0, 0.0), (-180.0, 0.0)], "lon double, lat double")
    got = [tuple(r) for r in at.select(*[c.alias(n) for c, n in zip(T.tile_of(F.col("lon"), F.col("lat"), 3), "xy")]).collect()]
    assert got == [(4, 0), (4, 7), (7, 4), (0, 4)]
    # the centre of a tile lies in it
    z = 9
    cells = spark.range(0, 400).select((F.col("id") * 37 % 511).cast("int").alias("x"), (F.col("id") * 101 % 511).cast("int").alias("y"))
    b = cells.withColumn("b", T.tile_box(F.col("x"), F.col("y"), z))
    lon, lat = (F.col("b.minx") + F.col("b.maxx")) / 2, (F.col("b.miny") + F.col("b.maxy")) / 2
    tx, ty = T.tile_of(lon, lat, z)
    assert b.where((tx != F.col("x")) | (ty != F.col("y"))).count() == 0


def test_utm(spark):
    at = spark.createDataFrame([(30.5, 50.4), (-177.0, 10.0), (151.0, -33.0), (179.99, 1.0)], "lon double, lat double")
    got = [r[0] for r in at.select(T.utm_code(F.col("lon"), F.col("lat"))).collect()]
    assert got == ["EPSG:32636", "EPSG:32601", "EPSG:32756", "EPSG:32660"]


def test_equal_orders_give_one_answer_on_either_way(spark):
    from scarmap.operators import cover as C

    shapes = [(k, 1, [[(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0), (0.0, 0.0)]]) for k in ("b", "a")]
    rows = with_geometry(spark.createDataFrame(shapes, f"k string, o int, rings {G.RINGS_DDL}"))
    grid = Grid(0.0, 0.0, 1.0, 1.0)
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 9.0, 9.0)], "id int, lon double, lat double")
    for limit in (0, 1000):
        got = {r.id: r.k for r in C.locate(points, C.cell_cover(rows, ["k", "o"], grid), grid, ["id"], "o", max_pieces=limit).collect()}
        assert got == {1: "b", 2: None}


def test_a_country_is_spread_over_tasks_and_tiles_carry_little(spark):
    from scarmap.operators import tiles as Q

    n = 400
    ring = [(30 + 4 * math.cos(2 * math.pi * i / n) * (1 + 0.3 * (i % 2)), 48 + 2 * math.sin(2 * math.pi * i / n) * (1 + 0.3 * (i % 2))) for i in range(n)]
    country = with_geometry(spark.createDataFrame([("c", [[*ring, ring[0]]])], f"k string, rings {G.RINGS_DDL}"))
    grid = Q.tile_grid(country, ["k"], 9)
    rows = grid.withColumn("p", F.spark_partition_id()).withColumn("size", (F.col("tile.maxx") - F.col("tile.minx")) * (F.col("tile.maxy") - F.col("tile.miny")))
    got = rows.agg(F.count_distinct("p").alias("p"), F.sum(F.col("area_in_country") * F.col("size")).alias("a"), F.sum(G.area(G.edges_of(F.col("rings")))).alias("b")).first()
    area = country.select(G.area(F.col("edges")).alias("a")).first().a
    assert got.p > 1 and got.a == pytest.approx(area) and got.b == pytest.approx(area)
    t = [F.col(f"tile.{x}") for x in ("minx", "miny", "maxx", "maxy")]
    every = Q.tiles_intersecting(country, ["k"], 9).crossJoin(country.select("edges"))
    assert every.where(~G.meets_box(F.col("edges"), *t)).count() == 0
    shares = Q.tile_area_share(Q.tiles_intersecting(country, ["k"], 9), country, ["k"], 9)
    assert shares.join(grid.select("qk", F.col("area_in_country").alias("b")), "qk").where("abs(area_in_country - b) > 1e-9").count() == 0
    cut = Q.clip_grid(Q.tiles_intersecting(country, ["k"], 9), country, ["k"], 9)
    assert cut.agg(F.sum(G.area(G.edges_of(F.col("rings"))))).first()[0] == pytest.approx(area)


def test_a_concave_polygon_is_tiled_by_area(spark):
    from scarmap.operators import tiles as Q

    u_shape = [(10.0, 10.0), (16.0, 10.0), (16.0, 15.0), (14.0, 15.0), (14.0, 11.5), (12.0, 11.5), (12.0, 15.0), (10.0, 15.0), (10.0, 10.0)]
    rows = with_geometry(spark.createDataFrame([(1, [u_shape])], f"k int, rings {G.RINGS_DDL}"))
    for zoom in (6, 8):
        grid = Q.tile_grid(rows, ["k"], zoom)
        a = F.col("area_in_country") * (F.col("tile.maxx") - F.col("tile.minx")) * (F.col("tile.maxy") - F.col("tile.miny"))
        assert grid.agg(F.sum(a)).first()[0] == pytest.approx(23.0)
        gap = grid.where("tile.minx > 12 and tile.maxx < 14 and tile.miny > 11.6 and tile.maxy < 14.9")
        assert gap.count() == 0


def test_row_bytes_follow_the_values(spark):
    from scarmap.cluster import row_bytes

    df = spark.createDataFrame([("x" * 100, [1, 2, 3], [(1.0, "ab")]), ("", None, [])], "a string, b array<long>, c array<struct<x:double,y:string>>")
    got = [r.n for r in df.select(row_bytes(df).alias("n")).collect()]
    assert got[0] > 100 + 3 * 8 + 16 > 60 > got[1]


def test_polygons_meet_as_all_their_edges_say(spark):
    rng = random.Random(11)
    grid = Grid(-1.0, -1.0, 0.7, 0.7)
    left = polygons(spark, *[star(rng, n) for n in (3, 4, 9, 40, 40, 12, 5, 7)], [SQUARE, HOLE], [U_SHAPE])
    right = polygons(spark, *[star(rng, n) for n in (60, 5, 30, 8)], [SQUARE, HOLE], [FAR]).withColumnRenamed("id", "other")
    got = {(r.id, r.other) for r in C.polygons_meeting(left, ["id"], C.cell_cover(right, ["other"], grid), grid).collect()}
    pairs = left.select("id", "edges").crossJoin(right.select("other", F.col("edges").alias("b")))
    want = {(r.id, r.other) for r in pairs.where(G.intersects(F.col("edges"), F.col("b"))).collect()}
    assert got == want and 0 < len(want) < 60
    assert C.polygons_meeting(left.limit(0), ["id"], C.cell_cover(right, ["other"], grid), grid).count() == 0


def test_work_in_a_cell_grows_with_its_edges():
    n = 10_000
    turn = np.linspace(0, 2 * math.pi, n + 1)

    def ring(radius, x=0.0):
        p = np.column_stack([x + radius * np.cos(turn), radius * np.sin(turn)])
        return np.hstack([p[:-1], p[1:]])

    grid, none = Grid(-10.0, -10.0, 20.0, 20.0), np.empty(0)
    for a, b, meet in ((ring(1.0), ring(1.001), True), (ring(1.0), ring(1.0, 2.001), False), (ring(1.0), ring(1.0, 1.0), True)):
        tested = sum(len(i) for i, _ in C.near_pairs(a, b))
        assert tested < 40 * n  # not n * n
        began = time.time()
        assert C.pieces_meet(grid, 0, 0, a, none, b, none) is meet
        assert time.time() - began < 5
