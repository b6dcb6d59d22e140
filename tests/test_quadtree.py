"""Cutting polygons into tiles: areas, touching and geometry against the whole polygon."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.standins import with_geometry
from scarmap.functions import geometry as G
from scarmap.operators import quadtree as Q
from scarmap.operators import tiles as T


def edges_of(rings):
    return np.array([(*a, *b) for r in rings for a, b in zip(r, r[1:], strict=False)], dtype=float)


def whole(rings, zoom):
    e = edges_of(rings)
    scheme = Q.Scheme(zoom)
    box = (e[:, ::2].min(), e[:, 1::2].min(), e[:, ::2].max(), e[:, 1::2].max())
    return scheme, Q.Part(*scheme.range(*box), e, np.empty(0), np.empty(0, dtype=np.int64))


def tiles(rings, zoom):
    """(tile, box, area, rings) of the tiles that a polygon touches."""
    scheme, part = whole(rings, zoom)
    for p in Q.descend(part, scheme, lambda p: not len(p.edges)):
        if len(p.edges):
            box = scheme.box(p.x0, p.y0, p.x1, p.y1)
            if Q.touches(p, box):
                area = Q.area_inside(p, box)
                yield (p.x0, p.y0), box, area, Q.rings_inside(p, box, area)
        else:
            for x in range(p.x0, p.x1 + 1):
                for y in range(p.y0, p.y1 + 1):
                    box = scheme.box(x, y, x, y)
                    yield (x, y), box, (box[2] - box[0]) * (box[3] - box[1]), [square(*box)]


def square(minx, miny, maxx, maxy):
    return [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]


def inside(rings, x, y):
    e = edges_of(rings)
    if not len(e):
        return False
    crossed = (e[:, 1] > y) != (e[:, 3] > y)
    at = e[crossed]
    return np.count_nonzero(at[:, 0] + (y - at[:, 1]) / (at[:, 3] - at[:, 1]) * (at[:, 2] - at[:, 0]) > x) % 2 == 1


def star(rng, cx, cy, radius, n, spiky=0.8):
    turn = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = [(cx + math.cos(a) * r, cy + math.sin(a) * r) for a in turn for r in [radius * (1 - spiky * rng.random())]]
    return [*ring, ring[0]]


def shapes():
    rng = random.Random(4)
    for i in range(12):
        outer = star(rng, 20 + rng.random(), 30 + rng.random(), 6, rng.choice([3, 5, 40, 300]), 0.7)
        # a hole inside the part that every star keeps
        hole = star(rng, *[sum(v) / len(outer) for v in zip(*outer, strict=True)], 0.4, 9, 0.5)[::-1]
        holds = all(inside([outer], *p) for p in hole) and not any(inside([hole[::-1]], *p) for p in outer)
        yield [outer, hole] if holds and i % 2 else [outer]
    comb = [(0.0, 0.0)] + [p for i in range(30) for p in ((30 - i, 0.0), (30 - i, 9.0), (29.5 - i, 9.0), (29.5 - i, 1.0))][:-1]
    yield [[*comb, (0.0, 9.0), (0.0, 0.0)]]
    yield [square(1, 1, 20, 12), square(3, 3, 5, 5)[::-1], square(30, 2, 31, 3)]  # a hole and a second part


@pytest.mark.parametrize("rings", list(shapes()))
@pytest.mark.parametrize("zoom", [3, 6, 8])
def test_cut_geometry_agrees_with_the_polygon(rings, zoom):
    rng, total = random.Random(zoom), 0.0
    met = {}
    for tile, box, area, cut in tiles(rings, zoom):
        met[tile] = box
        total += area
        assert sum(Q._signed(r) for r in cut) == pytest.approx(area, abs=1e-9)
        for ring in cut:
            assert ring[0] == ring[-1] and len(ring) > 3
            assert all(box[0] <= x <= box[2] and box[1] <= y <= box[3] for x, y in ring)
        for _ in range(6):
            x, y = rng.uniform(box[0], box[2]), rng.uniform(box[1], box[3])
            assert inside(cut, x, y) == inside(rings, x, y)
    assert total == pytest.approx(sum(Q._signed(r) for r in rings))
    # tiles that are left out hold nothing of the polygon
    scheme, part = whole(rings, zoom)
    for _ in range(200):
        x, y = rng.randint(part.x0, part.x1), rng.randint(part.y0, part.y1)
        box = scheme.box(x, y, x, y)
        if (x, y) not in met:
            assert not inside(rings, rng.uniform(box[0], box[2]), rng.uniform(box[1], box[3]))


def test_a_concave_ring_falls_apart():
    scheme = Q.Scheme(6)
    box = scheme.box(33, 30, 33, 30)
    w, h = box[2] - box[0], box[3] - box[1]
    x = lambda t: box[0] + t * w
    y = lambda t: box[1] + t * h
    # a U whose bottom lies below the tile: only its two arms are in it, one with a hole
    u = [(x(0.1), y(-0.5)), (x(0.9), y(-0.5)), (x(0.9), y(0.8)), (x(0.7), y(0.8)), (x(0.7), y(-0.2)), (x(0.3), y(-0.2)), (x(0.3), y(0.9)), (x(0.1), y(0.9)), (x(0.1), y(-0.5))]
    hole = square(x(0.15), y(0.3), x(0.25), y(0.4))[::-1]
    found = {t: cut for t, _, _, cut in tiles([u, hole], 6)}
    arms = found[33, 30]
    assert [Q._signed(r) > 0 for r in arms] == [True, True, False] and arms[2] == hole or sorted(arms[2]) == sorted(hole)
    assert sorted(round(Q._signed(r) / (w * h), 9) for r in arms) == [-0.01, 0.16, 0.18]
    assert len(found[33, 31]) == 1


def test_borders_that_lie_on_tiles():
    scheme = Q.Scheme(7)
    a, b = scheme.box(70, 50, 70, 50), scheme.box(71, 50, 71, 50)
    one = {t: (area, cut) for t, _, area, cut in tiles([square(*a)], 7)}
    # the tile itself has all of it; its neighbours are touched, without area or geometry
    assert one[70, 50][0] == pytest.approx((a[2] - a[0]) * (a[3] - a[1])) and one[70, 50][1] == [square(*a)]
    assert set(one) == {(x, y) for x in (69, 70, 71) for y in (49, 50, 51)}
    assert all(cut == [] and area == 0 for t, (area, cut) in one.items() if t != (70, 50))
    frame = [square(a[0], a[1], b[2], a[3]), square(*b)[::-1]]  # the hole fills the second tile
    cut = {t: c for t, _, _, c in tiles(frame, 7)}
    assert cut[70, 50] == [square(*a)] and cut[71, 50] == []


def test_corners_that_touch_a_border_from_inside_and_outside():
    scheme = Q.Scheme(7)
    minx, miny, maxx, maxy = scheme.box(70, 50, 70, 50)
    mx, my = (minx + maxx) / 2, (miny + maxy) / 2
    q = (maxx - minx) / 4
    diamond = [(mx, miny), (maxx, my), (mx, maxy), (minx, my), (mx, miny)]
    got = {t: c for t, _, _, c in tiles([diamond], 7)}[70, 50]
    assert len(got) == 1 and Q._signed(got[0]) == pytest.approx((maxx - minx) * (maxy - miny) / 2)
    # a hole that touches the top border in a point, and one that goes out and comes back in the same point
    around = square(minx - q, miny - q, maxx + q, maxy + q)
    hole = [(mx, maxy), (mx - q, my), (mx + q, my), (mx, maxy)][::-1]
    for ring in (hole, [(mx, maxy), (mx + q / 2, maxy + q / 2), (mx - q / 2, maxy + q / 2), (mx, maxy), (mx - q, my), (mx + q, my), (mx, maxy)]):
        ring = ring if Q._signed(ring) < 0 else ring[::-1]
        area, got = next((a, c) for t, _, a, c in tiles([around, ring], 7) if t == (70, 50))
        assert sum(map(Q._signed, got)) == pytest.approx(area) and not inside(got, mx, my + q / 9) and inside(got, minx + q / 9, my)


def country(n, wave=0.0):
    ring = [(30 + 4 * math.cos(2 * math.pi * i / n) * (1 + wave * (i % 2)), 48 + 2 * math.sin(2 * math.pi * i / n) * (1 + wave * (i % 2))) for i in range(n)]
    return [[*ring, ring[0]]]


def test_edges_that_are_moved_grow_with_the_border_not_with_the_tiles(spark):
    n = 20_000
    rows = with_geometry(spark.createDataFrame([("c", country(n))], f"k string, rings {G.RINGS_DDL}"))
    moved = {}
    for zoom in (8, 10, 12, 14):
        parts = Q.polygon_parts(rows, ["k"], zoom).withColumn("p", F.spark_partition_id())
        found = parts.agg(F.sum(F.size("edges")).alias("e"), F.sum(F.size("steps")).alias("s"), F.max(F.size("edges")).alias("most"), F.count("*").alias("n"), F.countDistinct("p").alias("p")).first()
        moved[zoom] = found.e + found.s
        assert (found.most <= Q.PART_EDGES or zoom == 8) and found.p > 1  # at zoom 8 single tiles have more edges
    # every edge once, and again where it crosses between parts: a term in the length of the border, 16 tiles to 1000
    assert all(m <= n * math.log2(2 ** (z - 6)) for z, m in moved.items()) and moved[14] < 1.6 * n


def test_tiles_far_inside_travel_as_ranges(spark):
    rows = with_geometry(spark.createDataFrame([("c", country(200))], f"k string, rings {G.RINGS_DDL}"))
    ranges = Q.polygon_tiles(rows, ["k"], 13, False)
    grid = T.tile_grid(rows, ["k"], 13, clip=False)
    inner = grid.where("area_in_country = 1").count()
    assert ranges.where("area is null").count() < inner / 10 and grid.count() > inner > 10_000
    assert grid.select("qk").distinct().count() == grid.count()


def test_clip_grid_on_a_concave_polygon_with_rows_of_all_kinds(spark):
    u = [(10.0, 10.0), (16.0, 10.0), (16.0, 15.0), (14.0, 15.0), (14.0, 11.5), (12.0, 11.5), (12.0, 15.0), (10.0, 15.0), (10.0, 10.0)]
    rows = with_geometry(spark.createDataFrame([(1, [u]), (2, None), (None, [square(10.0, 10.0, 11.0, 11.0)])], f"k int, rings {G.RINGS_DDL}"))
    for zoom in (4, 7):
        grid = T.tile_grid(rows, ["k"], zoom)
        assert grid.where("k = 2").count() == 0 and grid.where("k is null").count() > 0
        cut = T.clip_grid(T.tiles_intersecting(rows.where("k = 1"), ["k"], zoom), rows.where("k = 1"), ["k"], zoom)
        assert cut.agg(F.sum(G.area(G.edges_of(F.col("rings"))))).first()[0] == pytest.approx(23.0)
        for r in cut.collect():
            for ring in r.rings:
                points = [(p.x, p.y) for p in ring]
                assert Q._signed(points) > 0
                x, y = (sum(v) / len(v) for v in zip(*points[:-1], strict=True))
                assert inside([points], x, y) == inside([u], x, y)
    arms = [r for r in T.clip_grid(T.tiles_intersecting(rows.where("k = 1"), ["k"], 4), rows.where("k = 1"), ["k"], 4).collect()]
    assert sorted(len(r.rings) for r in arms)[-1] >= 1
    assert T.tile_grid(rows.limit(0), ["k"], 7).count() == 0


def test_small_polygons_of_one_partition_are_spread_and_their_rings_are_made_once(spark):
    x = F.col("id") % 97 / 10 + 10.0
    y = F.col("id") % 89 / 10 + 30.0
    rows = with_geometry(spark.range(0, 500, 1, 1).select("id", G.box_rings(x, y, x + 0.06, y + 0.05).alias("rings")))
    rows = rows.withColumn("rings", F.when(F.col("id") % 10 != 3, F.col("rings")))
    parts = Q.polygon_parts(rows, ["id"], 12)
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    # a filter on the rings would be moved before the spread, and hold all of what they are made from
    assert "RepartitionByExpression" in plan.split("MapInArrow")[0] and "Repartition" in plan.split("MapInArrow")[1] and "Filter" not in plan
    assert sorted(r.id for r in parts.select("id").distinct().collect()) == [i for i in range(500) if i % 10 != 3]


@pytest.mark.parametrize("zoom", [3, 7])
def test_polygons_in_one_block_are_cut_as_each_alone(zoom, monkeypatch):
    monkeypatch.setattr(Q, "BATCH_VALUES", 700)  # blocks are divided on the way
    held = [whole(rings, zoom)[1] for rings in shapes()]
    scheme = Q.Scheme(zoom)
    edges, starts = np.concatenate([p.edges for p in held]), np.cumsum([0, *[len(p.edges) for p in held]])
    ranges = np.array([(p.x0, p.y0, p.x1, p.y1) for p in held])
    no = np.empty(0, dtype=np.int64)
    block = Q.Block(np.arange(len(held)), ranges, starts, edges, np.zeros(len(held) + 1, dtype=np.int64), np.empty(0), no)
    got = {}
    for found in Q.descend_all(block, scheme, lambda b: b.sizes == 0):
        crossed = found.taken(np.flatnonzero(found.sizes))
        boxes = scheme.boxes(crossed.ranges)
        areas = Q.areas_inside(crossed, boxes)
        values = zip(Q.tiles_touched(crossed, boxes).tolist(), areas.tolist(), Q.rings_of_tiles(crossed, boxes, areas), strict=True)
        got |= {(row, *r): v for row, r, v in zip(crossed.rows.tolist(), crossed.ranges.tolist(), values, strict=True)}
        got |= {(row, *r): None for row, r, n in zip(found.rows.tolist(), found.ranges.tolist(), found.sizes, strict=True) if not n}
    assert len(got) > 100 or zoom == 3
    alone = {}
    for row, part in enumerate(held):
        for p in Q.descend(part, scheme, lambda p: not len(p.edges)):
            box, value = scheme.box(p.x0, p.y0, p.x1, p.y1), None
            if len(p.edges):
                area = Q.area_inside(p, box)
                value = (Q.touches(p, box), area, Q.rings_inside(p, box, area))
            alone[row, p.x0, p.y0, p.x1, p.y1] = value
    assert got.keys() == alone.keys()
    for k, v in got.items():
        assert v == alone[k] or (v[0], v[2]) == (alone[k][0], alone[k][2]) and v[1] == pytest.approx(alone[k][1])


def test_a_coordinate_that_is_no_number_is_an_error():
    scheme = Q.Scheme(5)
    for box in ((math.nan, 1.0, 2.0, 3.0), (1.0, 1.0, 2.0, math.nan), (1.0, 1.0, math.inf, 3.0)):
        with pytest.raises(ValueError):
            scheme.range(*box)
