"""Tiles, geometry, spatial joins, rasters, zonal means."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import standins as D
from checks.registry import query
from checks.standins import IN_ADMIN_SQL, PIXEL_GRID, REGION_GRID, YEARS, read, rounded, sql
from scarmap.functions import geometry as G
from scarmap.functions import tiles as T
from scarmap.functions import values as V
from scarmap.operators import cover as C
from scarmap.operators import raster as R
from scarmap.operators import regions as A
from scarmap.operators import tiles as Q
from scarmap.operators import zonal as Z
from scarmap.plans import buildings as B
from scarmap.plans import grid as PG
from scarmap.sources import readers, writers

ZOOM = 12
SIZE = 256 * 2**ZOOM


def clampsql(v, lo, hi):
    return f"least(greatest({v}, {lo}), {hi})"


def px_sql(lon, zoom=ZOOM):
    size = 256 * 2**zoom
    return clampsql(f"({lon} + 180) / 360 * {size}::DOUBLE + 0.5", 0, f"{size - 1}::DOUBLE")


def py_sql(lat, zoom=ZOOM):
    size = 256 * 2**zoom
    s = f"sin({lat} * pi() / 180)"
    return clampsql(f"(0.5 - ln((1 + {s}) / (1 - {s})) / (4 * pi())) * {size}::DOUBLE + 0.5", 0, f"{size - 1}::DOUBLE")


def tile_sql(expr):
    return f"CAST(floor({expr} / 256) AS INT)"


def qk_sql(x, y, zoom=ZOOM):
    return " || ".join(f"(({x} >> {z}) & 1) + 2 * (({y} >> {z}) & 1)" for z in reversed(range(zoom))).join(("(", ")")) if zoom == 1 else " || ".join(
        f"CAST((({x} >> {z}) & 1) + 2 * (({y} >> {z}) & 1) AS VARCHAR)" for z in reversed(range(zoom))
    )


def lon_sql(p, zoom=ZOOM):
    size = 256 * 2**zoom
    return f"360 * ({clampsql(p, 0, size - 1)} / {size}::DOUBLE - 0.5)"


def lat_sql(p, zoom=ZOOM):
    size = 256 * 2**zoom
    return f"(90 - 360 * atan(exp(-(0.5 - {clampsql(p, 0, size - 1)} / {size}::DOUBLE) * 2 * pi())) / pi())"


def _tiles(spark, sf):
    x, y = T.tile_of(F.col("lon"), F.col("lat"), ZOOM)
    return D.buildings(spark, sf).select("building_id", "lon", "lat", x.alias("tile_x"), y.alias("tile_y"))


_TILES = f"SELECT building_id, lon, lat, {tile_sql(px_sql('lon'))} AS tile_x, {tile_sql(py_sql('lat'))} AS tile_y FROM buildings"


@query("pixel_of_position", sql(f"SELECT building_id, round({px_sql('lon')}, 3) + 0.0 AS px, round({py_sql('lat')}, 3) + 0.0 AS py FROM buildings", "buildings"))
def pixel_of_position(spark, sf):
    px, py = T.pixel_of(F.col("lon"), F.col("lat"), ZOOM)
    return D.buildings(spark, sf).select("building_id", (F.round(px, 3) + 0.0).alias("px"), (F.round(py, 3) + 0.0).alias("py"))


@query("tile_of_position", sql(f"SELECT building_id, tile_x, tile_y FROM ({_TILES})", "buildings"))
def tile_of_position(spark, sf):
    return _tiles(spark, sf).drop("lon", "lat")


@query("quadkey", sql(f"SELECT building_id, {qk_sql('tile_x', 'tile_y')} AS qk FROM ({_TILES})", "buildings"))
def quadkey(spark, sf):
    return _tiles(spark, sf).select("building_id", T.quadkey(F.col("tile_x"), F.col("tile_y"), ZOOM).alias("qk"))


@query("position_of_pixel", f"SELECT o_orderkey, round({lon_sql('o_orderkey * 7.0::DOUBLE')} + 1e-9, 6) + 0.0 AS lon, round({lat_sql('o_custkey * 64.0::DOUBLE')} + 1e-9, 6) + 0.0 AS lat FROM orders")
def position_of_pixel(spark, sf):
    lon, lat = T.position_of_pixel(F.col("o_orderkey") * 7.0, F.col("o_custkey") * 64.0, ZOOM)
    return rounded(read(spark, sf, "orders").select("o_orderkey", lon.alias("lon"), lat.alias("lat")))


def _box_sql(x="tile_x", y="tile_y"):
    return (
        f"{lon_sql(f'{x} * 256.0::DOUBLE')} AS minx, {lat_sql(f'({y} + 1) * 256.0::DOUBLE')} AS miny, "
        f"{lon_sql(f'({x} + 1) * 256.0::DOUBLE')} AS maxx, {lat_sql(f'{y} * 256.0::DOUBLE')} AS maxy"
    )


_BOX4 = ", ".join(f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in ("minx", "miny", "maxx", "maxy"))


@query("tile_box", sql(f"SELECT building_id, {_BOX4} FROM (SELECT building_id, {_box_sql()} FROM ({_TILES}))", "buildings"))
def tile_box(spark, sf):
    return rounded(_tiles(spark, sf).select("building_id", T.tile_box(F.col("tile_x"), F.col("tile_y"), ZOOM).alias("b")).select("building_id", "b.*"))


@query("clamp", "SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS v FROM customer")
def clamp(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", V.clamp(F.col("c_acctbal"), 0.0, 5000.0).alias("v"))


@query(
    "utm_code",
    "SELECT c_custkey, CASE WHEN lat > 0 THEN 'EPSG:326' ELSE 'EPSG:327' END || lpad(CAST(CAST(floor(((lon + 180) / 6) % 60) AS INT) + 1 AS VARCHAR), 2, '0') AS utm"
    " FROM (SELECT c_custkey, c_custkey * 7919 % 360000 / 1000.0::DOUBLE - 180 AS lon, c_acctbal / 200 AS lat FROM customer)",
)
def utm_code(spark, sf):
    lon = F.col("c_custkey") * 7919 % 360000 / 1000.0 - 180
    return read(spark, sf, "customer").select("c_custkey", T.utm_code(lon, F.col("c_acctbal") / 200).alias("utm"))


# ---- geometry of rectangles and cut cells

_PENTAGON_AREA = 3.6 * 1.6 * 0.875
_CX = (0.5 - 0.125 * 5 / 6) / 0.875


@query("polygon_area", sql("SELECT building_id, round((maxx - minx) * (maxy - miny) + 1e-9, 6) + 0.0 AS area FROM shapes", "shapes"))
def polygon_area(spark, sf):
    return rounded(D.shapes(spark, sf).select("building_id", G.area(F.col("edges")).alias("area")))


@query("polygon_centroid", sql("SELECT building_id, round((minx + maxx) / 2 + 1e-9, 6) + 0.0 AS x, round((miny + maxy) / 2 + 1e-9, 6) + 0.0 AS y FROM shapes", "shapes"))
def polygon_centroid(spark, sf):
    c = G.centroid(F.col("edges"))
    return rounded(D.shapes(spark, sf).select("building_id", c["x"].alias("x"), c["y"].alias("y")))


@query(
    "region_area_and_centroid",
    sql(f"SELECT adm3_id, round({_PENTAGON_AREA}::DOUBLE + 1e-9, 6) + 0.0 AS area, round(x + 3.6 * {_CX}::DOUBLE + 1e-9, 6) + 0.0 AS cx, round(y + 1.6 * {_CX}::DOUBLE + 1e-9, 6) + 0.0 AS cy FROM admin", "admin"),
)
def region_area_and_centroid(spark, sf):
    c = G.centroid(F.col("edges"))
    return rounded(D.admin(spark, sf).select("adm3_id", G.area(F.col("edges")).alias("area"), c["x"].alias("cx"), c["y"].alias("cy")))


def _zone_sql(lat):
    e2 = G.FLATTENING * (2 - G.FLATTENING)
    e = math.sqrt(e2)
    s = f"sin({lat} * pi() / 180)"
    return f"({1 - e2!r}::DOUBLE * ({s} / (1 - {e2!r}::DOUBLE * {s} * {s}) - ln((1 - {e!r}::DOUBLE * {s}) / (1 + {e!r}::DOUBLE * {s})) / {2 * e!r}::DOUBLE))"


_SPHEROID = f"{G.SEMI_MAJOR}::DOUBLE ** 2 / 2 * (maxx - minx) * pi() / 180 * ({_zone_sql('maxy')} - {_zone_sql('miny')})"


@query("area_spheroid", sql(f"SELECT building_id, round({_SPHEROID}) + 0.0 AS area FROM shapes", "shapes"))
def area_spheroid(spark, sf):
    return D.shapes(spark, sf).select("building_id", (F.round(G.area_spheroid(F.col("edges")), 0) + 0.0).alias("area"))


@query(
    "project_buildings",
    sql(f"SELECT CAST(building_id AS VARCHAR) AS building_id, 'source ' || (building_id % 3) AS dataset, 'house' AS osm_class, round({_SPHEROID}) + 0.0 AS area, round(lon + 1e-9, 6) + 0.0 AS lon, round(lat + 1e-9, 6) + 0.0 AS lat FROM shapes", "shapes"),
)
def project_buildings(spark, sf):
    """WKB decoded, then id, source, area and centroid."""
    wkb = D.box_wkb(D.shapes(spark, sf), ["building_id"])
    source = F.to_json(F.array(F.struct(F.concat(F.lit("source "), F.col("building_id") % 3).alias("dataset"))))
    raw = wkb.select(F.col("building_id").cast("string").alias("id"), source.alias("sources"), F.lit("house").alias("class"), "geometry")
    out = readers.project_buildings(readers.normalise_geometry(raw)).drop("rings", "edges", "bbox")
    return rounded(out.withColumn("area", F.round("area", 0)), "lon", "lat").withColumn("area", F.col("area") + 0.0)


@query("normalise_geometry", sql("SELECT building_id, round(minx + 1e-9, 6) + 0.0 AS minx, round(maxy + 1e-9, 6) + 0.0 AS maxy, round((maxx - minx) * (maxy - miny) + 1e-9, 6) + 0.0 AS area, 5 AS n FROM shapes", "shapes"))
def normalise_geometry(spark, sf):
    out = readers.normalise_geometry(D.box_wkb(D.shapes(spark, sf), ["building_id"]))
    return rounded(out.select("building_id", "bbox.minx", "bbox.maxy", G.area(F.col("edges")).alias("area"), F.size(F.col("rings")[0]).alias("n")))


@query("polygons_from_geojson", sql("SELECT building_id, round((maxx - minx) * (maxy - miny) + 1e-9, 6) + 0.0 AS area, 'A' || (building_id % 5) AS aoi FROM shapes", "shapes"))
def polygons_from_geojson(spark, sf):
    rows = D.shapes(spark, sf).withColumn("aoi", F.concat(F.lit("A"), F.col("building_id") % 5))
    lines = writers.geojson_lines(rows, writers.polygon_geometry(), ["building_id", "aoi"])
    back = readers.polygons_of(lines, "building_id long, aoi string")
    return rounded(back.select("building_id", "aoi", G.area(F.col("edges")).alias("area")))


@query("aoi_geometry", sql("SELECT adm3_id, 1 AS n_rings, round(x + 1e-9, 6) + 0.0 AS minx FROM admin WHERE adm3_id = '3_7'", "admin"))
def aoi_geometry(spark, sf):
    one = readers.aoi_geometry(D.admin(spark, sf).withColumnRenamed("adm3_id", "aoi"), "3_7")
    return rounded(one.select(F.col("aoi").alias("adm3_id"), F.size("rings").alias("n_rings"), "bbox.minx"))


@query("scan_buildings_bbox", sql("SELECT building_id FROM shapes WHERE minx >= 25.5 AND miny >= 46.25 AND maxx <= 33 AND maxy <= 50", "shapes"))
def scan_buildings_bbox(spark, sf):
    return readers.within_bbox(D.shapes(spark, sf), (25.5, 46.25, 33.0, 50.0)).select("building_id")


# ---- spatial joins

_HIT = f"SELECT b.building_id, a.* FROM buildings b JOIN admin a ON {IN_ADMIN_SQL}"


def _cover(spark, sf, keys):
    return C.cell_cover(D.admin(spark, sf), keys, REGION_GRID)


@query("point_in_polygon", sql(f"SELECT building_id, adm3_id FROM ({_HIT})", "buildings", "admin"))
def point_in_polygon(spark, sf):
    points = D.buildings(spark, sf).select("building_id", "lon", "lat")
    return C.points_in_polygons(points, _cover(spark, sf, ["adm3_id"]), REGION_GRID).select("building_id", "adm3_id")


@query("assign_admin", sql(f"SELECT b.building_id, h.adm3_id, h.ADM1_EN, h.ADM3_EN FROM buildings b LEFT JOIN ({_HIT}) h USING (building_id)", "buildings", "admin"))
def assign_admin(spark, sf):
    points = D.buildings(spark, sf).select("building_id", "lon", "lat")
    cover = _cover(spark, sf, ["adm3_id", "ADM1_EN", "ADM3_EN", "row_id"])
    return C.locate(points, cover, REGION_GRID, ["building_id"], "row_id").drop("lon", "lat")


@query("assign_admin_many_pieces", sql(f"SELECT b.building_id, h.adm3_id FROM buildings b LEFT JOIN ({_HIT}) h USING (building_id)", "buildings", "admin"))
def assign_admin_many_pieces(spark, sf):
    """The way for cells in which very many polygons meet."""
    points = D.buildings(spark, sf).select("building_id", "lon", "lat")
    cover = _cover(spark, sf, ["adm3_id", "row_id"])
    return C.locate(points, cover, REGION_GRID, ["building_id"], "row_id", max_pieces=0).drop("lon", "lat")


@query("within_country", sql(f"SELECT building_id FROM ({_HIT}) WHERE ADM1_EN <> 'region 2'", "buildings", "admin"))
def within_country(spark, sf):
    country = D.admin(spark, sf).where("ADM1_EN <> 'region 2'").select("edges", "bbox")
    return B.within_country(D.buildings(spark, sf).select("building_id", "lon", "lat"), country, REGION_GRID).select("building_id")


_AOIS = """SELECT s_suppkey AS aoi, x, y, x + 0.4 AS x2, y + 0.3 AS y2 FROM (SELECT s_suppkey,
  22 + s_suppkey * 7127 % 18000 / 1000.0::DOUBLE AS x, 44.4 + s_suppkey * 3571 % 8000 / 1000.0::DOUBLE AS y FROM supplier)"""


def _aois(spark, sf):
    x = F.col("s_suppkey") * 7127 % 18000 / 1000.0 + 22.0
    y = F.col("s_suppkey") * 3571 % 8000 / 1000.0 + 44.4
    return readers.with_geometry(read(spark, sf, "supplier").select(F.col("s_suppkey").alias("aoi"), G.box_rings(x, y, x + 0.4, y + 0.3).alias("rings")))


@query("buildings_in_aoi", sql(f"SELECT building_id, aoi FROM shapes JOIN ({_AOIS}) a ON minx <= x2 AND maxx >= x AND miny <= y2 AND maxy >= y", "shapes"))
def buildings_in_aoi(spark, sf):
    return B.buildings_in_aoi(D.shapes(spark, sf), _aois(spark, sf), REGION_GRID)


_NEAR_POINTS = """SELECT o_orderkey AS unosat_id, lon + (o_orderkey % 41 - 20) * 0.000013::DOUBLE + (0.011 + building_id % 13 * 0.002::DOUBLE) AS lon,
  lat + (o_orderkey % 37 - 18) * 0.000011::DOUBLE + (0.008 + building_id % 7 * 0.003::DOUBLE) AS lat FROM orders JOIN buildings ON o_custkey = building_id"""
_M = f"{G.METRES_PER_DEGREE!r}::DOUBLE"
_DX = f"greatest(minx - p.lon, 0, p.lon - maxx) * {_M} * cos(radians(p.lat))"
_DY = f"greatest(miny - p.lat, 0, p.lat - maxy) * {_M}"


@query(
    "labels_near_buildings",
    sql(f"SELECT unosat_id, building_id FROM shapes s JOIN ({_NEAR_POINTS}) p ON minx < p.lon + 0.001 AND maxx > p.lon - 0.001 AND miny < p.lat + 0.001 AND maxy > p.lat - 0.001"
        f" WHERE ({_DX}) ** 2 + ({_DY}) ** 2 <= 25", "shapes", "buildings"),
)
def labels_near_buildings(spark, sf):
    """Points around the corners of buildings, some within 5 m, some not."""
    points, shapes = _near_points(spark, sf), D.shapes(spark, sf).drop("lon", "lat")
    return B.labels_near_buildings(points, shapes, 5.0, PIXEL_GRID).select("unosat_id", "building_id")


def _near_points(spark, sf):
    b = D.buildings(spark, sf)
    key, order = F.col("building_id"), F.col("o_orderkey")
    return read(spark, sf, "orders").join(b, F.col("o_custkey") == key).select(
        order.alias("unosat_id"),
        (F.col("lon") + (order % 41 - 20) * 0.000013 + (F.lit(0.011) + key % 13 * 0.002)).alias("lon"),
        (F.col("lat") + (order % 37 - 18) * 0.000011 + (F.lit(0.008) + key % 7 * 0.003)).alias("lat"),
    )


# Label points of the kind above, their area named after a region.
_LABELS = f"SELECT p.*, 'region ' || (unosat_id % 5) AS aoi, CAST(left(o_orderpriority, 1) AS INT) AS damage, CAST(o_orderdate AS DATE) AS date FROM ({_NEAR_POINTS}) p JOIN orders ON o_orderkey = unosat_id"
_MEETS = "s.minx <= a.x + 3.6 AND s.maxx >= a.x AND s.miny <= a.y + 1.6 AND s.maxy >= a.y AND (greatest(s.minx, a.x) - a.x) / 3.6 + (greatest(s.miny, a.y) - a.y) / 1.6 <= 1.5"
_ENRICHED = f"""SELECT CAST(h.building_id AS VARCHAR) AS building_id, w.damage AS unosat_damage, w.unosat_id, w.aoi AS unosat_aoi, w.date AS unosat_date,
  h.ADM1_EN, h.ADM3_EN, h.adm3_id, '1_' || right(h.ADM1_EN, 1) AS adm1_id, '2_' || right(h.ADM1_EN, 1) AS adm2_id
FROM ({_HIT}) h LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY damage, unosat_id) AS k FROM (
    SELECT DISTINCT s.building_id, p.unosat_id, p.damage, p.aoi, p.date FROM shapes s
    JOIN ({_LABELS}) p ON minx < p.lon + 0.001 AND maxx > p.lon - 0.001 AND miny < p.lat + 0.001 AND maxy > p.lat - 0.001
    JOIN admin a ON a.ADM1_EN = p.aoi AND {_MEETS}
    WHERE ({_DX}) ** 2 + ({_DY}) ** 2 <= 25)) w ON w.building_id = h.building_id AND w.k = 1"""


@query("enrich_buildings", sql(_ENRICHED, "shapes", "buildings", "admin"))
def enrich_buildings(spark, sf):
    """Raw WKB buildings: country filter, worst label in reach, region of the centroid."""
    shapes, regions = D.shapes(spark, sf), D.admin(spark, sf)
    wkb = D.box_wkb(shapes, ["building_id"])
    source = F.lit('[{"dataset": "source"}]')
    raw = readers.normalise_geometry(wkb.select(F.col("building_id").cast("string").alias("id"), source.alias("sources"), F.lit("house").alias("class"), "geometry"))
    points = _near_points(spark, sf)
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("unosat_id"), F.concat(F.lit("region "), F.col("o_orderkey") % 5).alias("aoi"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("damage"), F.to_date("o_orderdate").alias("date"),
    )
    aois = regions.select(F.col("ADM1_EN").alias("aoi"), "rings", "edges", "bbox")
    parent = regions.select("ADM1_EN", F.lit("district").alias("ADM2_EN"), F.substring("ADM1_EN", -1, 1).alias("n")).distinct()
    adm1 = parent.select("ADM1_EN", readers.admin_id(1, F.col("n")).alias("admin_id"))
    adm2 = parent.select("ADM1_EN", "ADM2_EN", readers.admin_id(2, F.col("n")).alias("admin_id"))
    adm3 = regions.select(F.col("adm3_id").alias("admin_id"), "row_id", "ADM1_EN", F.lit("district").alias("ADM2_EN"), "ADM3_EN", "rings", "edges", "bbox")
    out = B.enrich_buildings(raw, regions, points.join(orders, "unosat_id"), aois, adm1, adm2, adm3, aoi_grid=REGION_GRID)
    return out.select("building_id", "unosat_damage", "unosat_id", "unosat_aoi", "unosat_date", "ADM1_EN", "ADM3_EN", "adm3_id", "adm1_id", "adm2_id")


_TILES_OF = f"""SELECT building_id, s.minx AS bx0, s.miny AS by0, s.maxx AS bx1, s.maxy AS by1, tile_x, tile_y FROM (
  SELECT *, unnest(range({tile_sql(px_sql('minx'))}, {tile_sql(px_sql('maxx'))} + 1)) AS tile_x FROM shapes) s,
  unnest(range({tile_sql(py_sql('s.maxy'))}, {tile_sql(py_sql('s.miny'))} + 1)) AS t(tile_y)"""
_TILED = f"SELECT * FROM (SELECT building_id, tile_x, tile_y, bx0, by0, bx1, by1, {_box_sql()} FROM ({_TILES_OF})) WHERE minx <= bx1 AND maxx >= bx0 AND miny <= by1 AND maxy >= by0"


@query("tiles_intersecting", sql(f"SELECT building_id, {qk_sql('tile_x', 'tile_y')} AS qk FROM ({_TILED})", "shapes"))
def tiles_intersecting(spark, sf):
    return Q.tiles_intersecting(D.shapes(spark, sf), ["building_id"], ZOOM).select("building_id", "qk")


_SHARE = "(greatest(least(maxx, bx1) - greatest(minx, bx0), 0) * greatest(least(maxy, by1) - greatest(miny, by0), 0))"


@query("tile_area_share", sql(f"SELECT building_id, {qk_sql('tile_x', 'tile_y')} AS qk, round({_SHARE} / ((maxx - minx) * (maxy - miny)) + 1e-9, 6) + 0.0 AS area_in_country FROM ({_TILED})", "shapes"))
def tile_area_share(spark, sf):
    shapes = D.shapes(spark, sf)
    tiles = Q.tiles_intersecting(shapes, ["building_id"], ZOOM)
    return rounded(Q.tile_area_share(tiles, shapes, ["building_id"], ZOOM).select("building_id", "qk", "area_in_country"))


@query("build_tile_grid", sql(f"SELECT building_id, {qk_sql('tile_x', 'tile_y')} AS qk, round({_SHARE} + 1e-9, 6) + 0.0 AS area FROM ({_TILED}) WHERE {_SHARE} > 0", "shapes"))
def build_tile_grid(spark, sf):
    """Tiles, share and geometry cut to the border; the area is that of the cut geometry."""
    grid = PG.build_tile_grid(D.shapes(spark, sf), ["building_id"], ZOOM)
    return rounded(grid.where("area_in_country > 0").select("building_id", "qk", G.area(G.edges_of(F.col("rings"))).alias("area")))


# a U whose arms are a quarter of the box wide: tiles above its bottom hold one arm or two
_U = {
    "bottom": ("bx0", "by0", "bx1", "by0 + (by1 - by0) / 4"),
    "left_arm": ("bx0", "by0", "bx0 + (bx1 - bx0) / 4", "by1"),
    "right_arm": ("bx1 - (bx1 - bx0) / 4", "by0", "bx1", "by1"),
    "notch": ("bx0 + (bx1 - bx0) / 4", "by0 + (by1 - by0) / 4", "bx1 - (bx1 - bx0) / 4", "by1"),
}
_U_SQL = f"SELECT *, {_SHARE} AS box, " + ", ".join(f"(greatest(least(maxx, {c}) - greatest(minx, {a}), 0) * greatest(least(maxy, {d}) - greatest(miny, {b}), 0)) AS {n}" for n, (a, b, c, d) in _U.items()) + f" FROM ({_TILED})"


@query("clip_grid", sql(f"""SELECT building_id, {qk_sql('tile_x', 'tile_y')} AS qk, round(box - notch + 1e-9, 6) + 0.0 AS area,
  CASE WHEN bottom > 0 THEN 1 ELSE (left_arm > 0)::INT + (right_arm > 0)::INT END AS n_rings
  FROM ({_U_SQL}) WHERE bottom > 0 OR left_arm > 0 OR right_arm > 0""", "shapes"))
def clip_grid(spark, sf):
    """Concave polygons cut to their tiles: area and number of the rings they fall into."""
    b, p = (lambda n: F.col(f"bbox.{n}")), (lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    x0, y0, x1, y1 = (b(n) for n in ("minx", "miny", "maxx", "maxy"))
    a, c, h = x0 + (x1 - x0) / 4, x1 - (x1 - x0) / 4, y0 + (y1 - y0) / 4
    ring = F.array(*[p(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (c, y1), (c, h), (a, h), (a, y1), (x0, y1), (x0, y0))])
    shapes = D.shapes(spark, sf).select("building_id", "bbox", F.array(ring).alias("rings"))
    cut = Q.clip_grid(Q.tiles_intersecting(shapes, ["building_id"], ZOOM), shapes, ["building_id"], ZOOM).where(F.size("rings") > 0)
    return rounded(cut.select("building_id", "qk", G.area(G.edges_of(F.col("rings"))).alias("area"), F.size("rings").alias("n_rings")))


def _tiles_with_key(spark, sf):
    x, y = T.tile_of(F.col("lon"), F.col("lat"), 8)
    return D.buildings(spark, sf).select(T.quadkey(x, y, 8).alias("qk"), "adm1_id")


_TILE8 = f"SELECT {qk_sql('x', 'y', 8)} AS qk, adm1_id FROM (SELECT {tile_sql(px_sql('lon', 8))} AS x, {tile_sql(py_sql('lat', 8))} AS y, adm1_id FROM buildings)"


@query("list_tiles", sql(f"SELECT DISTINCT qk FROM ({_TILE8})", "buildings"))
def list_tiles(spark, sf):
    return Q.list_tiles(_tiles_with_key(spark, sf))


@query("list_tiles_limit", sql(f"SELECT DISTINCT qk FROM ({_TILE8}) ORDER BY qk LIMIT 7", "buildings"))
def list_tiles_limit(spark, sf):
    return Q.list_tiles(_tiles_with_key(spark, sf), limit=7)


@query("pending_tiles", sql(f"SELECT DISTINCT qk FROM ({_TILE8}) EXCEPT SELECT qk FROM ({_TILE8}) WHERE adm1_id = '2'", "buildings"))
def pending_tiles(spark, sf):
    """Tiles in which a building of region 2 lies are done."""
    tiles = _tiles_with_key(spark, sf)
    return Q.pending(Q.list_tiles(tiles), tiles.where("adm1_id = '2'").select("qk").distinct())


# ---- rasters

_MAXY = "(SELECT max(cy) FROM raster)"


@query("pixels_in_bounds", sql("SELECT cx, cy, value FROM raster WHERE cx BETWEEN 10 AND 20 AND cy BETWEEN 5 AND 300", "raster"))
def pixels_in_bounds(spark, sf):
    return R.pixels_in(D.raster(spark, sf), 10, 5, 20, 300, "cx", "cy")


@query("pixel_square", sql("SELECT cx, cy, cx - 0.5::DOUBLE AS minx, cy - 0.5::DOUBLE AS miny, cx + 0.5::DOUBLE AS maxx, cy + 0.5::DOUBLE AS maxy FROM raster", "raster"))
def pixel_square(spark, sf):
    return D.raster(spark, sf).select("cx", "cy", D.RASTER_GRID.box(F.col("cx"), F.col("cy")).alias("b")).select("cx", "cy", "b.*")


_HOLES = "SELECT cx, cy, CASE WHEN value < 0.2 THEN value END AS value FROM raster WHERE abs(value) > 0.01"


@query("focal_mean", sql(f"SELECT p.cx, p.cy, round(avg(q.value) + 1e-9, 6) + 0.0 AS value FROM ({_HOLES}) p JOIN (SELECT CAST(cx + i AS INT) AS cx, CAST(cy + j AS INT) AS cy, value FROM ({_HOLES}) CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(j)) q USING (cx, cy) GROUP BY 1, 2", "raster"))
def focal_mean(spark, sf):
    """Raster with missing cells (values near 0) and missing values (high ones)."""
    cells = D.raster(spark, sf).where("abs(value) > 0.01").withColumn("value", F.when(F.col("value") < 0.2, F.col("value")))
    return rounded(R.focal_mean(cells.withColumn("scene_id", F.lit(1)), ["scene_id"], ["value"]).drop("scene_id"))


@query("mosaic_tiles", sql("SELECT cx, cy, CASE WHEN cy >= 200 THEN -value ELSE value END AS value FROM raster", "raster"))
def mosaic_tiles(spark, sf):
    """Two halves that overlap; where both have a value the second wins."""
    r = D.raster(spark, sf)
    first = r.where("cy < 300").withColumn("tile", F.lit(1))
    second = r.where("cy >= 200").withColumns({"tile": F.lit(2), "value": -F.col("value")})
    return R.mosaic(first.unionByName(second), ["cx", "cy"], "tile")


_NEAR_AT = "SELECT c_custkey AS unosat_id, c_custkey * 7919 % 70000 / 1000.0::DOUBLE - 2 AS lon, c_custkey * 104729 % 520000 / 1000.0::DOUBLE - 5 AS lat FROM customer"


def _nearest(spark, sf, size, how):
    key = F.col("c_custkey")
    points = read(spark, sf, "customer").select(
        key.alias("unosat_id"), (key * 7919 % 70000 / 1000.0 - 2).alias("lon"), (key * 104729 % 520000 / 1000.0 - 5).alias("lat")
    )
    r = D.raster(spark, sf).withColumn("post_date", F.lit(1))
    last = r.agg(F.max("cy")).first()[0]
    return rounded(R.nearest_values(points, r, D.RASTER_GRID, (0, 63, 0, last), ["unosat_id"], size=size, how=how).drop("post_date"))


def _nearest_sql(size, agg):
    cell = f"SELECT unosat_id, least(greatest(floor(lon + 0.5), 0), 63) AS px, least(greatest(floor(lat + 0.5), 0), {_MAXY}) AS py FROM ({_NEAR_AT})"
    h = size // 2
    return sql(f"SELECT unosat_id, round({agg}(value) + 1e-9, 6) + 0.0 AS value FROM ({cell}) p JOIN raster r ON abs(r.cx - px) <= {h} AND abs(r.cy - py) <= {h} GROUP BY 1", "raster")


@query("nearest_pixel", _nearest_sql(1, "max"))
def nearest_pixel(spark, sf):
    return _nearest(spark, sf, 1, "mean")


@query("nearest_window_max", _nearest_sql(3, "max"))
def nearest_window_max(spark, sf):
    return _nearest(spark, sf, 3, "max")


@query("nearest_window_mean", _nearest_sql(5, "avg"))
def nearest_window_mean(spark, sf):
    return _nearest(spark, sf, 5, "mean")


# ---- pixels onto buildings

_P = "22 + cx * 0.01::DOUBLE"
_Q = "44.4 + cy * 0.01::DOUBLE"
_PIECE = f"greatest(least({_P} + 0.01, maxx) - greatest({_P}, minx), 0) * greatest(least({_Q} + 0.01, maxy) - greatest({_Q}, miny), 0)"
_PIECES = f"""SELECT building_id, CAST(cx AS INT) AS cx, cy, post_date, value, {_PIECE} AS overlap_area FROM (
  SELECT *, unnest(range(CAST(floor((minx - 22) / 0.01) AS INT), CAST(floor((maxx - 22) / 0.01) AS INT) + 1)) AS cx,
    CAST(floor((miny - 44.4) / 0.01) AS INT) AS cy0, CAST(floor((maxy - 44.4) / 0.01) AS INT) AS cy1 FROM shapes) s
  JOIN pred_pixels p USING (cx) WHERE p.cy BETWEEN s.cy0 AND s.cy1 AND {_PIECE} > 1e-13"""
_ZONAL = "SELECT building_id, post_date, sum(value * overlap_area) / sum(overlap_area) AS weighted_mean, max(value) AS max FROM ({}) GROUP BY 1, 2"


@query("pixels_x_buildings", sql(f"SELECT building_id, cx, cy, post_date, value, round(overlap_area, 9) + 0.0 AS overlap_area FROM ({_PIECES})", "shapes", "pred_pixels"))
def pixels_x_buildings(spark, sf):
    out = Z.pixels_x_buildings(D.shapes(spark, sf), D.pred_pixels(spark, sf), PIXEL_GRID)
    return out.withColumn("overlap_area", F.round("overlap_area", 9) + 0.0)


@query(
    "zonal_stats",
    sql(f"SELECT b.building_id, z.post_date, round(weighted_mean, 4) + 0.0 AS weighted_mean, max FROM shapes b LEFT JOIN ({_ZONAL.format(_PIECES)}) z USING (building_id)", "shapes", "pred_pixels"),
)
def zonal_stats(spark, sf):
    out = Z.zonal_stats(D.shapes(spark, sf).select("building_id", "edges", "bbox"), D.pred_pixels(spark, sf), PIXEL_GRID)
    return out.drop("edges", "bbox").withColumn("weighted_mean", F.round("weighted_mean", 4) + 0.0)


@query(
    "predictions_to_buildings",
    sql("SELECT b.building_id, " + ", ".join(f"round(p.pred_{y}, 4) + 0.0 AS pred_{y}" for y in YEARS) + " FROM shapes b LEFT JOIN (SELECT building_id, "
        + ", ".join(f"max(CASE WHEN post_date = {y} THEN weighted_mean END) AS pred_{y}" for y in YEARS) + f" FROM ({_ZONAL.format(_PIECES)}) GROUP BY 1) p USING (building_id)", "shapes", "pred_pixels"),
)
def predictions_to_buildings(spark, sf):
    """Overlapping tiles to raster, raster to buildings, one column per window. A cell on the border of tiles is in each
    of them; the value of the last one is right."""
    p = D.pred_pixels(spark, sf)
    b = PIXEL_GRID.box(F.col("cx"), F.col("cy"))
    (x0, y0), (x1, y1) = T.tile_holding(b["minx"], b["maxy"], 8), T.tile_holding(b["maxx"], b["miny"], 8)
    met = p.withColumns({"x1": x1, "y1": y1}).withColumn("x", F.explode_outer(F.sequence(x0, x1))).withColumn("y", F.explode_outer(F.sequence(y0, "y1")))
    last = (F.col("x") == F.col("x1")) & (F.col("y") == F.col("y1"))  # ids grow with both numbers of a tile
    tiles = met.withColumn("qk", T.quadkey(F.col("x"), F.col("y"), 8)).withColumn("value", F.when(last, F.col("value")).otherwise(-1.0))
    shapes = D.shapes(spark, sf).select("building_id", "edges", "bbox")
    out = B.predictions_to_buildings(shapes, tiles, PIXEL_GRID, YEARS, zoom=8).drop("edges", "bbox")
    return out.withColumns({f"pred_{y}": F.round(f"pred_{y}", 4) + 0.0 for y in YEARS})


_OZ = _ZONAL.format("SELECT * FROM overlap")


@query("zonal_weighted_mean", sql(f"SELECT building_id, post_date, round(weighted_mean + 1e-9, 6) + 0.0 AS weighted_mean FROM ({_OZ})", "overlap"))
def zonal_weighted_mean(spark, sf):
    return rounded(Z.zonal_measures(D.overlap(spark, sf)).drop("max"))


@query("zonal_max", sql(f"SELECT building_id, post_date, max FROM ({_OZ})", "overlap"))
def zonal_max(spark, sf):
    return Z.zonal_measures(D.overlap(spark, sf)).drop("weighted_mean")


@query("attach_zonal", sql(f"SELECT p_partkey AS building_id, p_name, post_date, round(weighted_mean + 1e-9, 6) + 0.0 AS weighted_mean, max FROM part LEFT JOIN ({_OZ}) ON building_id = p_partkey", "overlap"))
def attach_zonal(spark, sf):
    b = read(spark, sf, "part").select(F.col("p_partkey").alias("building_id"), "p_name")
    return rounded(Z.attach_zonal(b, Z.zonal_measures(D.overlap(spark, sf))), "weighted_mean")


_OYEARS = list(range(1995, 2002))
_OWIDE = ", ".join(f"max(CASE WHEN post_date = {y} THEN weighted_mean END) AS pred_{y}" for y in _OYEARS)


@query(
    "collect_preds",
    sql("SELECT p_partkey AS building_id, p_name, " + ", ".join(f"round(pred_{y} + 1e-9, 6) + 0.0 AS pred_{y}" for y in _OYEARS)
        + f" FROM part LEFT JOIN (SELECT building_id, {_OWIDE} FROM ({_OZ}) GROUP BY 1) ON building_id = p_partkey", "overlap"),
)
def collect_preds(spark, sf):
    b = read(spark, sf, "part").select(F.col("p_partkey").alias("building_id"), "p_name")
    return rounded(Z.collect_preds(b, Z.zonal_measures(D.overlap(spark, sf)), _OYEARS))


@query("pivot_dates", sql("SELECT building_id, " + ", ".join(f"max(CASE WHEN post_date = {y} THEN value END) AS pred_{y}" for y in YEARS) + " FROM building_preds GROUP BY 1", "building_preds"))
def pivot_dates(spark, sf):
    return R.spread_dates(D.building_preds(spark, sf), ["building_id"], YEARS, "post_date", "value")


@query("unpivot_dates", sql("SELECT building_id, CAST(post_date AS VARCHAR) AS post_date, value FROM building_preds", "building_preds"))
def unpivot_dates(spark, sf):
    wide = R.spread_dates(D.building_preds(spark, sf), ["building_id"], YEARS, "post_date", "value")
    return R.gather_dates(wide, ["building_id"], YEARS)


@query("sorted_measures", sql(f"SELECT building_id, post_date, round(weighted_mean + 1e-9, 6) + 0.0 AS weighted_mean, max FROM ({_OZ}) ORDER BY 1, 2", "overlap"))
def sorted_measures(spark, sf):
    return Z.sorted_measures(rounded(Z.zonal_measures(D.overlap(spark, sf)), "weighted_mean"))


@query("admin_hierarchy", """SELECT c_custkey AS row_id, '3_' || c_custkey AS adm3_id, 'region ' || n_regionkey AS ADM1_EN, c_mktsegment AS ADM2_EN, c_name AS ADM3_EN,
  '1_' || n_regionkey AS adm1_id, '2_' || n_regionkey || left(c_mktsegment, 3) AS adm2_id FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def admin_hierarchy(spark, sf):
    """District names repeat in every region."""
    rows = read(spark, sf, "customer").join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    adm3 = rows.select(
        F.col("c_custkey").alias("row_id"), readers.admin_id(3, F.col("c_custkey")).alias("admin_id"),
        F.concat(F.lit("region "), F.col("n_regionkey")).alias("ADM1_EN"), F.col("c_mktsegment").alias("ADM2_EN"), F.col("c_name").alias("ADM3_EN"), "n_regionkey",
    )
    adm1 = adm3.select("ADM1_EN", readers.admin_id(1, F.col("n_regionkey")).alias("admin_id")).distinct()
    adm2 = adm3.select("ADM1_EN", "ADM2_EN", readers.admin_id(2, F.concat("n_regionkey", F.substring("ADM2_EN", 1, 3))).alias("admin_id")).distinct()
    return A.admin_hierarchy(adm1, adm2, adm3.drop("n_regionkey"))


@query("admin_ids", "SELECT n_name, '2_' || n_nationkey AS admin_id FROM nation")
def admin_ids(spark, sf):
    return read(spark, sf, "nation").select("n_name", readers.admin_id(2, F.col("n_nationkey")).alias("admin_id"))
