"""Quadkey tiles over polygons, and which of them are still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.functions import geometry as G
from scarmap.functions import tiles as T
from scarmap.operators.quadtree import each_tile, polygon_tiles


def tile_grid(polygons: DataFrame, keys: list[str], zoom: int, clip: bool = True, out: str = "area_in_country", rings: str = "rings", box: str = "bbox") -> DataFrame:
    """(keys, qk, tile_x, tile_y, tile, share of area, cut rings) of every tile that shares a point with its polygon, in one pass.

    Tiles beside the polygon's range of pixels are left out, also if they touch it.
    """
    c = lambda n: F.col(f"{box}.{n}")
    x0, y0 = T.tile_of(c("minx"), c("maxy"), zoom)
    x1, y1 = T.tile_of(c("maxx"), c("miny"), zoom)
    held = polygons.withColumn("_range", F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))
    rows, inside = each_tile(polygon_tiles(held, [*keys, "_range"], zoom, clip, rings))
    met = rows.where(F.col("tile_x").between(F.col("_range.x0"), F.col("_range.x1")) & F.col("tile_y").between(F.col("_range.y0"), F.col("_range.y1")))
    met = met.withColumn("tile", T.tile_box(F.col("tile_x"), F.col("tile_y"), zoom))
    share = F.when(inside, 1.0).otherwise(F.col("area") / _tile_area()).alias(out)
    cut = [F.when(inside, G.box_rings(*_tile_sides())).otherwise(F.col("rings")).alias("rings")] if clip else []
    return met.select(*keys, T.quadkey(F.col("tile_x"), F.col("tile_y"), zoom).alias("qk"), "tile_x", "tile_y", "tile", share, *cut)


def _tile_sides() -> list[Column]:
    return [F.col(f"tile.{n}") for n in ("minx", "miny", "maxx", "maxy")]


def _tile_area() -> Column:
    minx, miny, maxx, maxy = _tile_sides()
    return (maxx - minx) * (maxy - miny)


def tiles_intersecting(polygons: DataFrame, keys: list[str], zoom: int, rings: str = "rings", box: str = "bbox") -> DataFrame:
    """(keys, qk, tile_x, tile_y, tile) for every tile that shares a point with the polygon."""
    return tile_grid(polygons, keys, zoom, clip=False, rings=rings, box=box).drop("area_in_country")


def tile_area_share(tiles: DataFrame, polygons: DataFrame, keys: list[str], zoom: int, out: str = "area_in_country", rings: str = "rings", box: str = "bbox") -> DataFrame:
    """Share of each tile's planar area that lies in its polygon."""
    shares = tile_grid(polygons, keys, zoom, False, out, rings, box).select(*keys, "tile_x", "tile_y", out)
    return tiles.join(shares, [*keys, "tile_x", "tile_y"], "left").select(*tiles.columns, F.coalesce(out, F.lit(0.0)).alias(out))


def clip_grid(tiles: DataFrame, polygons: DataFrame, keys: list[str], zoom: int, rings: str = "rings", box: str = "bbox") -> DataFrame:
    """Tile geometry cut to the border of its polygon: outer rings, one for each part that it falls into, then holes.

    A tile that its polygon does not touch, or touches in points and lines only, has no rings.
    """
    cut = tile_grid(polygons, keys, zoom, True, "_share", rings, box).select(*keys, "tile_x", "tile_y", "rings")
    none = F.array().cast(G.RINGS_DDL)
    return tiles.join(cut, [*keys, "tile_x", "tile_y"], "left").select(*tiles.columns, F.coalesce("rings", none).alias("rings"))


def tiles_of_boxes(shapes: DataFrame, zoom: int, around: float = 0.0, box: str = "bbox") -> list[str]:
    """Ids of the tiles that some box, grown by ``around`` degrees, may touch: at most 4 ** zoom short texts."""
    side = {n: F.col(f"{box}.{n}") + (around if n.startswith("max") else -around) for n in ("minx", "miny", "maxx", "maxy")}
    x0, y0 = T.tile_holding(side["minx"], side["maxy"], zoom)
    x1, y1 = T.tile_holding(side["maxx"], side["miny"], zoom)
    met = shapes.select(F.explode_outer(F.sequence(x0, x1)).alias("x"), F.sequence(y0, y1).alias("ys")).distinct()
    met = met.select("x", F.explode_outer("ys").alias("y")).where("x is not null and y is not null").distinct()
    return sorted(r.qk for r in met.select(T.quadkey(F.col("x"), F.col("y"), zoom).alias("qk")).collect())


def list_tiles(tiles: DataFrame, targets: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Tile ids to process: given ones, or all, or the first ``limit`` by id."""
    ids = tiles.select("qk").distinct()
    if targets is not None:
        return ids.where(F.col("qk").isin(targets))
    return ids if limit is None else ids.orderBy("qk").limit(limit)


def with_neighbours(tiles: list[str]) -> list[str]:
    """Tile ids and those of the up to eight tiles around each."""
    found = set()
    for qk in tiles:
        x, y = (int("".join(str(int(d) >> bit & 1) for d in qk), 2) for bit in (0, 1))
        for i in (x - 1, x, x + 1):
            for j in (y - 1, y, y + 1):
                if 0 <= min(i, j) and max(i, j) < 1 << len(qk):
                    found.add("".join(str((i >> b & 1) + 2 * (j >> b & 1)) for b in reversed(range(len(qk)))))
    return sorted(found)


def pending(ids: DataFrame, done: DataFrame, keys=("qk",)) -> DataFrame:
    """Units not yet written."""
    return ids.join(done.select(*keys), list(keys), "left_anti")
