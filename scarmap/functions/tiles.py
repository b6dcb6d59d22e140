"""Web-Mercator tile arithmetic and UTM zone codes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from scarmap.functions.values import clamp

# Fixed values of the tile scheme.
TILE_SIZE = 256
LAT_LIMIT = 85.05112878
LON_LIMIT = 180.0


def _map_size(zoom: int) -> float:
    return float(TILE_SIZE << zoom)


def pixel_of(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Global pixel position: half a pixel is added, then the map edge limits it."""
    size = _map_size(zoom)
    sin_lat = F.sin(clamp(lat, -LAT_LIMIT, LAT_LIMIT) * F.lit(math.pi / 180))
    u = (clamp(lon, -LON_LIMIT, LON_LIMIT) + 180.0) / 360.0
    v = F.lit(0.5) - F.ln((1 + sin_lat) / (1 - sin_lat)) / F.lit(4 * math.pi)
    return tuple(clamp(t * size + 0.5, 0.0, size - 1) for t in (u, v))


def tile_of_pixel(px: Column, py: Column) -> tuple[Column, Column]:
    return tuple(F.floor(p / float(TILE_SIZE)).cast("int") for p in (px, py))


def tile_of(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    return tile_of_pixel(*pixel_of(lon, lat, zoom))


def tile_holding(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """The tile whose box holds a position, without the half pixel of ``tile_of``."""
    n = float(1 << zoom)
    sin_lat = F.sin(clamp(lat, -LAT_LIMIT, LAT_LIMIT) * F.lit(math.pi / 180))
    u = (clamp(lon, -LON_LIMIT, LON_LIMIT) + 180.0) / 360.0
    v = F.lit(0.5) - F.ln((1 + sin_lat) / (1 - sin_lat)) / F.lit(4 * math.pi)
    return tuple(clamp(F.floor(t * n), 0, (1 << zoom) - 1).cast("int") for t in (u, v))


def quadkey(tile_x: Column, tile_y: Column, zoom: int) -> Column:
    """One base-4 digit per level, the most significant first."""

    def bit(v: Column, level: int) -> Column:
        return F.shiftright(v, level).bitwiseAND(F.lit(1))

    digits = [(bit(tile_x, z) + 2 * bit(tile_y, z)).cast("string") for z in reversed(range(zoom))]
    return F.concat(*digits)


def position_of_pixel(px: Column, py: Column, zoom: int) -> tuple[Column, Column]:
    """Global pixel to (lon, lat)."""
    size = _map_size(zoom)
    u = clamp(px, 0.0, size - 1) / size - 0.5
    v = F.lit(0.5) - clamp(py, 0.0, size - 1) / size
    return 360.0 * u, 90.0 - 360.0 * F.atan(F.exp(-v * 2 * math.pi)) / math.pi


def tile_box(tile_x: Column, tile_y: Column, zoom: int) -> Column:
    """struct(minx, miny, maxx, maxy) in degrees; the last tile's far edge is one pixel short."""
    west, north = position_of_pixel(tile_x * float(TILE_SIZE), tile_y * float(TILE_SIZE), zoom)
    east, south = position_of_pixel((tile_x + 1) * float(TILE_SIZE), (tile_y + 1) * float(TILE_SIZE), zoom)
    return F.struct(
        F.least(west, east).alias("minx"),
        F.least(north, south).alias("miny"),
        F.greatest(west, east).alias("maxx"),
        F.greatest(north, south).alias("maxy"),
    )


def utm_code(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone, zone padded to two digits."""
    zone = (F.floor(F.pmod((lon + 180.0) / 6.0, F.lit(60.0))) + 1).cast("string")
    return F.concat(F.when(lat > 0, "EPSG:326").otherwise("EPSG:327"), F.lpad(zone, 2, "0"))
