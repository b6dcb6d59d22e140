"""Planar and spheroidal geometry on arrays of directed edges.

A polygon is ``rings: array<array<struct<x,y>>>``: closed rings, outer ones counter-clockwise and
holes clockwise, parts of a multipolygon one after the other. Every measure below is a sum over the
directed edges of all rings, so holes and parts need no special case.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
METRES_PER_DEGREE = SEMI_MAJOR * math.pi / 180

RINGS_DDL = "array<array<struct<x:double,y:double>>>"
EDGES_DDL = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _edge(x1, y1, x2, y2) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def edges_of(rings: Column) -> Column:
    """Directed edges of all rings."""

    def of_ring(r: Column) -> Column:
        n = F.size(r) - 1
        pair = lambda a, b: _edge(a["x"], a["y"], b["x"], b["y"])
        return F.zip_with(F.slice(r, F.lit(1), n), F.slice(r, F.lit(2), n), pair)

    return F.flatten(F.transform(rings, of_ring))


def box_rings(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Axis-parallel rectangle as rings."""
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    return F.array(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners]))


def bounds_of(rings: Column) -> Column:
    """struct(minx, miny, maxx, maxy)."""
    xs = F.transform(F.flatten(rings), lambda p: p["x"])
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    )


def _total(edges: Column, term) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def _from_first(edges: Column) -> Column:
    """Edges relative to the first vertex: keeps the products small."""
    ox, oy = edges[0]["x1"], edges[0]["y1"]
    return F.transform(edges, lambda e: _edge(e["x1"] - ox, e["y1"] - oy, e["x2"] - ox, e["y2"] - oy))


def _cross(e: Column) -> Column:
    return e["x1"] * e["y2"] - e["x2"] * e["y1"]


def area(edges: Column) -> Column:
    """Planar area in the squared unit of the coordinates."""
    return let(edges, lambda e: F.abs(_total(_from_first(e), _cross)) / 2)


def centroid(edges: Column) -> Column:
    """struct(x, y): centre of gravity."""
    return let(edges, _centroid)


def _centroid(edges: Column) -> Column:
    rel = _from_first(edges)
    zero = F.lit(0.0)
    sums = F.aggregate(
        rel,
        F.struct(zero.alias("a"), zero.alias("x"), zero.alias("y")),
        lambda s, e: F.struct(
            (s["a"] + _cross(e)).alias("a"),
            (s["x"] + (e["x1"] + e["x2"]) * _cross(e)).alias("x"),
            (s["y"] + (e["y1"] + e["y2"]) * _cross(e)).alias("y"),
        ),
        lambda s: F.struct(
            F.try_divide(s["x"], 3 * s["a"]).alias("x"), F.try_divide(s["y"], 3 * s["a"]).alias("y")
        ),
    )
    return F.struct((sums["x"] + edges[0]["x1"]).alias("x"), (sums["y"] + edges[0]["y1"]).alias("y"))


def _authalic_y(lat: Column) -> Column:
    """Northing of the equal-area cylindrical projection of the ellipsoid, metres."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = math.sqrt(e2)
    s = F.sin(lat * F.lit(math.pi / 180))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    return SEMI_MAJOR / 2 * q


def area_spheroid(edges: Column) -> Column:
    """Area in square metres of a lon/lat polygon on the ellipsoid."""
    scaled = F.transform(
        edges,
        lambda e: _edge(
            e["x1"] * METRES_PER_DEGREE,
            _authalic_y(e["y1"]),
            e["x2"] * METRES_PER_DEGREE,
            _authalic_y(e["y2"]),
        ),
    )
    return area(scaled)


def _side(e: Column, x: Column, y: Column) -> Column:
    """Signed area of edge and point: zero on the line through the edge."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _between(v: Column, a: Column, b: Column) -> Column:
    return (v >= F.least(a, b)) & (v <= F.greatest(a, b))


def contains(edges: Column, x: Column, y: Column, flips: Column | None = None) -> Column:
    """Point strictly inside, by counting the edges to the right; boundary points are outside.

    ``flips`` are the heights at which edges left out of ``edges`` start or end being counted (see
    ``operators.cover``).
    """

    def crossed(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & ((_side(e, x, y) > 0) == (e["y2"] > e["y1"]))

    def touched(e: Column) -> Column:
        return (_side(e, x, y) == 0) & _between(x, e["x1"], e["x2"]) & _between(y, e["y1"], e["y2"])

    n = F.size(F.filter(edges, crossed))
    if flips is not None:
        n = n + F.size(F.filter(flips, lambda f: f > y))
    return (n % 2 == 1) & ~F.exists(edges, touched)


def clip_area(edges: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Area of the polygon inside an axis-parallel rectangle, without building the clipped polygon.

    For each x the polygon covers, between ``miny`` and ``maxy``, the signed sum of its edge heights
    limited to that range. So the area is the sum over edges of the integral of the limited height,
    which is piecewise linear with at most two kinks.
    """
    zero = F.lit(0.0)

    def limited(h: Column) -> Column:
        return F.least(F.greatest(h, miny), maxy) - miny

    def span(e: Column) -> Column:
        lo = F.least(F.greatest(F.least(e["x1"], e["x2"]), minx), maxx)
        hi = F.least(F.greatest(F.greatest(e["x1"], e["x2"]), minx), maxx)
        slope = F.coalesce(F.try_divide(e["y2"] - e["y1"], e["x2"] - e["x1"]), zero)
        return F.struct(
            F.when(e["x2"] > e["x1"], lo - hi).otherwise(hi - lo).alias("w"),
            (e["y1"] + slope * (lo - e["x1"])).alias("h"),
            (slope * (hi - lo)).alias("d"),
        )

    def kinks(s: Column) -> Column:
        at = [F.least(F.greatest(F.coalesce(F.try_divide(b - s["h"], s["d"]), zero), zero), F.lit(1.0)) for b in (miny, maxy)]
        return F.struct(
            s["w"].alias("w"), s["h"].alias("h"), s["d"].alias("d"),
            F.least(*at).alias("s"), F.greatest(*at).alias("t"),
        )

    def heights(k: Column) -> Column:
        return F.struct(
            k["w"].alias("w"), k["s"].alias("s"), k["t"].alias("t"),
            limited(k["h"]).alias("h0"),
            limited(k["h"] + k["s"] * k["d"]).alias("h1"),
            limited(k["h"] + k["t"] * k["d"]).alias("h2"),
            limited(k["h"] + k["d"]).alias("h3"),
        )

    def integral(v: Column) -> Column:
        s, t = v["s"], v["t"]
        doubled = s * (v["h0"] + v["h1"]) + (t - s) * (v["h1"] + v["h2"]) + (1 - t) * (v["h2"] + v["h3"])
        return v["w"] * doubled / 2

    parts = F.transform(F.transform(F.transform(edges, span), kinks), heights)
    return F.greatest(_total(parts, integral), zero)


def local_metres(lon: Column, lat: Column, lon0: Column, lat0: Column) -> tuple[Column, Column]:
    """Offset of a position from (lon0, lat0) in metres; for distances of some metres only."""
    scale = F.lit(METRES_PER_DEGREE)
    return (lon - lon0) * scale * F.cos(F.radians(lat0)), (lat - lat0) * scale


def within_metres(edges: Column, lon: Column, lat: Column, metres: float) -> Column:
    """Point inside the polygon or at most ``metres`` from an edge."""

    def squared(e: Column) -> Column:
        ax, ay = local_metres(e["x1"], e["y1"], lon, lat)
        bx, by = local_metres(e["x2"], e["y2"], lon, lat)
        return F.struct(ax.alias("ax"), ay.alias("ay"), (bx - ax).alias("dx"), (by - ay).alias("dy"))

    def distance(s: Column) -> Column:
        along = F.coalesce(
            F.try_divide(-(s["ax"] * s["dx"] + s["ay"] * s["dy"]), s["dx"] * s["dx"] + s["dy"] * s["dy"]), F.lit(0.0)
        )
        t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
        px, py = s["ax"] + t * s["dx"], s["ay"] + t * s["dy"]
        return px * px + py * py

    near = F.exists(F.transform(edges, squared), lambda s: distance(s) <= metres * metres)
    return contains(edges, lon, lat) | near


def segments_meet(a: Column, b: Column) -> Column:
    """Two edges have a point in common."""
    a_first, a_second = _side(b, a["x1"], a["y1"]), _side(b, a["x2"], a["y2"])
    b_first, b_second = _side(a, b["x1"], b["y1"]), _side(a, b["x2"], b["y2"])
    boxes = (
        (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
        & (F.greatest(b["x1"], b["x2"]) >= F.least(a["x1"], a["x2"]))
        & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
        & (F.greatest(b["y1"], b["y2"]) >= F.least(a["y1"], a["y2"]))
    )
    return boxes & (F.signum(a_first) * F.signum(a_second) <= 0) & (F.signum(b_first) * F.signum(b_second) <= 0)


def meets_box(edges: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Polygon and axis-parallel rectangle share a point.

    An edge meets the rectangle if the boxes overlap and the corners are not all on one side of it;
    if no edge does, the polygon holds the whole rectangle or nothing of it.
    """

    def edge_meets(e: Column) -> Column:
        boxes = (
            (F.greatest(e["x1"], e["x2"]) >= minx) & (F.least(e["x1"], e["x2"]) <= maxx)
            & (F.greatest(e["y1"], e["y2"]) >= miny) & (F.least(e["y1"], e["y2"]) <= maxy)
        )
        sides = [_side(e, x, y) for x in (minx, maxx) for y in (miny, maxy)]
        return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(edges, edge_meets) | contains(edges, minx, miny)


def intersects(a: Column, b: Column) -> Column:
    """Two polygons share a point: edges meet, or one holds a vertex of the other."""
    meet = F.exists(a, lambda e: F.exists(b, lambda f: segments_meet(e, f)))
    inside = F.exists(a, lambda e: contains(b, e["x1"], e["y1"])) | F.exists(b, lambda f: contains(a, f["x1"], f["y1"]))
    return meet | inside


def signed_area(ring: Column) -> Column:
    """Positive for counter-clockwise rings."""
    return let(edges_of(F.array(ring)), lambda e: _total(_from_first(e), _cross) / 2)


def oriented(part: Column) -> Column:
    """Rings of one polygon with the outer one counter-clockwise and the holes clockwise."""

    def turn(ring: Column, i: Column) -> Column:
        return F.when((signed_area(ring) < 0) == (i == 0), F.reverse(ring)).otherwise(ring)

    return F.transform(part, turn)
