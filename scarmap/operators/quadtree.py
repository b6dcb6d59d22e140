"""Polygons cut into map tiles by a quadtree.

A part of a polygon is what a range of tiles needs of it: the edges whose boxes touch the range, whole, and ``steps``, which stand
for the edges beyond its east side. Such an edge matters by its two end heights alone, with opposite signs, and heights
that neighbouring edges share cancel. A range is cut at the middle of the smallest quadkey cell that holds it, and each
quarter is given its own edges only, so an edge is looked at about once per level however many tiles there are.

A range without edges lies inside or outside as a whole. In a single tile the polygon's area is the integral of its edges
and steps over the tile's height. Its geometry is found by walking: the pieces of edges inside the tile are chained, and the
end of a chain on the tile's border goes on, counter-clockwise along the border, to the next chain's start.

Polygons of a few edges are many, so parts are worked on in blocks: what is found for each edge is found in arrays over the
edges of all parts of a block. Only the walk along a tile's border goes tile by tile.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from scarmap.cluster import spread
from scarmap.functions import geometry as G
from scarmap.functions.tiles import TILE_SIZE

#: a part that travels to a task has at most so many tiles per side and, beyond one tile, so many edges
PART_TILES, PART_EDGES = 8, 1_000
#: edges and points of an Arrow batch
BATCH_VALUES = 50_000

STEPS_DDL = "array<struct<y:double,n:int>>"
_EDGE = pa.struct([(n, pa.float64()) for n in ("x1", "y1", "x2", "y2")])
_STEP = pa.struct([("y", pa.float64()), ("n", pa.int32())])
_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
_RANGE = ("x0", "y0", "x1", "y1")

Box = tuple[float, float, float, float]
Point = tuple[float, float]


class Scheme:
    """Borders of the tiles of one zoom, as ``functions.tiles.tile_box`` has them."""

    def __init__(self, zoom: int):
        self.size = float(TILE_SIZE << zoom)
        self.last = (1 << zoom) - 1

    def _pixel(self, index):
        return min(index * float(TILE_SIZE), self.size - 1) / self.size

    def west(self, x: int) -> float:
        return 360.0 * (self._pixel(x) - 0.5)

    def north(self, y: int) -> float:
        return 90.0 - 360.0 * math.atan(math.exp(-(0.5 - self._pixel(y)) * 2 * math.pi)) / math.pi

    def box(self, x0: int, y0: int, x1: int, y1: int) -> Box:
        """(minx, miny, maxx, maxy) of a range of tiles; y counts from the north."""
        return self.west(x0), self.north(y1 + 1), self.west(x1 + 1), self.north(y0)

    def boxes(self, ranges: np.ndarray) -> np.ndarray:
        """``box`` of each row of n x (x0, y0, x1, y1)."""
        x0, y0, x1, y1 = ranges.T
        return np.column_stack([_each(self.west, x0), _each(self.north, y1 + 1), _each(self.west, x1 + 1), _each(self.north, y0)])

    def _column(self, lon: np.ndarray) -> np.ndarray:
        """Tile columns near longitudes: these or ones close by hold them."""
        return np.clip(np.trunc((lon / 360.0 + 0.5) * (self.last + 1)), 0, self.last).astype(np.int64)

    def _row(self, lat: np.ndarray) -> np.ndarray:
        s = np.sin(np.radians(np.clip(lat, -85.06, 85.06)))
        return np.clip(np.trunc((0.5 - np.log((1 + s) / (1 - s)) / (4 * math.pi)) * (self.last + 1)), 0, self.last).astype(np.int64)

    def _first(self, i: np.ndarray, beyond) -> np.ndarray:
        """The first indexes near ``i`` whose far border is not before a value; ``beyond(j)``: border j is not before it."""
        while (back := (i > 0) & beyond(i)).any():
            i = i - back
        while (on := (i < self.last) & ~beyond(i + 1)).any():
            i = i + on
        return i

    def ranges(self, boxes: np.ndarray) -> np.ndarray:
        """(x0, y0, x1, y1) of all tiles that share a point with each of n x (minx, miny, maxx, maxy)."""
        if np.isnan(boxes).any() or np.isinf(boxes[:, ::2]).any():
            raise ValueError("a polygon has a coordinate that is no number")
        minx, miny, maxx, maxy = boxes.T
        x0 = self._first(self._column(minx), lambda j: _each(self.west, j) >= minx)
        x1 = self._first(self._column(maxx), lambda j: _each(self.west, j) > maxx)
        y0 = self._first(self._row(maxy), lambda j: _each(self.north, j) <= maxy)
        y1 = self._first(self._row(miny), lambda j: _each(self.north, j) < miny)
        return np.column_stack([x0, y0, x1, y1])

    def range(self, minx: float, miny: float, maxx: float, maxy: float) -> tuple[int, int, int, int]:
        """(x0, y0, x1, y1) of all tiles that share a point with a box."""
        return tuple(self.ranges(np.array([[minx, miny, maxx, maxy]], dtype=float))[0].tolist())


def _each(place, indexes: np.ndarray) -> np.ndarray:
    """``place`` of every index, computed once for equal ones."""
    some, at = np.unique(indexes, return_inverse=True)
    return np.array([place(i) for i in some.tolist()], dtype=float)[at]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(sizes)])


def _runs(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, number in ``which``) of all values of the lists ``which``, of lists that begin at ``starts``."""
    sizes = (starts[1:] - starts[:-1])[which]
    own = np.repeat(np.arange(len(which)), sizes)
    return np.arange(len(own)) + (starts[which] - _starts(sizes)[:-1])[own], own


@dataclass(frozen=True)
class Part:
    x0: int
    y0: int
    x1: int
    y1: int
    edges: np.ndarray  # n x (x1, y1, x2, y2)
    heights: np.ndarray  # from here up the winding number of what lies beyond the east side ...
    changes: np.ndarray  # ... changes by this


@dataclass(frozen=True)
class Block:
    """Parts in arrays: the edges and the steps of one part after those of another."""

    rows: np.ndarray  # of each part, the row of the batch that it is a part of
    ranges: np.ndarray  # n x (x0, y0, x1, y1)
    first_edges: np.ndarray  # where each part's edges begin, and their end
    edges: np.ndarray
    first_steps: np.ndarray  # as for edges
    heights: np.ndarray
    changes: np.ndarray

    def __len__(self) -> int:
        return len(self.rows)

    @staticmethod
    def of(part: Part) -> Block:
        ranges = np.array([[getattr(part, n) for n in _RANGE]], dtype=np.int64)
        return Block(np.zeros(1, dtype=np.int64), ranges, _starts([len(part.edges)]), part.edges, _starts([len(part.heights)]), part.heights, part.changes)

    def parts(self) -> Iterator[Part]:
        for r, a, b, c, d in zip(self.ranges.tolist(), self.first_edges, self.first_edges[1:], self.first_steps, self.first_steps[1:], strict=False):
            yield Part(*r, self.edges[a:b], self.heights[c:d], self.changes[c:d])

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first_edges)

    @property
    def widths(self) -> np.ndarray:
        """Tiles along the longer side."""
        return np.maximum(self.ranges[:, 2] - self.ranges[:, 0], self.ranges[:, 3] - self.ranges[:, 1]) + 1

    @property
    def of_edges(self) -> np.ndarray:
        """The part of each edge."""
        return np.repeat(np.arange(len(self)), self.sizes)

    @property
    def of_steps(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first_steps))

    def taken(self, which: np.ndarray) -> Block:
        edges, steps = _runs(self.first_edges, which)[0], _runs(self.first_steps, which)[0]
        first = [_starts(np.diff(f)[which]) for f in (self.first_edges, self.first_steps)]
        return Block(self.rows[which], self.ranges[which], first[0], self.edges[edges], first[1], self.heights[steps], self.changes[steps])

    def pieces(self) -> Iterator[Block]:
        """The same parts in blocks of bounded size."""
        weight = np.cumsum(self.sizes + np.diff(self.first_steps) + 1) // BATCH_VALUES
        for which in np.split(np.arange(len(self)), np.flatnonzero(np.diff(weight)) + 1):
            if len(which):
                yield self if len(which) == len(self) else self.taken(which)

    def narrowed(self, scheme: Scheme, which: np.ndarray, ranges: np.ndarray) -> Block:
        """Parts for ranges inside those of the parts ``which``; parts without any of the polygon are left out."""
        boxes = scheme.boxes(ranges)
        at, of = _runs(self.first_edges, which)
        e, (minx, miny, maxx, maxy) = self.edges[at], boxes[of].T
        beside = (np.maximum(e[:, 1], e[:, 3]) >= miny) & (np.minimum(e[:, 1], e[:, 3]) <= maxy)
        east = np.minimum(e[:, 0], e[:, 2]) > maxx
        near, gone = beside & ~east & (np.maximum(e[:, 0], e[:, 2]) >= minx), beside & east
        steps, of_steps = _runs(self.first_steps, which)
        heights = np.concatenate([self.heights[steps], e[gone, 1], e[gone, 3]])
        ones = np.ones(np.count_nonzero(gone), dtype=np.int64)
        changes = np.concatenate([self.changes[steps], ones, -ones])
        of_steps = np.concatenate([of_steps, of[gone], of[gone]])
        if len(heights):
            # below the range all steps count; above it none does
            heights = np.maximum(heights, boxes[of_steps, 1])
            order = np.lexsort((heights, of_steps))
            heights, of_steps = heights[order], of_steps[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(of_steps) != 0) | (heights[1:] != heights[:-1])]))
            total, heights, of_steps = np.add.reduceat(changes[order], first), heights[first], of_steps[first]
            kept = (total != 0) & (heights <= boxes[of_steps, 3])
            heights, changes, of_steps = heights[kept], total[kept], of_steps[kept]
        n_edges, n_steps = (np.bincount(o, minlength=len(which)) for o in (of[near], of_steps))
        some = n_edges + n_steps > 0
        return Block(self.rows[which][some], ranges[some], _starts(n_edges[some]), e[near], _starts(n_steps[some]), heights, changes)

    def quarters(self, scheme: Scheme) -> Block:
        """The parts in the quarters of the smallest quadkey cell around each range, which has more than one tile."""
        x0, y0, x1, y1 = self.ranges.T
        level = np.frexp(np.maximum(x0 ^ x1, y0 ^ y1).astype(float))[1].astype(np.int64) - 1

        def halves(a: np.ndarray, b: np.ndarray) -> list[tuple]:
            middle = b >> level << level
            cut = a < middle
            return [(a, np.where(cut, middle - 1, b), np.ones(len(a), dtype=bool)), (middle, b, cut)]

        which, ranges = [], []
        for xa, xb, has_x in halves(x0, x1):
            for ya, yb, has_y in halves(y0, y1):
                some = np.flatnonzero(has_x & has_y)
                which.append(some)
                ranges.append(np.column_stack([xa, ya, xb, yb])[some])
        return self.narrowed(scheme, np.concatenate(which), np.concatenate(ranges))


def descend_all(block: Block, scheme: Scheme, enough) -> Iterator[Block]:
    """The parts below those of ``block`` at which ``enough`` holds first; single tiles are not cut."""
    waiting = [*block.pieces()]
    while waiting:
        block = waiting.pop()
        done = (block.widths == 1) | enough(block)
        if done.any():
            yield block if done.all() else block.taken(np.flatnonzero(done))
        if not done.all():
            waiting += block.taken(np.flatnonzero(~done)).quarters(scheme).pieces()


def descend(part: Part, scheme: Scheme, enough) -> Iterator[Part]:
    """``descend_all`` for one part."""
    for block in descend_all(Block.of(part), scheme, lambda b: np.array([bool(enough(p)) for p in b.parts()])):
        yield from block.parts()


def tiles_touched(block: Block, boxes: np.ndarray) -> np.ndarray:
    """For each single tile of ``block``: the polygon and the closed tile share a point."""
    of = block.of_edges
    minx, miny, maxx, maxy = boxes[of].T
    x1, y1, x2, y2 = block.edges.T
    sides = np.stack([(x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) for x in (minx, maxx) for y in (miny, maxy)])
    met = (sides.min(axis=0) <= 0) & (sides.max(axis=0) >= 0)  # boxes of all edges touch the tile
    crossed = ((y1 > miny) != (y2 > miny)) & ((sides[0] > 0) == (y2 > y1))
    below = block.heights <= boxes[block.of_steps, 1]
    turns = np.bincount(of[crossed], minlength=len(block))
    np.add.at(turns, block.of_steps[below], block.changes[below])
    return (np.bincount(of[met], minlength=len(block)) > 0) | (turns % 2 == 1)


def areas_inside(block: Block, boxes: np.ndarray) -> np.ndarray:
    """Area of the polygon inside each single tile: over its height, the integral of the edges' signed, limited distance from its west side."""
    of, of_steps = block.of_edges, block.of_steps
    minx, miny, maxx, maxy = boxes[of].T
    x1, y1, x2, y2 = block.edges.T
    rise = y2 - y1
    lo, hi = np.clip(np.minimum(y1, y2), miny, maxy), np.clip(np.maximum(y1, y2), miny, maxy)
    slope = np.divide(x2 - x1, rise, out=np.zeros_like(rise), where=rise != 0)
    h, d = x1 + slope * (lo - y1), slope * (hi - lo)
    kinks = [np.clip(np.divide(x - h, d, out=np.zeros_like(d), where=d != 0), 0, 1) for x in (minx, maxx)]
    s, t = np.minimum(*kinks), np.maximum(*kinks)
    h0, h1, h2, h3 = (np.clip(v, minx, maxx) - minx for v in (h, h + s * d, h + t * d, h + d))
    own = np.sign(rise) * (hi - lo) * (s * (h0 + h1) + (t - s) * (h1 + h2) + (1 - t) * (h2 + h3)) / 2
    minx, miny, maxx, maxy = boxes.T
    beyond = block.changes * (maxy[of_steps] - np.maximum(block.heights, miny[of_steps]))
    total = np.bincount(of, own, minlength=len(block)) + np.bincount(of_steps, beyond, minlength=len(block)) * (maxx - minx)
    return np.maximum(total, 0.0)


def _inside_pieces(block: Block, boxes: np.ndarray) -> list[list[tuple[int, Point, Point, bool, bool]]]:
    """For each single tile, (edge, start, end, start is the edge's own, end is the edge's own) of what lies inside it; not what runs along its border."""
    of = block.of_edges
    minx, miny, maxx, maxy = boxes[of].T
    x1, y1, x2, y2 = block.edges.T
    first, last = np.zeros(len(of)), np.ones(len(of))
    for a, d, low, high in ((x1, x2 - x1, minx, maxx), (y1, y2 - y1, miny, maxy)):
        with np.errstate(divide="ignore", invalid="ignore"):
            at_low, at_high = (low - a) / d, (high - a) / d
        flat = d == 0  # the boxes touch, so a flat edge is inside this way
        first = np.maximum(first, np.where(flat, 0, np.minimum(at_low, at_high)))
        last = np.minimum(last, np.where(flat, 1, np.maximum(at_low, at_high)))
    i = np.flatnonzero(first < last)
    (ax, ay, bx, by), (minx, miny, maxx, maxy), t0, t1 = block.edges[i].T, boxes[of[i]].T, first[i], last[i]

    def at(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = ax + t * (bx - ax), ay + t * (by - ay)
        gaps = [np.abs(x - minx) / (maxx - minx), np.abs(x - maxx) / (maxx - minx), np.abs(y - miny) / (maxy - miny), np.abs(y - maxy) / (maxy - miny)]
        side = np.argmin(gaps, axis=0)  # on a border, exactly
        x, y = np.clip(x, minx, maxx), np.clip(y, miny, maxy)
        return np.select([side == 0, side == 1], [minx, maxx], x), np.select([side == 2, side == 3], [miny, maxy], y)

    (sx, sy), (ex, ey) = at(t0), at(t1)
    own_start, own_end = t0 == 0, t1 == 1
    sx, sy, ex, ey = np.where(own_start, ax, sx), np.where(own_start, ay, sy), np.where(own_end, bx, ex), np.where(own_end, by, ey)
    along = ((sx == ex) & ((sx == minx) | (sx == maxx))) | ((sy == ey) & ((sy == miny) | (sy == maxy)))
    kept = ((sx != ex) | (sy != ey)) & ~along
    values = [v[kept].tolist() for v in (i, sx, sy, ex, ey, own_start, own_end)]
    pieces = [(i, (a, b), (c, d), s, e) for i, a, b, c, d, s, e in zip(*values, strict=True)]
    cuts = _starts(np.bincount(of[i][kept], minlength=len(block))).tolist()
    return [pieces[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _chains(pieces: list) -> tuple[list[list[Point]], list[list[Point]]]:
    """(closed, open) chains of pieces that follow each other at a common vertex of their ring."""
    begin = defaultdict(list)
    for k, (_, start, _, own, _) in enumerate(pieces):
        if own:
            begin[start].append(k)
    after, led = {}, set()
    for k, (i, _, end, _, own) in enumerate(pieces):
        choices = begin.get(end) if own else None
        if choices:
            # where rings touch, several pieces begin at the vertex: the one of the next edge goes on
            follower = next((c for c in choices if pieces[c][0] == i + 1), choices[0])
            choices.remove(follower)
            after[k] = follower
            led.add(follower)
    closed, loose, seen = [], [], set()
    for k in sorted(range(len(pieces)), key=lambda k: k in led):
        if k in seen:
            continue
        points, at = [pieces[k][1]], k
        while at is not None and at not in seen:
            seen.add(at)
            points.append(pieces[at][2])
            at = after.get(at)
        (closed if at == k else loose).append(points)
    return closed, loose


def _along(point: Point, box: Box) -> float:
    """Place of a point on the tile's border, from its south-west corner counter-clockwise."""
    minx, miny, maxx, maxy = box
    w, h = maxx - minx, maxy - miny
    x, y = point
    far = {0: abs(y - miny) / h, 1: abs(x - maxx) / w, 2: abs(y - maxy) / h, 3: abs(x - minx) / w}
    side = min(far, key=far.get)
    return (x - minx, w + (y - miny), w + h + (maxx - x), 2 * w + h + (maxy - y))[side]


def _walk(loose: list[list[Point]], box: Box) -> list[list[Point]]:
    """Rings made of open chains and the border between the end of one and the start of the next, counter-clockwise."""
    minx, miny, maxx, maxy = box
    w, h = maxx - minx, maxy - miny
    around = 2 * (w + h)
    corners = [(0.0, (minx, miny)), (w, (maxx, miny)), (w + h, (maxx, maxy)), (2 * w + h, (minx, maxy))]
    starts = [_along(c[0], box) % around for c in loose]
    ends = [_along(c[-1], box) % around for c in loose]

    def distance(i: int, j: int) -> float:
        gap = (starts[j] - ends[i]) % around
        if gap == 0:
            # both at one point: they follow each other only where the wedge between them is to the left
            (ax, ay), (bx, by), (cx, cy) = loose[i][-2], loose[i][-1], loose[j][1]
            return 0.0 if (bx - ax) * (cy - by) - (by - ay) * (cx - bx) > 0 else around
        return gap

    left, rings = set(range(len(loose))), []
    while left:
        first = i = min(left)
        ring: list[Point] = []
        while True:
            left.discard(i)
            ring += loose[i]
            j = min([*left, first], key=lambda j: distance(i, j))  # noqa: B023
            gap = distance(i, j)
            turns = sorted(((s - ends[i]) % around or around, p) for s, p in corners)
            ring += [p for s, p in turns if s < gap]
            if j == first:
                break
            i = j
        rings.append(ring)
    return rings


def _closed(points: list[Point]) -> list[Point]:
    out = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
    return out if out[0] == out[-1] else [*out, out[0]]


def _signed(ring: list[Point]) -> float:
    ox, oy = ring[0]
    return sum((ax - ox) * (by - oy) - (bx - ox) * (ay - oy) for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False)) / 2


def _rings_of(pieces: list, box: Box, area: float) -> list[list[Point]]:
    minx, miny, maxx, maxy = box
    whole = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    closed, loose = _chains(pieces)
    rings = [r for r in map(_closed, [*closed, *_walk(loose, box)]) if len(r) > 3]
    sized = [(s, r) for r in rings if (s := _signed(r))]
    # without a chain on the border, all of it belongs to the polygon or nothing of it
    if not loose and area - sum(s for s, _ in sized) > (maxx - minx) * (maxy - miny) / 2:
        sized.append((1.0, whole))
    return [r for s, r in sized if s > 0] + [r for s, r in sized if s < 0]


def rings_of_tiles(block: Block, boxes: np.ndarray, areas: np.ndarray) -> list[list[list[Point]]]:
    """The polygon's geometry in each single tile: outer rings counter-clockwise, then holes clockwise. A ring that falls apart at
    the border becomes several."""
    return [_rings_of(p, box, a) for p, box, a in zip(_inside_pieces(block, boxes), map(tuple, boxes.tolist()), areas.tolist(), strict=True)]


def touches(part: Part, box: Box) -> bool:
    """``tiles_touched`` for one tile."""
    return bool(tiles_touched(Block.of(part), np.array([box]))[0])


def area_inside(part: Part, box: Box) -> float:
    """``areas_inside`` for one tile."""
    return float(areas_inside(Block.of(part), np.array([box]))[0])


def rings_inside(part: Part, box: Box, area: float) -> list[list[Point]]:
    """``rings_of_tiles`` for one tile."""
    return rings_of_tiles(Block.of(part), np.array([box]), np.array([area]))[0]


# ---- on DataFrames


def _lists(column: pa.Array, names: tuple) -> tuple[np.ndarray, list[np.ndarray]]:
    starts = column.offsets.to_numpy().astype(np.int64)
    fields = [column.values.field(n).to_numpy(zero_copy_only=False)[starts[0] : starts[-1]] for n in names]
    return starts - starts[0], fields


def _list_array(starts: np.ndarray, values: pa.Array, absent: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values, mask=None if absent is None else pa.array(absent))


def _batch(batch: pa.RecordBatch, keys: list[str], block: Block, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    """The keys and ranges of ``block``'s parts, of rows of ``batch``, and further columns."""
    named = {k: batch.column(batch.schema.get_field_index(k)).take(pa.array(block.rows)) for k in keys}
    named |= {n: pa.array(block.ranges[:, i], pa.int32()) for i, n in enumerate(_RANGE)} | arrays
    return pa.RecordBatch.from_arrays([*named.values()], names=[*named])


def _part_arrays(block: Block) -> dict[str, pa.Array]:
    edges = pa.StructArray.from_arrays([pa.array(block.edges[:, k]) for k in range(4)], fields=list(_EDGE))
    steps = pa.StructArray.from_arrays([pa.array(block.heights), pa.array(block.changes, pa.int32())], fields=list(_STEP))
    return {"edges": _list_array(block.first_edges, edges), "steps": _list_array(block.first_steps, steps)}


def _shape_array(shapes: list[list[list[Point]] | None]) -> pa.Array:
    rings = [r for s in shapes for r in s or []]
    xy = np.array([p for r in rings for p in r], dtype=float).reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    of_rings = _list_array(_starts([len(r) for r in rings]), points)
    return _list_array(_starts([len(s or []) for s in shapes]), of_rings, np.array([s is None for s in shapes], dtype=bool)).cast(_RINGS)


def polygon_parts(polygons: DataFrame, keys: list[str], zoom: int, rings: str = "rings", tiles: int = PART_TILES, edges: int = PART_EDGES) -> DataFrame:
    """(keys, x0, y0, x1, y1, edges, steps): every polygon in parts of bounded numbers of tiles and edges, spread over tasks.

    A row without rings gives no parts. Rows are spread before they are cut, too: a table of many small polygons can come in few
    partitions.
    """
    held = spread(polygons.select(*keys, F.col(rings).alias("_rings")))
    rows = held.select(*keys, G.edges_of(F.col("_rings")).alias("edges"))
    schema = StructType([
        *[polygons.schema[k] for k in keys], *[StructField(n, IntegerType()) for n in _RANGE],
        StructField("edges", rows.schema["edges"].dataType), StructField("steps", _type_of(polygons, STEPS_DDL)),
    ])

    def enough(block: Block) -> np.ndarray:
        return (block.widths <= tiles) & (block.sizes <= edges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(zoom)
        for batch in batches:
            # not by a filter in front, which Spark would move to the tables that rings are made from, and make them there once more
            batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column(len(keys))), 0), 0))
            if not batch.num_rows:
                continue
            starts, fields = _lists(batch.column(len(keys)), ("x1", "y1", "x2", "y2"))
            flat, first = np.column_stack(fields), starts[:-1]
            lowest, highest = np.minimum.reduceat(flat[:, :2], first), np.maximum.reduceat(flat[:, :2], first)
            lowest, highest = np.minimum(lowest, np.minimum.reduceat(flat[:, 2:], first)), np.maximum(highest, np.maximum.reduceat(flat[:, 2:], first))
            none = np.zeros(batch.num_rows + 1, dtype=np.int64)
            whole = Block(np.arange(batch.num_rows), scheme.ranges(np.hstack([lowest, highest])), starts, flat, none, np.empty(0), np.empty(0, dtype=np.int64))
            for block in descend_all(whole, scheme, enough):
                yield _batch(batch, keys, block, _part_arrays(block))

    return spread(rows.mapInArrow(cut, schema), *keys, "x0", "y0")


def _type_of(df: DataFrame, ddl: str):
    return df.sparkSession.range(0).select(F.lit(None).cast(ddl)).schema[0].dataType


def polygon_tiles(polygons: DataFrame, keys: list[str], zoom: int, clip: bool, rings: str = "rings") -> DataFrame:
    """(keys, x0, y0, x1, y1, area, rings): single tiles that touch a polygon, with the polygon's area in them and, with
    ``clip``, its geometry there; and ranges of tiles wholly inside, whose area and rings are null."""
    parts = polygon_parts(polygons, keys, zoom, rings)
    schema = StructType([
        *[polygons.schema[k] for k in keys], *[StructField(n, IntegerType()) for n in _RANGE],
        StructField("area", DoubleType()), StructField("rings", _type_of(polygons, G.RINGS_DDL)),
    ])

    def tiles_of(block: Block, scheme: Scheme) -> Iterator[tuple[Block, dict[str, pa.Array]]]:
        for found in descend_all(block, scheme, lambda b: b.sizes == 0):
            bare = found.sizes == 0
            inside, crossed = found.taken(np.flatnonzero(bare)), found.taken(np.flatnonzero(~bare))
            if len(inside):
                yield inside, {"area": pa.nulls(len(inside), pa.float64()), "rings": pa.nulls(len(inside), _RINGS)}
            boxes = scheme.boxes(crossed.ranges)
            met = np.flatnonzero(tiles_touched(crossed, boxes))
            if len(met):
                crossed, boxes = crossed.taken(met), boxes[met]
                areas = areas_inside(crossed, boxes)
                shapes = _shape_array(rings_of_tiles(crossed, boxes, areas)) if clip else pa.nulls(len(crossed), _RINGS)
                yield crossed, {"area": pa.array(areas), "rings": shapes}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(zoom)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {n: i for i, n in enumerate(batch.schema.names)}
            starts, fields = _lists(batch.column(at["edges"]), ("x1", "y1", "x2", "y2"))
            steps, (heights, changes) = _lists(batch.column(at["steps"]), ("y", "n"))
            ranges = np.column_stack([batch.column(at[n]).to_numpy(zero_copy_only=False) for n in _RANGE]).astype(np.int64)
            whole = Block(np.arange(batch.num_rows), ranges, starts, np.column_stack(fields), steps, heights, changes.astype(np.int64))
            for block, arrays in tiles_of(whole, scheme):
                yield _batch(batch, keys, block, arrays)

    return parts.mapInArrow(cut, schema)


def each_tile(ranges: DataFrame) -> tuple[DataFrame, Column]:
    """``ranges`` with a row per tile, tile_x and tile_y; and whether a row is a tile wholly inside."""
    rows = ranges
    for name, a, b in (("tile_x", "x0", "x1"), ("tile_y", "y0", "y1")):
        rows = rows.withColumn(name, F.explode_outer(F.sequence(a, b)))
    return rows, F.col("area").isNull()
