"""Spatial joins as equi-joins on grid cells.

A polygon is cut into pieces, one per grid cell it may touch. A piece is either ``full`` (the whole
cell is inside) or holds what a point-in-polygon count needs in that cell: the original edges near
it, and ``flips``. An edge wholly to the right of the cell is crossed by every ray of its height, so
only its two end heights matter, and heights shared by neighbouring edges cancel. The answer is the
same as counting all edges of the polygon, with a few edges per cell.

Cell ranges are made with ``explode_outer``: for ``explode`` Spark adds a filter that repeats the whole
expression behind the range below it. Ranges are never empty, and a null one joins nothing.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from scarmap.cluster import MAX_BROADCAST_BYTES, checked_broadcast, join_null_safe, row_bytes, settle, spread
from scarmap.functions import geometry as G
from scarmap.functions.values import clamp
from scarmap.operators import cells as K
from scarmap.operators.raster import Grid

# Cells per side of the block that is one unit of work when a polygon is cut.
COVER_BLOCK = 32
# Cell sizes, each four times the one before, for polygons of any size near points.
LEVELS = 4
# Points near polygons are sent to the polygons up to this size; beyond it both are shuffled.
FEW_POINTS_BYTES = 8 << 20
# Pieces per cell that are kept as an array in a lookup row.
MAX_PIECES = 1_000

# Columns of a cover beside the polygon keys.
PIECE = ("cx", "cy", "full", "edges", "flips")

_NO_FLIPS = np.empty(0)
_EDGE = pa.struct([(n, pa.float64()) for n in ("x1", "y1", "x2", "y2")])


def _slack(origin: float, step: float) -> float:
    return 1e-9 * step + 1e-12 * abs(origin)


def _pieces_of_block(edges: np.ndarray, grid: Grid, bx: int, by: int):
    """(cx, cy, full, edges, flips) of the cells of one block that the polygon may touch."""
    lox, hix = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    loy, hiy = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    # a point on a cell border may be put into either cell by rounding
    sx, sy = _slack(grid.x0, grid.dx), _slack(grid.y0, grid.dy)
    columns = np.arange(bx * COVER_BLOCK, (bx + 1) * COVER_BLOCK)
    x0, x1 = grid.x0 + columns * grid.dx - sx, grid.x0 + (columns + 1) * grid.dx + sx
    for cy in range(by * COVER_BLOCK, (by + 1) * COVER_BLOCK):
        y0, y1 = grid.y0 + cy * grid.dy - sy, grid.y0 + (cy + 1) * grid.dy + sy
        row = (hiy >= y0) & (loy <= y1)
        if not row.any():
            continue
        e, left, right = edges[row], lox[row, None], hix[row, None]
        near, beyond = (right >= x0) & (left <= x1), left > x1
        touched = near.any(axis=0)
        middle = (y0 + y1) / 2
        crossed = (e[:, 1] > middle) != (e[:, 3] > middle)
        full = ~touched & (np.count_nonzero(beyond & crossed[:, None], axis=0) % 2 == 1)
        for k in np.flatnonzero(touched | full):
            if full[k]:
                yield columns[k], cy, True, e[:0], _NO_FLIPS
                continue
            heights, times = np.unique(e[beyond[:, k]][:, [1, 3]], return_counts=True)
            yield columns[k], cy, False, e[near[:, k]], heights[(times % 2 == 1) & (heights > y0)]


def cell_cover(polygons: DataFrame, keys: list[str], grid: Grid, edges: str = "edges", box: str = "bbox", whole: int = 0) -> DataFrame:
    """``keys, cx, cy, full, edges, flips``: the pieces of every polygon.

    Large polygons are spread over tasks by block, each block with the edges of its rows only. With ``whole``, polygons of up to so
    many edges are not cut but are their own piece in every cell of their box, and a column ``first`` has the lowest of these cells.
    """
    if whole:
        few = K.plain(F.col(edges), whole)
        shapes = polygons.select(*keys, F.col(edges).alias("edges"), F.col(box).alias("_box"), few.alias("_few"))
        shapes = settle(shapes.repartition(4 * polygons.sparkSession.sparkContext.defaultParallelism, *keys))
        cut = cell_cover(shapes.where("not _few"), keys, grid, "edges", "_box")
        return whole_pieces(shapes.where("_few"), keys, grid).unionByName(cut, allowMissingColumns=True)
    c = lambda n: F.col(f"{box}.{n}")
    (ax, ay), (bx, by) = grid.at(c("minx"), c("miny")), grid.at(c("maxx"), c("maxy"))
    blocks = polygons.select(*keys, F.col(edges).alias("edges"), box)
    for name, a, b in (("_bx", ax, bx), ("_by", ay, by)):
        span = F.sequence(F.floor(a / COVER_BLOCK).cast("int"), F.floor(b / COVER_BLOCK).cast("int"))
        blocks = blocks.withColumn(name, F.explode_outer(span))
    low = F.col("_by") * (COVER_BLOCK * grid.dy) + grid.y0
    west = F.col("_bx") * (COVER_BLOCK * grid.dx) + grid.x0
    slack = 2 * max(_slack(grid.x0, grid.dx), _slack(grid.y0, grid.dy))
    useful = F.filter(
        "edges",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= low - slack)
        & (F.least(e["y1"], e["y2"]) <= low + COVER_BLOCK * grid.dy + slack)
        & (F.greatest(e["x1"], e["x2"]) >= west - slack),
    )
    blocks = blocks.select(*keys, "_bx", "_by", useful.alias("edges")).where(F.size("edges") > 0)
    schema = StructType([
        *[polygons.schema[k] for k in keys],
        StructField("cx", IntegerType()),
        StructField("cy", IntegerType()),
        StructField("full", BooleanType()),
        StructField("edges", ArrayType(StructType([StructField(n, DoubleType()) for n in ("x1", "y1", "x2", "y2")]))),
        StructField("flips", ArrayType(DoubleType())),
    ])

    def cut(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("edges"))
            starts = column.offsets.to_numpy()
            flat = np.column_stack([f.to_numpy(zero_copy_only=False) for f in column.values.flatten()])
            corner = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("_bx", "_by")]
            for i in range(batch.num_rows):
                found = list(_pieces_of_block(flat[starts[i] : starts[i + 1]], grid, corner[0][i], corner[1][i]))
                if found:
                    yield _to_batch(batch, i, keys, found)

    return spread(blocks, *keys, "_bx", "_by").mapInArrow(cut, schema)


def whole_pieces(shapes: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """A cover of polygons (``edges``, ``_box``) that are their own piece in every cell of their box, with its lowest cell as ``first``."""
    xs, ys = box_cells("_box", grid)
    lowest = F.struct(*[F.element_at(n, 1).alias(a) for n, a in (("_xs", "cx"), ("_ys", "cy"))])
    ranges = shapes.withColumns({"_xs": xs, "_ys": ys}).withColumn("first", lowest)
    each = ranges.withColumn("cx", F.explode_outer("_xs")).drop("_xs").withColumn("cy", F.explode_outer("_ys")).drop("_ys")
    return each.select(*keys, "cx", "cy", F.lit(False).alias("full"), "edges", F.array().cast("array<double>").alias("flips"), "first")


def _to_batch(batch: pa.RecordBatch, i: int, keys: list[str], found: list) -> pa.RecordBatch:
    cx, cy, full, edges, flips = zip(*found)
    ends = lambda arrays: pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    stacked = np.concatenate(edges)
    edge_values = pa.StructArray.from_arrays([pa.array(stacked[:, k]) for k in range(4)], fields=list(_EDGE))
    columns = [batch.column(batch.schema.get_field_index(k)).take(pa.array([i] * len(found))) for k in keys]
    columns += [pa.array(cx, pa.int32()), pa.array(cy, pa.int32()), pa.array(full, pa.bool_())]
    columns += [pa.ListArray.from_arrays(ends(edges), edge_values), pa.ListArray.from_arrays(ends(flips), pa.array(np.concatenate(flips)))]
    return pa.RecordBatch.from_arrays(columns, names=[*keys, "cx", "cy", "full", "edges", "flips"])


def holds(piece, x: Column, y: Column) -> Column:
    """The piece's polygon holds a point of the piece's cell."""
    return piece["full"] | G.contains(piece["edges"], x, y, piece["flips"])


def points_in_polygons(points: DataFrame, cover: DataFrame, grid: Grid, x: str = "lon", y: str = "lat") -> DataFrame:
    """One row per (point, polygon that holds it); point columns and the key columns of the cover."""
    cx, cy = grid.at(F.col(x), F.col(y))
    located = points.withColumns({"cx": cx, "cy": cy})
    keys = [c for c in cover.columns if c not in PIECE]
    pieces = checked_broadcast(cover)
    piece = {n: F.col(n) for n in ("full", "edges", "flips")}
    return located.join(pieces, ["cx", "cy"]).where(holds(piece, F.col(x), F.col(y))).select(*points.columns, *keys)


def locate(
    points: DataFrame, cover: DataFrame, grid: Grid, point_keys: list[str], order: str, x: str = "lon", y: str = "lat",
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Every point once, with the key columns of the polygon that holds it, or nulls.

    If several hold it, the one with the greatest ``order``, then the greatest key columns, is taken. Points are not shuffled while
    the pieces are small enough to broadcast. Where more than ``max_pieces`` pieces meet in a
    cell, matches are joined one by one and reduced per point (``point_keys``) instead.
    """
    cover = settle(cover)
    keys = [c for c in cover.columns if c not in (*PIECE, order)]
    size = cover.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(cover)).alias("w"))
    widest, weight = size.agg(F.max("n"), F.sum("w")).first()
    if (widest or 0) > max_pieces:
        best = points_in_polygons(points.select(*point_keys, x, y), cover, grid, x, y)
        best = best.groupBy(*point_keys).agg(F.max_by(F.struct(*keys), F.struct(order, *keys)).alias("_best"))
        return points.join(best, point_keys, "left").select(*points.columns, *[F.col(f"_best.{k}").alias(k) for k in keys])

    piece = F.struct(F.col(order).alias("_order"), F.struct(*keys).alias("_keys"), "full", "edges", "flips")
    cells = cover.groupBy("cx", "cy").agg(F.collect_list(piece).alias("_pieces"))
    cells = F.broadcast(cells) if (weight or 0) <= MAX_BROADCAST_BYTES else cells.hint("merge")
    cx, cy = grid.at(F.col(x), F.col(y))
    joined = points.withColumns({"cx": cx, "cy": cy}).join(cells, ["cx", "cy"], "left")
    hits = F.filter("_pieces", lambda p: holds(p, F.col(x), F.col(y)))
    found = F.array_max(F.transform(hits, lambda p: F.struct(p["_order"], p["_keys"])))
    # array_max of an empty or missing array is null
    return joined.withColumn("_best", found).select(*points.columns, *[F.col(f"_best._keys.{k}").alias(k) for k in keys])


def box_cells(box: str, grid: Grid) -> tuple[Column, Column]:
    """Cell ranges (arrays in x and in y) covered by a bounding box."""
    c = lambda n: F.col(f"{box}.{n}")
    a, b = grid.at(c("minx"), c("miny")), grid.at(c("maxx"), c("maxy"))
    return F.sequence(a[0], b[0]), F.sequence(a[1], b[1])


# Pairs of edges that are tested at a time; so many are tested without a search.
EDGE_PAIRS, FEW_PAIRS = 1_000_000, 4_096
# A polygon of so many edges is not cut, and pieces with so few pairs of edges are compared by column expressions.
FEW_EDGES, FEW_MEETINGS = 16, 64


def _segments_meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``functions.geometry.segments_meet`` of edges row by row."""

    def side(e, x, y):
        return (e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (x - e[:, 0]) * (e[:, 3] - e[:, 1])

    def overlap(i, j):
        return (np.maximum(a[:, i], a[:, j]) >= np.minimum(b[:, i], b[:, j])) & (np.maximum(b[:, i], b[:, j]) >= np.minimum(a[:, i], a[:, j]))

    apart = np.sign(side(b, a[:, 0], a[:, 1])) * np.sign(side(b, a[:, 2], a[:, 3])) > 0
    beside = np.sign(side(a, b[:, 0], b[:, 1])) * np.sign(side(a, b[:, 2], b[:, 3])) > 0
    return overlap(0, 2) & overlap(1, 3) & ~apart & ~beside


def near_pairs(a: np.ndarray, b: np.ndarray):
    """(rows of ``a``, rows of ``b``), some at a time: all pairs of edges whose extents along x overlap, and few others.

    Edges of ``b`` are sorted by their start, apart by length: those that reach an edge of ``a`` start at most the greatest length
    of their class before it.
    """
    if len(a) * len(b) <= FEW_PAIRS:
        yield np.repeat(np.arange(len(a)), len(b)), np.tile(np.arange(len(b)), len(a))
        return
    low, high = np.minimum(a[:, 0], a[:, 2]), np.maximum(a[:, 0], a[:, 2])
    start, length = np.minimum(b[:, 0], b[:, 2]), np.abs(b[:, 2] - b[:, 0])
    sized = np.frexp(length)[1]
    for kind in np.unique(sized):
        own = np.flatnonzero(sized == kind)
        own = own[np.argsort(start[own])]
        first = np.searchsorted(start[own], low - length[own].max(), "left")
        count = np.searchsorted(start[own], high, "right") - first
        ends = np.cumsum(count)
        lo = 0
        while lo < len(a):
            hi = max(int(np.searchsorted(ends, ends[lo] - count[lo] + EDGE_PAIRS, "right")), lo + 1)
            n = count[lo:hi]
            left = np.repeat(np.arange(lo, hi), n)
            yield left, own[np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[lo:hi], n)]
            lo = hi


def _runs_start(edges: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """One vertex of every run of vertices that follow each other inside a cell."""
    follows = np.zeros(len(edges), dtype=bool)
    follows[1:] = (edges[1:, :2] == edges[:-1, 2:]).all(axis=1) & inside[:-1]
    return edges[inside & ~follows, :2]


def _any_held(points: np.ndarray, edges: np.ndarray, flips: np.ndarray) -> bool:
    """Some point lies inside a piece; points on its edges are for others to find."""
    for x, y in points:
        x1, y1, x2, y2 = edges.T
        side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        crossed = ((y1 > y) != (y2 > y)) & ((side > 0) == (y2 > y1))
        if (np.count_nonzero(crossed) + np.count_nonzero(flips > y)) % 2 == 1:
            return True
    return False


def pieces_meet(grid: Grid, cx: int, cy: int, a: np.ndarray, a_flips: np.ndarray, b: np.ndarray, b_flips: np.ndarray) -> bool:
    """Two pieces of one cell show that their polygons share a point: edges meet, or one holds a vertex that the other has here.

    As long as no edges meet, vertices that follow each other inside the cell lie on one side, so one of them is enough.
    """
    if any(_segments_meet(a[i], b[j]).any() for i, j in near_pairs(a, b)):
        return True

    def starts(e: np.ndarray) -> np.ndarray:
        return _runs_start(e, (np.floor((e[:, 0] - grid.x0) / grid.dx) == cx) & (np.floor((e[:, 1] - grid.y0) / grid.dy) == cy))

    return _any_held(starts(a), b, b_flips) or _any_held(starts(b), a, a_flips)


def polygons_meeting(left: DataFrame, left_keys: list[str], cover: DataFrame, grid: Grid, edges: str = "edges", box: str = "bbox") -> DataFrame:
    """Distinct (left keys, cover keys) of polygons that share a point.

    Both sides are cut into pieces of cells, and pieces meet by cell, so what is compared in a cell are the edges near it. If
    a cell lies wholly inside one polygon, any vertex of the other there is enough; where both have edges, the
    edges are swept along x unless they are few. On the left, a polygon of few edges is its own piece in every cell of its box.
    If the cover has such polygons too (``whole`` in ``cell_cover``), a pair of them is compared in one cell only, in blocks of
    arrays, and needs no deduplication; polygons that repeat their keys go the way of pieces.
    """
    keys = [c for c in cover.columns if c not in (*PIECE, "first")]
    shapes = left.select(*left_keys, F.col(edges).alias("edges"), F.col(box).alias("_box"))
    few = F.size("edges") <= FEW_EDGES
    if "first" not in cover.columns:
        own = whole_pieces(shapes.where(few), left_keys, grid).drop("first")
        return _pieces_meeting(own.unionByName(cell_cover(shapes.where(~few), left_keys, grid, "edges", "_box")), left_keys, cover, keys, grid).distinct()
    own = cell_cover(shapes, left_keys, grid, "edges", "_box", FEW_EDGES)
    sides = [[side, names] for side, names in ((own, left_keys), (cover, keys))]
    cut = [settle(side.where("first is null").drop("first")) for side, _ in sides]
    whole = [side.where("first is not null") for side, _ in sides]
    for k, (_, names) in enumerate(sides):
        polygons = whole[k].where("cx = first.cx and cy = first.cy").select(*names).unionAll(cut[k].select(*names).distinct())
        repeated = settle(polygons.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
        if repeated.limit(1).count():
            cut[k] = cut[k].unionByName(join_null_safe(whole[k], repeated, names, "left_semi").drop("first"))
            whole[k] = join_null_safe(whole[k], repeated, names, "left_anti")
    once = _whole_meeting(*whole, left_keys, keys)
    some = [side.limit(1).count() > 0 for side in cut]
    rest = [_pieces_meeting(cut[0], left_keys, cover.drop("first"), keys, grid)] if some[0] else []
    rest += [_pieces_meeting(whole[0].drop("first"), left_keys, cut[1], keys, grid)] if some[1] else []
    return once.unionByName(reduce(DataFrame.unionByName, rest).distinct()) if rest else once


def _whole_meeting(left: DataFrame, right: DataFrame, left_keys: list[str], keys: list[str]) -> DataFrame:
    """(left keys, keys) of whole polygons that share a point, each pair of rows once: in the lowest cell that both boxes have."""
    kept = lambda df, names: df.select("cx", "cy", *names, "edges", F.col("first.cx").alias("_fx"), F.col("first.cy").alias("_fy"))

    def test(at, a, b):
        p, q = K.Polygons(a.field("edges")), K.Polygons(b.field("edges"))
        firsts = [(a.numbers(n), b.numbers(n)) for n in ("_fx", "_fy")]
        (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = p.bounds(), q.bounds()

        def may(k, s, t):
            here = [np.maximum.outer(f[s], g[t]) == at[n][k] for n, (f, g) in enumerate(firsts)]
            beside = np.less_equal.outer(ax0[s], bx1[t]) & np.greater_equal.outer(ax1[s], bx0[t])
            return here[0] & here[1] & beside & np.less_equal.outer(ay0[s], by1[t]) & np.greater_equal.outer(ay1[s], by0[t])

        for i, j in K.candidates(a, b, may):
            met = K.meet(p, i, q, j, _segments_meet)
            yield i[met], j[met]

    return K.pairs_by_cell(kept(left, left_keys), kept(right, keys), ["cx", "cy"], left_keys, keys, test)


def _pieces_meeting(own: DataFrame, left_keys: list[str], cover: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """(left keys, keys) of pieces that meet in a cell, a pair as often as there are such cells."""
    names = {c: f"_{c}" for c in ("full", "edges", "flips")}
    own = settle(own)
    joined = own.withColumnsRenamed(names).join(checked_broadcast(cover), ["cx", "cy"])

    def here(e: Column) -> Column:
        x, y = grid.at(e["x1"], e["y1"])
        return (x == F.col("cx")) & (y == F.col("cy"))

    def held(vertices: str, holder: str, flips: str) -> Column:
        return F.exists(vertices, lambda e: here(e) & G.contains(F.col(holder), e["x1"], e["y1"], F.col(flips)))

    crossing = F.exists("_edges", lambda a: F.exists("edges", lambda b: G.segments_meet(a, b)))
    known = (
        F.when(F.col("full") & F.col("_full"), True)
        .when(F.col("_full"), F.exists("edges", here)).when(F.col("full"), F.exists("_edges", here))
        .when(F.size("_edges") * F.size("edges") <= FEW_MEETINGS, crossing | held("_edges", "edges", "flips") | held("edges", "_edges", "_flips"))
    )
    certain = joined.where(known).select(*left_keys, *keys)
    columns = [*left_keys, *keys]
    many = ~F.col("full") & ~F.col("_full") & (F.size("_edges") * F.size("edges") > FEW_MEETINGS)
    open_ = joined.where(many).select(*columns, "cx", "cy", "_edges", "_flips", "edges", "flips")

    def sweep(batches):
        for batch in batches:
            at = len(columns)
            cells = zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist(), strict=True)
            sides = []
            for e, f in ((batch.column(at + 2), batch.column(at + 3)), (batch.column(at + 4), batch.column(at + 5))):
                flat = np.column_stack([c.to_numpy(zero_copy_only=False) for c in e.values.flatten()])
                sides.append((e.offsets.to_numpy(), flat, f.offsets.to_numpy(), f.values.to_numpy(zero_copy_only=False)))
            met = []
            for i, (cx, cy) in enumerate(cells):
                pieces = [v for o, e, p, f in sides for v in (e[o[i] : o[i + 1]], f[p[i] : p[i + 1]])]
                if pieces_meet(grid, cx, cy, *pieces):
                    met.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(met, pa.int64())) for k in range(at)], names=columns)

    swept = open_.mapInArrow(sweep, certain.schema)
    return certain.unionByName(swept)


def points_near_polygons(
    points: DataFrame, polygons: DataFrame, polygon_keys: list[str], grid: Grid, metres: float,
    x: str = "lon", y: str = "lat", edges: str = "edges", box: str = "bbox",
) -> DataFrame:
    """(point columns, polygon keys) of points in a polygon or at most ``metres`` from it.

    A polygon's box is filed under a few cells of the level that suits its size grown by the distance; cells of one level are
    4 x 4 of the level below. A point lies in one cell of each level. So each pair is met once, no polygon has many cells,
    and no buffer polygon is built. Few points are sent to the boxes, and edges are fetched for the pairs that are left. Many
    points meet boxes and edges in one join by cell, so pairs are neither written nor shuffled; polygons of few edges and points come
    as lists there and are tested in blocks of arrays. Polygons that repeat their keys, whose every box counts with every shape of
    the same keys, take the first way.
    """
    points, polygons = settle(points), polygons.select(*polygon_keys, F.col(edges).alias("_edges"), F.col(box).alias("_shape_box"))
    weight = _weight(points)
    if weight > FEW_POINTS_BYTES:
        polygons = settle(polygons.repartition(4 * points.sparkSession.sparkContext.defaultParallelism, *polygon_keys))
    boxes, levels, inside = _boxes_by_cell(polygons.withColumnRenamed("_shape_box", "_box"), grid, metres, x, y)
    located = _at_levels(points, levels, grid, x, y)
    others = [k for k in polygon_keys if k not in points.columns]
    within = G.within_metres(F.col("_edges"), F.col(x), F.col(y), metres)

    def by_pairs(boxes: DataFrame, shapes: DataFrame, located: DataFrame) -> DataFrame:
        cells = spread(_each_cell(boxes.drop("_edges")), *polygon_keys)
        pairs = checked_broadcast(cells.join(located, ["_level", "cx", "cy"]).where(inside).select(*points.columns, *others))
        near = shapes.select(*polygon_keys, "_edges").join(pairs, polygon_keys).where(within)
        return near.select(*points.columns, *others)

    if weight * len(levels) <= FEW_POINTS_BYTES:
        return by_pairs(boxes, polygons, F.broadcast(located))
    located = located.hint("merge")
    repeated = settle(polygons.groupBy(*polygon_keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    again = repeated.limit(1).count() > 0
    single = boxes.join(repeated, polygon_keys, "left_anti") if again else boxes
    single = single.dropna(subset=polygon_keys).withColumn("_few", K.plain(F.col("_edges"), FEW_EDGES))
    near = _near_in_arrays(points, single.where("_few"), levels, grid, metres, x, y, others)
    large = single.where("not _few").drop("_few")
    if large.limit(1).count():
        near = near.unionByName(_each_cell(large).join(located, ["_level", "cx", "cy"]).where(inside & within).select(*points.columns, *others))
    if not again:
        return near
    boxes, polygons = (df.join(repeated, polygon_keys, "left_semi") for df in (boxes, polygons))
    return near.unionByName(by_pairs(boxes, polygons, located))


def _near_in_arrays(points: DataFrame, boxes: DataFrame, levels: list[int], grid: Grid, metres: float, x: str, y: str, others: list[str]) -> DataFrame:
    """(point columns, polygon keys) of points near polygons of few edges, tested in blocks of arrays."""
    bounds = ("minx", "miny", "maxx", "maxy")
    filed = _each_cell(boxes).select("_level", "cx", "cy", *others, "_edges", *[F.col(f"_box.{n}").alias(f"_{n}") for n in bounds])

    def test(at, a, b):
        px, py, shapes = a.numbers(x), a.numbers(y), K.Polygons(b.field("_edges"))
        minx, miny, maxx, maxy = (b.numbers(f"_{n}") for n in bounds)

        def may(k, s, t):
            beside = np.greater_equal.outer(px[s], minx[t]) & np.less_equal.outer(px[s], maxx[t])
            return beside & np.greater_equal.outer(py[s], miny[t]) & np.less_equal.outer(py[s], maxy[t])

        for i, j in K.candidates(a, b, may):
            met = K.held(shapes, j, px[i], py[i])
            rest = np.flatnonzero(~met)
            met[rest] = K.near(shapes, j[rest], px[i[rest]], py[i[rest]], metres)
            yield i[met], j[met]

    return K.pairs_by_cell(_at_levels(points, levels, grid, x, y), filed, ["_level", "cx", "cy"], points.columns, others, test)


def first_points_near(
    points: DataFrame, polygons: DataFrame, polygon_keys: list[str], grid: Grid, metres: float, order: list[str],
    x: str = "lon", y: str = "lat", edges: str = "edges", box: str = "bbox",
) -> DataFrame:
    """(point columns, polygon keys): of the points in a polygon or at most ``metres`` from it, the first by ``order`` and some others.

    Keys that points have too must be equal. Boxes and points meet by cell as in ``points_near_polygons``, but the points of a
    cell lie in arrays of about ``MAX_PIECES``, and the first one of an array that is near ends the search in it. So pairs
    are no rows, and what is shuffled grows with points and polygons alone.
    """
    points, polygons = settle(points), polygons.select(*polygon_keys, F.col(edges).alias("_edges"), F.col(box).alias("_box"))
    boxes, levels, _ = _boxes_by_cell(polygons, grid, metres, x, y)
    shared = [k for k in polygon_keys if k in points.columns]
    on = ["_level", "cx", "cy", *shared]
    located = _at_levels(points, levels, grid, x, y)
    crowded = settle(located.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / MAX_PIECES).alias("_parts")).where("_parts > 1"))
    part = F.lit(0)
    if crowded.limit(1).count():
        located = located.join(checked_broadcast(crowded), on, "left")
        part = F.pmod(F.xxhash64(x, y), F.coalesce("_parts", F.lit(1))).cast("int")
    rest = [c for c in points.columns if c not in (*order, *shared)]
    listed = located.select(*on, part.alias("_part"), F.struct(*order, *rest).alias("_point")).repartition(*on)
    listed = listed.groupBy(*on, "_part").agg(F.sort_array(F.collect_list("_point")).alias("_points")).drop("_part")
    few = _weight(points) * len(levels) <= FEW_POINTS_BYTES
    found = _each_cell(boxes).join(F.broadcast(listed) if few else listed.hint("merge"), on)
    c = lambda n: F.col(f"_box.{n}")

    def near(p: Column) -> Column:
        inside = p[x].between(c("minx"), c("maxx")) & p[y].between(c("miny"), c("maxy"))
        return inside & G.within_metres(F.col("_edges"), p[x], p[y], metres)

    kind = listed.schema["_points"].dataType.elementType.simpleString()
    first = F.aggregate("_points", F.lit(None).cast(kind), lambda done, p: F.when(done.isNotNull(), done).when(near(p), p))
    found = found.select(*polygon_keys, first.alias("_point")).where("_point is not null")
    others = [k for k in polygon_keys if k not in points.columns]
    return found.select(*[F.col(n) if n in shared else F.col(f"_point.{n}").alias(n) for n in points.columns], *others)


def _boxes_by_cell(polygons: DataFrame, grid: Grid, metres: float, x: str, y: str) -> tuple[DataFrame, list[int], Column]:
    """``polygons`` with ``_box`` grown by the distance, its level and ranges of cells; the levels in use; whether a box holds a point."""
    up = metres / G.METRES_PER_DEGREE * 1.01
    side = F.lit(up) / F.cos(F.radians(F.greatest(F.abs(F.col("_box.miny")), F.abs(F.col("_box.maxy")))))
    grown = F.struct(
        (F.col("_box.minx") - side).alias("minx"), (F.col("_box.miny") - up).alias("miny"),
        (F.col("_box.maxx") + side).alias("maxx"), (F.col("_box.maxy") + up).alias("maxy"),
    )
    c = lambda n: F.col(f"_box.{n}")
    span = F.greatest((c("maxx") - c("minx")) / grid.dx, (c("maxy") - c("miny")) / grid.dy)
    level = clamp(F.ceil(F.log(4.0, F.greatest(span / 2, F.lit(1.0)))).cast("int"), 0, LEVELS - 1)
    low, high = grid.at(c("minx"), c("miny")), grid.at(c("maxx"), c("maxy"))
    rows = polygons.withColumn("_box", grown).withColumn("_level", level).withColumns({
        f"_{n}": F.sequence(_coarser(a), _coarser(b)) for n, a, b in (("xs", low[0], high[0]), ("ys", low[1], high[1]))
    })
    levels = sorted(r[0] for r in rows.select("_level").distinct().collect() if r[0] is not None)
    return rows, levels or [0], F.col(x).between(c("minx"), c("maxx")) & F.col(y).between(c("miny"), c("maxy"))


def _each_cell(boxes: DataFrame) -> DataFrame:
    """A row per cell of a box's ranges."""
    return boxes.withColumn("cx", F.explode_outer("_xs")).drop("_xs").withColumn("cy", F.explode_outer("_ys")).drop("_ys")


def _at_levels(points: DataFrame, levels: list[int], grid: Grid, x: str, y: str) -> DataFrame:
    """Every point with its cell at each level."""
    cx, cy = grid.at(F.col(x), F.col(y))
    located = points.withColumns({"cx": cx, "cy": cy, "_level": F.explode(F.array(*[F.lit(n) for n in levels]))})
    return located.withColumns({c: _coarser(F.col(c)) for c in ("cx", "cy")})


def _weight(df: DataFrame) -> int:
    """Measured bytes of settled rows."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def _coarser(index: Column) -> Column:
    """Cell index at the row's level."""
    return F.floor(index / F.pow(F.lit(4.0), F.col("_level"))).cast("int")
