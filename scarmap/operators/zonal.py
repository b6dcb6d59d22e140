"""Pixel values onto buildings by overlap area."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from scarmap.cluster import checked_broadcast, spread, tasks_of
from scarmap.operators.cover import box_cells
from scarmap.operators.raster import Grid, spread_dates

# Cells per side of the block that is one unit of work for a large polygon.
OVERLAP_BLOCK = 64
# (cell, edge) pairs that are held in arrays at a time.
MAX_PAIRS = 500_000
# A cell counts as overlapped from this share of its area on; less is rounding.
TOUCHED = 1e-9


def _block_grid(grid: Grid) -> Grid:
    return Grid(grid.x0, grid.y0, grid.dx * OVERLAP_BLOCK, grid.dy * OVERLAP_BLOCK)


def pixel_overlaps(buildings: DataFrame, keys: list[str], grid: Grid, edges: str = "edges", box: str = "bbox") -> DataFrame:
    """(keys, cx, cy, overlap_area) of every pixel square a building overlaps, from the grid alone.

    Pixel rows are not needed: the squares follow from the grid. Buildings that span more than one
    block of cells, if there are any, are cut into blocks and spread over tasks first.
    """
    blocks = _block_grid(grid)
    bxs, bys = box_cells(box, blocks)
    rows = buildings.select(*keys, F.col(edges).alias("_edges"), F.col(box).alias("_box"))
    many = F.size(bxs) * F.size(bys) > 4
    if buildings.select(many.alias("m")).where("m").limit(1).count() == 0:
        return _overlaps(rows, keys, grid)

    flagged = buildings.select(*keys, F.col(edges).alias("_edges"), F.col(box).alias("_box"), bxs.alias("_bx"), bys.alias("_by"))
    is_large = F.size("_bx") * F.size("_by") > 4
    small = flagged.where(~is_large).select(*keys, "_edges", "_box")
    large = flagged.where(is_large).select(*keys, "_edges", "_box", F.explode_outer("_bx").alias("_bx"), "_by")
    large = large.select(*keys, "_edges", "_box", "_bx", F.explode_outer("_by").alias("_by"))
    b = blocks.box(F.col("_bx"), F.col("_by"))
    # an edge beside the block has no part in it
    beside = F.filter("_edges", lambda e: (F.greatest(e["x1"], e["x2"]) > b["minx"]) & (F.least(e["x1"], e["x2"]) < b["maxx"]))
    # cut to the inside of the block, so no cell is met twice
    low = [F.greatest(F.col(f"_box.min{a}"), b[f"min{a}"] + d / 2) for a, d in (("x", grid.dx), ("y", grid.dy))]
    high = [F.least(F.col(f"_box.max{a}"), b[f"max{a}"] - d / 2) for a, d in (("x", grid.dx), ("y", grid.dy))]
    cut = F.struct(
        F.least(low[0], high[0]).alias("minx"), F.least(low[1], high[1]).alias("miny"),
        F.greatest(low[0], high[0]).alias("maxx"), F.greatest(low[1], high[1]).alias("maxy"),
    )
    pieces = spread(large, *keys, "_bx", "_by").select(*keys, beside.alias("_edges"), cut.alias("_box"))
    return _overlaps(small, keys, grid).unionByName(_overlaps(pieces.where(F.size("_edges") > 0), keys, grid))


def _overlaps(rows: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Areas of all (polygon, cell) pairs of a batch at once, in arrays; no shuffle."""
    c = lambda n: F.col(f"_box.{n}")
    first, last = grid.at(c("minx"), c("miny")), grid.at(c("maxx"), c("maxy"))
    ranged = rows.select(*keys, "_edges", first[0].alias("_x0"), last[0].alias("_x1"), first[1].alias("_y0"), last[1].alias("_y1"))
    schema = StructType([
        *[rows.schema[k] for k in keys],
        StructField("cx", IntegerType()), StructField("cy", IntegerType()), StructField("overlap_area", DoubleType()),
    ])
    least = TOUCHED * grid.dx * grid.dy

    def areas(batches):
        for batch in batches:
            column = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731, B023
            edges = column("_edges")
            flat = np.column_stack([f.to_numpy(zero_copy_only=False) for f in edges.values.flatten()])
            starts = edges.offsets.to_numpy().astype("i8")
            x0, x1, y0, y1 = (column(n).to_numpy().astype("i8") for n in ("_x0", "_x1", "_y0", "_y1"))
            high = y1 - y0 + 1
            # one entry per cell: its polygon, and its place in the polygon's range
            ends = np.cumsum((x1 - x0 + 1) * high)
            for lo, hi in _slices(ends, np.diff(starts)):
                cell = np.arange(lo, hi)
                row = np.searchsorted(ends, cell, side="right")
                place = cell - np.where(row > 0, ends[row - 1], 0)
                cx, cy = x0[row] + place // high[row], y0[row] + place % high[row]
                area = _cell_areas(flat, starts, row, grid, cx, cy)
                kept = np.flatnonzero(area > least)
                taken = [column(k).take(pa.array(row[kept])) for k in keys]
                out = [pa.array(cx[kept], pa.int32()), pa.array(cy[kept], pa.int32()), pa.array(area[kept])]
                yield pa.RecordBatch.from_arrays([*taken, *out], names=[*keys, "cx", "cy", "overlap_area"])

    return ranged.mapInArrow(areas, schema)


def _slices(ends: np.ndarray, edges: np.ndarray):
    """Ranges of cells with a bounded number of (cell, edge) pairs, over all polygons of a batch."""
    total = int(ends[-1]) if len(ends) else 0
    lo = 0
    while lo < total:
        row = int(np.searchsorted(ends, lo, side="right"))
        hi, pairs = lo, 0
        while row < len(ends):
            room = max((MAX_PAIRS - pairs) // max(int(edges[row]), 1), 0)
            take = min(int(ends[row]) - hi, room)
            hi, pairs = hi + take, pairs + take * int(edges[row])
            if hi < ends[row]:
                break
            row += 1
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def _cell_areas(flat, starts, row, grid: Grid, cx, cy) -> np.ndarray:
    """Area of polygon ``row[i]`` in cell ``(cx[i], cy[i])``: the sum of ``functions.geometry.clip_area`` in arrays."""
    count = starts[row + 1] - starts[row]
    pair_cell = np.repeat(np.arange(len(row)), count)
    before = np.cumsum(count) - count
    ax, ay, bx, by = flat[starts[row][pair_cell] + np.arange(len(pair_cell)) - before[pair_cell]].T
    x0, y0 = (grid.x0 + cx * grid.dx)[pair_cell], (grid.y0 + cy * grid.dy)[pair_cell]
    x1, y1 = (grid.x0 + (cx + 1) * grid.dx)[pair_cell], (grid.y0 + (cy + 1) * grid.dy)[pair_cell]
    lo, hi = np.clip(np.minimum(ax, bx), x0, x1), np.clip(np.maximum(ax, bx), x0, x1)
    run = bx - ax
    slope = np.divide(by - ay, run, out=np.zeros_like(run), where=run != 0)
    h, d = ay + slope * (lo - ax), slope * (hi - lo)
    kinks = [np.clip(np.divide(y - h, d, out=np.zeros_like(d), where=d != 0), 0, 1) for y in (y0, y1)]
    s, t = np.minimum(*kinks), np.maximum(*kinks)
    h0, h1, h2, h3 = (np.clip(v, y0, y1) - y0 for v in (h, h + s * d, h + t * d, h + d))
    part = np.sign(-run) * (hi - lo) * (s * (h0 + h1) + (t - s) * (h1 + h2) + (1 - t) * (h2 + h3)) / 2
    return np.bincount(pair_cell, part, minlength=len(row))


def pixels_near(pixels: DataFrame, buildings: DataFrame, grid: Grid, box: str = "bbox") -> DataFrame:
    """Pixels in the blocks of cells that some building's box touches.

    The blocks are a short list of pairs of numbers beside the raster; measured to be small, they are sent to the scan of the
    pixels, so that what lies far from buildings is not shuffled.
    """
    xs, ys = box_cells(box, grid)
    ends = lambda cells: F.sequence(_block(cells[0]), _block(F.element_at(cells, -1)))
    met = buildings.select(F.explode_outer(ends(xs)).alias("_bx"), ends(ys).alias("_ys"))
    met = met.select("_bx", F.explode_outer("_ys").alias("_by")).distinct()
    blocked = pixels.withColumns({"_bx": _block(F.col("cx")), "_by": _block(F.col("cy"))})
    return blocked.join(checked_broadcast(met), ["_bx", "_by"], "left_semi").select(*pixels.columns)


def _block(cell: Column) -> Column:
    return F.floor(cell / OVERLAP_BLOCK).cast("int")


def overlap_tasks(buildings: DataFrame, grid: Grid, box: str = "bbox") -> int:
    """Tasks for the pixels under buildings: by the number of squares in all boxes, which bounds the overlaps from above."""
    xs, ys = box_cells(box, grid)
    return tasks_of(buildings.sparkSession, buildings.agg(F.sum(F.size(xs).cast("long") * F.size(ys))).first()[0])


def pixels_x_buildings(
    buildings: DataFrame, pixels: DataFrame, grid: Grid, keys=("building_id",), date: str = "post_date", value: str = "value",
    edges: str = "edges", box: str = "bbox",
) -> DataFrame:
    """(building, cell, date, value, overlap_area): one equi-join on the cell, in tasks of a bounded number of overlaps."""
    tasks = overlap_tasks(buildings, grid, box)
    parts = pixel_overlaps(buildings, list(keys), grid, edges, box).repartition(tasks, "cx", "cy")
    return parts.join(pixels.select("cx", "cy", date, value).repartition(tasks, "cx", "cy"), ["cx", "cy"])


def zonal_measures(overlap: DataFrame, keys=("building_id",), date: str = "post_date", value: str = "value") -> DataFrame:
    """Overlap-weighted mean and maximum per building and date, in one pass of partial aggregates."""
    w = F.col("overlap_area")
    return overlap.groupBy(*keys, date).agg(
        F.try_divide(F.sum(F.col(value) * w), F.sum(w)).alias("weighted_mean"), F.max(value).alias("max")
    )


def sorted_measures(measures: DataFrame, keys=("building_id",), date: str = "post_date") -> DataFrame:
    """Measures by building and date, as a report lists them."""
    return measures.orderBy(*keys, date)


def attach_zonal(buildings: DataFrame, measures: DataFrame, keys=("building_id",)) -> DataFrame:
    """Measures of every date onto buildings; buildings without pixels keep nulls."""
    return buildings.join(measures, list(keys), "left")


def zonal_stats(buildings: DataFrame, pixels: DataFrame, grid: Grid, keys=("building_id",), **names) -> DataFrame:
    """Overlap, measures and left join for all regions at once."""
    measures = zonal_measures(pixels_x_buildings(buildings, pixels, grid, keys, **names), keys)
    return attach_zonal(buildings, measures, keys)


def wide_means(overlap: DataFrame, dates: list, keys=("building_id",), date: str = "post_date", value: str = "value", prefix: str = "pred_") -> DataFrame:
    """Weighted mean per building, one column per date: one shuffle of partial sums, already in the wide form."""
    w = F.col("overlap_area")
    columns = []
    for d in dates:
        on = F.col(date) == F.lit(d)
        columns.append(F.try_divide(F.sum(F.when(on, F.col(value) * w)), F.sum(F.when(on, w))).alias(f"{prefix}{d}"))
    return overlap.groupBy(*keys).agg(*columns)


def collect_preds(buildings: DataFrame, measures: DataFrame, dates: list, prefix: str = "pred_") -> DataFrame:
    """Weighted means, one column per window start, left-joined to all buildings."""
    wide = spread_dates(measures, ["building_id"], dates, "post_date", "weighted_mean", prefix)
    return buildings.join(wide, "building_id", "left")
