"""Operators on long rasters: one row per cell (and scene, orbit or date)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.cluster import checked_broadcast
from scarmap.functions.values import cell, clamp
from scarmap.operators.series import reduce_groups

# Cells per side of the square blocks that are processed together.
BLOCK = 256


@dataclass(frozen=True)
class Grid:
    """Regular grid: cell (0, 0) has its lower left corner at (x0, y0)."""

    x0: float
    y0: float
    dx: float
    dy: float

    def at(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Cell that holds a position."""
        return cell(x, self.x0, self.dx), cell(y, self.y0, self.dy)

    def centre(self, cx: Column, cy: Column) -> tuple[Column, Column]:
        return (cx + 0.5) * self.dx + self.x0, (cy + 0.5) * self.dy + self.y0

    def box(self, cx: Column, cy: Column) -> Column:
        """Pixel square."""
        return F.struct(
            (cx * self.dx + self.x0).alias("minx"),
            (cy * self.dy + self.y0).alias("miny"),
            ((cx + 1) * self.dx + self.x0).alias("maxx"),
            ((cy + 1) * self.dy + self.y0).alias("maxy"),
        )


def morton(cx: Column, cy: Column) -> Column:
    """Place of a cell on a curve that fills squares before it goes on: the bits of both numbers, in turn.

    Numbers are taken from the lowest cell that 31 bits can hold, so negative ones keep their order.
    """

    def apart(v: Column) -> Column:
        v = v.cast("long") + F.lit(1 << 30)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return apart(cx).bitwiseOR(F.shiftleft(apart(cy), 1))


def pixels_in(pixels: DataFrame, minx: float, miny: float, maxx: float, maxy: float, x: str = "x", y: str = "y") -> DataFrame:
    """Part of a raster inside a box, as a range filter the scan can use: on tiles stored along the curve of ``morton``, pages of
    cells are near each other in both directions, and those that the box does not touch are passed over."""
    return pixels.where(F.col(x).between(minx, maxx) & F.col(y).between(miny, maxy))


def focal_mean(pixels: DataFrame, scene_keys: list[str], bands: list[str], radius: int = 1, payload: list[str] = []) -> DataFrame:
    """Mean of the present values in the square neighbourhood of each cell, per scene.

    ``payload`` columns belong to a cell, not to its scene: neighbours may differ in them, and each cell keeps its own.

    Cells are shuffled once, by square block with a halo copied from the neighbours, and sorted in it. Windows of a full block
    are read from an array of summed areas, four numbers each, so the cost does not grow with the radius; windows of thinly
    filled blocks, many blocks at a time, from sums along sorted columns. Cells may be missing; cells that occur twice count
    twice and come out once. Means are doubles.
    """
    kept = pixels.select(*scene_keys, "cx", "cy", *[F.col(b).cast("double").alias(b) for b in bands], *payload)
    halo, names = kept, kept.columns
    for axis, block in (("cx", "_bx"), ("cy", "_by")):
        first, last = (F.floor((F.col(axis) + s) / BLOCK) for s in (-radius, radius))
        halo = halo.withColumn(block, F.explode_outer(F.sequence(first, last)))
    by = [*scene_keys, "_bx", "_by"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks, group in _whole_groups(batches, by):
            own, means = _focal(blocks, group, bands, radius)
            out = blocks.take(pa.array(own))
            yield pa.RecordBatch.from_arrays([means[n] if n in means else out.column(n).combine_chunks() for n in names], names=names)

    return halo.repartition(*by).sortWithinPartitions(*by, "cx", "cy").mapInArrow(run, kept.schema)


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], rows: int = 400_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, number of each row's group) of some whole groups at a time; groups come one after the other."""
    held: list[pa.RecordBatch] = []

    def numbered() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        fresh = np.zeros(table.num_rows, dtype=bool)
        for n in by:
            code = pc.fill_null(table.column(n).combine_chunks().dictionary_encode().indices, -1).to_numpy()
            fresh[1:] |= code[1:] != code[:-1]
        return table, np.cumsum(fresh)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table, group = numbered()
            end = int(np.searchsorted(group, group[-1]))
            if end:
                yield table.slice(0, end), group[:end]
                held = table.slice(end).to_batches()
    if held:
        yield numbered()


def _focal(blocks: pa.Table, group: np.ndarray, bands: list[str], radius: int) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Rows of the cells that lie in their block, each cell once, and the mean of every band there."""
    cx, cy, bx, by = (blocks.column(n).to_numpy().astype(np.int64) for n in ("cx", "cy", "_bx", "_by"))
    wide = BLOCK + 2 * radius
    x, y = cx - bx * BLOCK + radius, cy - by * BLOCK + radius  # 0 .. wide - 1
    place = (group * wide + x) * wide + y  # ascending; a window of a block's own cell does not leave the block's numbers
    inner = (x >= radius) & (x < radius + BLOCK) & (y >= radius) & (y < radius + BLOCK)
    inner[1:] &= place[1:] != place[:-1]
    own = np.flatnonzero(inner)
    amounts = {}
    for b in bands:
        value, there = blocks.column(b).to_numpy(), ~np.asarray(blocks.column(b).combine_chunks().is_null())
        finite = there & np.isfinite(value)
        # differences of sums are taken around the mean, where they are small; a whole number keeps whole numbers exact
        middle = float(np.round(np.where(finite, value, 0.0).sum() / max(int(finite.sum()), 1)))
        counts = [there, finite, *[there & (np.isnan(value) if np.isnan(odd) else value == odd) for odd in ODD]]
        amounts[b] = middle, np.where(finite, value - middle, 0.0), [c.astype(np.int64) for c in counts]
    flat = [a for _, total, counts in amounts.values() for a in (total, *counts)]
    sums = [np.zeros(len(own), dtype=a.dtype) for a in flat]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(starts, append=len(group))
    full = sizes * (2 * radius + 1) > wide * wide
    thin = ~np.repeat(full, sizes)[own]
    at = place[own[thin]]
    found = [(np.searchsorted(place, at + d * wide - radius, "left"), np.searchsorted(place, at + d * wide + radius, "right")) for d in range(-radius, radius + 1)] if len(at) else []
    for a, s in zip(flat, sums, strict=True):
        if found and a.any():
            upto = np.concatenate([a[:1] * 0, np.cumsum(a)])
            s[thin] = sum(upto[last] - upto[first] for first, last in found)
    for start, size in zip(starts[full].tolist(), sizes[full].tolist(), strict=True):
        rows = slice(start, start + size)
        lo, hi = np.searchsorted(own, (start, start + size))
        cells = own[lo:hi]
        for a, s in zip(flat, sums, strict=True):
            if a[rows].any():
                s[lo:hi] = _summed(a[rows], x[rows], y[rows], wide, x[cells], y[cells], radius)
    out, i = {}, 0
    for b, (middle, _, counts) in amounts.items():
        total, n, n_finite, *odd = sums[i : i + 1 + len(counts)]
        i += 1 + len(counts)
        total = total + middle * n_finite
        for amount, n_odd in zip(ODD, odd, strict=True):
            with np.errstate(invalid="ignore"):  # infinities of both signs give NaN, as in any sum
                total = np.where(n_odd > 0, total + amount, total)
        out[b] = pa.array(total / np.maximum(n, 1), mask=n == 0)
    return own, out


#: values that a sum cannot lose again; they are counted apart
ODD = (np.nan, np.inf, -np.inf)


def _summed(amount: np.ndarray, x: np.ndarray, y: np.ndarray, wide: int, at_x: np.ndarray, at_y: np.ndarray, radius: int) -> np.ndarray:
    """Sums over the windows around (at_x, at_y), from an array of the sums over all rectangles from the first corner."""
    total = np.zeros((wide + 1, wide + 1), dtype=amount.dtype)
    np.add.at(total, (x + 1, y + 1), amount)
    total = total.cumsum(axis=0).cumsum(axis=1)
    x0, x1, y0, y1 = at_x - radius, at_x + radius + 1, at_y - radius, at_y + radius + 1
    return total[x1, y1] - total[x0, y1] - total[x1, y0] + total[x0, y0]


def mosaic(tiles: DataFrame, keys: list[str], order: str, value: str = "value", cluster_by: list[str] | None = None) -> DataFrame:
    """One value per cell where tiles overlap: the tile that comes last in ``order`` and has a value wins.

    With ``cluster_by``, a subset of the keys, rows are shuffled on it, and a later join on it does not move them again.
    """
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    rows = tiles if cluster_by is None else tiles.select(*keys, order, value).repartition(*cluster_by)
    return rows.groupBy(*keys).agg(last.alias(value))


def combine_orbits(preds: DataFrame, keys: list[str], how: str = "mean", value: str = "value") -> DataFrame:
    """Predictions of all orbits of a cell to one."""
    if how not in ("mean", "max", "min", "median"):
        raise ValueError(f"unknown aggregation {how}")
    # a cell has a handful of orbits: no group is hot
    return reduce_groups(preds, keys, [value], [how], hot_rows=None).withColumnRenamed(f"{value}_{how}", value)


def nearest_values(
    points: DataFrame, pixels: DataFrame, grid: Grid, extent: tuple[int, int, int, int], keys: list[str],
    x: str = "lon", y: str = "lat", size: int = 1, how: str = "mean", date: str = "post_date", value: str = "value",
    dates: list | None = None, fill=None,
) -> DataFrame:
    """Per point and date: value of the nearest pixel, or mean/max of the ``size`` x ``size`` cells around it.

    Every point is returned. With ``dates`` each point has a row for each of them, with ``fill`` where there is no
    pixel; without, a point that no pixel is near to has one row without date, and ``fill``.

    On a regular grid the nearest pixel is the cell that holds the point, moved to the edge of the
    raster (``extent`` = first and last cell in x, then in y) for points outside. The window is cut at the
    edge. Windows are read once per distinct cell, so many points in one cell cost one window.
    """
    if how not in ("mean", "max"):
        raise ValueError(f"unknown aggregation {how}")
    cx0, cx1, cy0, cy1 = extent
    cx, cy = grid.at(F.col(x), F.col(y))
    located = points.withColumns({
        "_cx": clamp(cx, cx0, cx1),
        "_cy": clamp(cy, cy0, cy1),
    })
    half = size // 2
    offsets = F.sequence(F.lit(-half), F.lit(half))
    wanted = located.select("_cx", "_cy").distinct()
    wanted = wanted.withColumn("_dx", F.explode(offsets)).withColumn("_dy", F.explode(offsets))
    wanted = wanted.select("_cx", "_cy", (F.col("_cx") + F.col("_dx")).alias("cx"), (F.col("_cy") + F.col("_dy")).alias("cy"))
    hits = pixels.select("cx", "cy", date, value).join(checked_broadcast(wanted), ["cx", "cy"])
    agg = {"mean": F.avg, "max": F.max}[how]
    window = hits.groupBy("_cx", "_cy", date).agg(agg(value).alias(value))
    places = located.select(*keys, "_cx", "_cy")
    on = ["_cx", "_cy"]
    if dates is not None:
        kind = pixels.schema[date].dataType
        places = places.withColumn(date, F.explode(F.array(*[F.lit(d).cast(kind) for d in dates])))
        on.append(date)
    filled = F.coalesce(F.col(value), F.lit(fill)) if fill is not None else F.col(value)
    return places.join(window, on, "left").select(*keys, date, filled.alias(value))


def spread_dates(df: DataFrame, keys: list[str], dates: list, date: str, value: str, prefix: str = "pred_", fill=None, agg=F.avg) -> DataFrame:
    """Long to wide, one column per given window start; explicit values, so no extra job."""
    wide = df.groupBy(*keys).pivot(date, dates).agg(agg(value))
    wide = wide.withColumnsRenamed({str(d): f"{prefix}{d}" for d in dates})
    return wide if fill is None else wide.fillna(fill, [f"{prefix}{d}" for d in dates])


def gather_dates(df: DataFrame, keys: list[str], dates: list, value: str = "value", date: str = "post_date", prefix: str = "pred_") -> DataFrame:
    """Wide to long; the prefix is removed. Missing values give no row."""
    long = df.unpivot(keys, [f"{prefix}{d}" for d in dates], "_name", value)
    return long.where(F.col(value).isNotNull()).select(*keys, F.expr(f"substr(_name, {len(prefix) + 1})").alias(date), value)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
