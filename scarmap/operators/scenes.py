"""Scenes and orbits: which images take part, and what they show at the labelled points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.cluster import checked_broadcast, join_null_safe, settle
from scarmap.config import BAD_ORBITS, BANDS_S2, CLEAR_THRESHOLD, CLOUD_BAND, MIN_IMAGES_PER_ORBIT, Period
from scarmap.functions.values import in_period, int_list, masked

# Cells per side of the blocks, and rows of a task, in which means of windows around points are taken.
WINDOW_BLOCK, WINDOW_ROWS = 64, 200_000
# Rows of the result that a task makes where values meet many points, and points of a cell that it holds.
RESULT_ROWS, POINTS_HELD = 20_000_000, 100_000
# With so many points a value, or fewer, values are not moved to the points.
FEW_POINTS = 4


def valid_orbits(packed: DataFrame, bad: dict[str, list[int]] = BAD_ORBITS) -> DataFrame:
    """Orbit lists unpacked; listed but unusable orbits are dropped for their area only."""
    orbits = int_list(F.col("valid_orbits"))
    for aoi, numbers in bad.items():
        keep = F.filter(orbits, lambda o: ~o.isin(numbers))
        orbits = F.when(F.col("aoi") == aoi, keep).otherwise(orbits)
    return packed.withColumn("valid_orbits", orbits)


def aoi_orbits(orbits: DataFrame) -> DataFrame:
    """One row per area and valid orbit."""
    return orbits.select("aoi", F.explode("valid_orbits").alias("orbit"))


def overlaps_box(bbox: tuple[float, float, float, float], box: str = "bbox") -> Column:
    """Footprint box touches (minx, miny, maxx, maxy)."""
    minx, miny, maxx, maxy = bbox
    c = lambda n: F.col(f"{box}.{n}")
    return (c("minx") <= maxx) & (c("maxx") >= minx) & (c("miny") <= maxy) & (c("maxy") >= miny)


def select_s1(scenes: DataFrame, period: Period | None = None, orbit: int | None = None, bbox=None) -> DataFrame:
    """Scenes with both polarisations, in wide mode, of the first platform; optional range, orbit and box."""
    pols = F.col("transmitterReceiverPolarisation")
    out = scenes.where(F.array_contains(pols, "VV") & F.array_contains(pols, "VH"))
    out = out.where((F.col("instrumentMode") == "IW") & (F.col("platform_number") == "A"))
    if period is not None:
        out = out.where(in_period(F.col("ts"), period))
    if orbit is not None:
        out = out.where(F.col("orbit") == orbit)
    if bbox is not None:
        out = out.where(overlaps_box(bbox))
    return out


def link_scores(pixels: DataFrame, scores: DataFrame, keys: list[str], band: str = CLOUD_BAND) -> DataFrame:
    """Adds the cloud score of the same scene (and cell); without a partner it is null."""
    return pixels.join(scores.select(*keys, band), keys, "left")


def mask_clouds(df: DataFrame, bands: list[str], band: str = CLOUD_BAND, threshold: float = CLEAR_THRESHOLD) -> DataFrame:
    """Bands are kept where the score reaches the threshold; a missing score masks them too."""
    clear = F.col(band) >= threshold
    return df.withColumns({b: masked(F.col(b), clear) for b in bands})


def select_bands(df: DataFrame, keys: list[str], bands=None, default=BANDS_S2, extra=(CLOUD_BAND,)) -> DataFrame:
    """``None``: the default bands, ``"all"``: every column, a list: those; the score band is added."""
    if bands == "all":
        return df
    return df.select(*keys, *(bands or default), *extra)


def select_s2(pixels, scores, keys, period=None, bbox=None, bands=None, threshold=CLEAR_THRESHOLD, masked_bands=BANDS_S2) -> DataFrame:
    """Range and box filter, score link, cloud mask, band choice."""
    if period is not None:
        pixels = pixels.where(in_period(F.col("ts"), period))
    if bbox is not None:
        pixels = pixels.where(overlaps_box(bbox))
    out = mask_clouds(link_scores(pixels, scores, keys), masked_bands, threshold=threshold)
    return select_bands(out, [*keys, "ts"], bands)


def drop_missing(df: DataFrame, columns=("B1", "B2", "B8")) -> DataFrame:
    return df.dropna(subset=list(columns))


def orbit_counts(scenes: DataFrame, periods: list[Period], keys=("orbit",), minimum: int = MIN_IMAGES_PER_ORBIT) -> DataFrame:
    """Images per orbit and period; orbits with ``minimum`` images in every period are kept."""
    counts = [F.count_if(in_period(F.col("ts"), p)).alias(f"n_{i}") for i, p in enumerate(periods)]
    out = scenes.groupBy(*keys).agg(*counts)
    for i in range(len(periods)):
        out = out.where(F.col(f"n_{i}") >= minimum)
    return out


def on_common_orbits(df: DataFrame, scenes: DataFrame, periods: list[Period], keys=("orbit",), minimum=MIN_IMAGES_PER_ORBIT) -> DataFrame:
    """Rows whose orbit qualifies in all periods."""
    return df.join(orbit_counts(scenes, periods, keys, minimum).select(*keys), list(keys), "left_semi")


def extract_points(pixels: DataFrame, points: DataFrame, point_keys: list[str], scene_keys: list[str], bands: list[str], size: int = 1, finish=lambda c: c) -> DataFrame:
    """Value of every band at every point for every scene; ``size`` 3 takes the mean of the 3x3 cells.

    Points carry their cell ``cx, cy``; pixels that no point needs are left out first. A window's mean is taken once per cell
    and scene and then joined to the cell's points, so what is shuffled does not grow with them; ``finish``, a function of a
    column that rounds or scales the values, works on the means too, not on a row per point. Rows that repeat a point in other
    cells give one mean over all its cells, for which their hits are gathered by point.
    """
    points = points.select(*point_keys, "cx", "cy")
    pixels = pixels.select(*scene_keys, "cx", "cy", *bands)
    if size == 1:
        points = settle(points)
        near = pixels_around(pixels, points)
        rows = near.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_rows"))
        near = near.withColumns({b: finish(F.col(b)) for b in bands})
        return at_cells(near, rows, points, scene_keys).select(*point_keys, *scene_keys, *bands)
    at = F.struct("cx", "cy")
    placed = settle(points.dropna(subset=["cx", "cy"]).groupBy(*point_keys).agg(F.min(at).alias("_at"), F.max(at).alias("_last")))
    one = placed.where("_at = _last").select(*point_keys, "_at.cx", "_at.cy")
    near = pixels_around(pixels, one, size)
    rows = settle(near.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_rows")))
    means = window_means(near, rows.agg(F.sum("_rows")).first()[0] or 0, one, scene_keys, bands, size)
    means = means.withColumns({b: finish(F.col(b)) for b in bands})
    at_most = window_cells(rows, size).groupBy("cx", "cy").agg(F.sum("_rows").alias("_rows"))
    out = at_cells(means, at_most, one, scene_keys).select(*point_keys, *scene_keys, *bands)
    several = placed.where("_at <> _last").select(*point_keys)
    if several.limit(1).count() == 0:
        return out
    near = window_cells(join_null_safe(points, several, point_keys, "left_semi"), size)
    hits = pixels.join(checked_broadcast(near), ["cx", "cy"])
    return out.unionByName(hits.groupBy(*point_keys, *scene_keys).agg(*[finish(F.avg(b)).alias(b) for b in bands]))


def at_cells(values: DataFrame, rows: DataFrame, points: DataFrame, scene_keys: list[str]) -> DataFrame:
    """``values`` of cells, of which there are at most ``rows`` per cell, joined to the points of their cell.

    The result has a row per point and value of a cell. Where that is many rows a value, the result is made cell by cell: each
    value stands beside all points of its cell, and the same points follow each other again with the next value, so its
    columns take little space wherever they are stored. Cells are cut into tiles of about ``RESULT_ROWS`` rows of the result,
    so a task holds at most ``POINTS_HELD`` points of a cell and one crowded cell is shared by many tasks.
    """
    sizes = settle(points.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_points")).join(rows, ["cx", "cy"]))
    made = F.col("_points") * F.col("_rows")
    total, moved = (n or 0 for n in sizes.agg(F.sum(made), F.sum("_rows")).first())
    if total <= max(RESULT_ROWS, FEW_POINTS * moved):
        return values.join(checked_broadcast(points), ["cx", "cy"])
    cuts = {"_shares": F.ceil(made / RESULT_ROWS), "_lists": F.ceil(F.col("_points") / POINTS_HELD)}
    crowded = checked_broadcast(sizes.select("cx", "cy", *[n.cast("int").alias(c) for c, n in cuts.items()]).where("_shares > 1 or _lists > 1"))
    by, tasks = ["cx", "cy", "_share", "_list"], max(-(-total // RESULT_ROWS), values.sparkSession.sparkContext.defaultParallelism)

    def dealt(df: DataFrame, own: str, other: str, keys: list[str]) -> DataFrame:
        df = df.join(crowded, ["cx", "cy"], "left")
        df = df.withColumn(f"_{own}", F.pmod(F.xxhash64(*keys), F.coalesce(f"_{own}s", F.lit(1))).cast("int"))
        df = df.withColumn(f"_{other}", F.explode_outer(F.sequence(F.lit(0), F.coalesce(f"_{other}s", F.lit(1)) - 1)))
        return df.drop(*cuts).repartition(tasks, *by)

    kept = [c for c in points.columns if c not in ("cx", "cy")]
    return dealt(values, "share", "list", scene_keys).join(dealt(points, "list", "share", kept).hint("merge"), by).drop("_share", "_list")


def window_means(halo: DataFrame, rows: int, points: DataFrame, scene_keys: list[str], bands: list[str], size: int) -> DataFrame:
    """(scene_keys, cx, cy, bands): mean of the ``size`` x ``size`` cells around every cell that holds a point, per scene with pixels there.

    ``halo`` are the ``rows`` pixels in these windows. They are shuffled once, by scene and square block with a halo copied from the
    neighbours, to tasks of about ``WINDOW_ROWS`` rows; they meet the cells of their windows inside these tasks.
    """
    cells = points.select("cx", "cy").distinct()
    tasks = max(-(-rows // WINDOW_ROWS), halo.sparkSession.sparkContext.defaultParallelism)
    blocks = {"_bx": "cx", "_by": "cy"}
    for block, axis in blocks.items():
        first, last = (F.floor((F.col(axis) + s) / WINDOW_BLOCK) for s in (-(size // 2), size // 2))
        halo = halo.withColumn(block, F.explode_outer(F.sequence(first, last)))
    moved = window_cells(halo.repartition(tasks, *scene_keys, *blocks), size)
    for block, axis in blocks.items():
        moved = moved.where(F.floor(F.col(axis) / WINDOW_BLOCK) == F.col(block))
    held = moved.join(checked_broadcast(cells), ["cx", "cy"], "left_semi")
    return held.groupBy(*scene_keys, *blocks, "cx", "cy").agg(*[F.avg(b).alias(b) for b in bands]).drop(*blocks)


def window_cells(points: DataFrame, size: int) -> DataFrame:
    """Every point once per cell of the ``size`` x ``size`` window around its cell."""
    if size == 1:
        return points
    offsets = F.sequence(F.lit(-(size // 2)), F.lit(size // 2))
    moved = points.withColumn("_dx", F.explode_outer(offsets)).withColumn("_dy", F.explode_outer(offsets))
    return moved.withColumns({"cx": F.col("cx") + F.col("_dx"), "cy": F.col("cy") + F.col("_dy")}).drop("_dx", "_dy")


def pixels_around(pixels: DataFrame, points: DataFrame, size: int = 1) -> DataFrame:
    """Pixels in the window of some point: what a point series reads of a raster."""
    cells = window_cells(points.select("cx", "cy"), size).distinct()
    return pixels.join(checked_broadcast(cells), ["cx", "cy"], "left_semi")


def points_centre(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Centre of the distinct places."""
    return points.select(lon, lat).distinct().agg(F.avg(lon).alias(lon), F.avg(lat).alias(lat))
