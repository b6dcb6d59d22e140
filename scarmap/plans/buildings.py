"""Buildings: country filter, damage labels, regions, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.cluster import settle
from scarmap.config import NEAR_METRES
from scarmap.operators import cover as C
from scarmap.operators import labels as L
from scarmap.operators import raster as R
from scarmap.operators import regions as A
from scarmap.operators import zonal as Z
from scarmap.operators.raster import Grid
from scarmap.operators.tiles import tiles_of_boxes
from scarmap.plans.stages import Stages
from scarmap.sources.readers import project_buildings

# Degrees. Cells of some kilometres for regions, of a kilometre for areas of interest, and of some
# ten metres for points near buildings, so that few points and buildings meet in one cell.
REGION_GRID = Grid(-180.0, -90.0, 0.05, 0.05)
AOI_GRID = Grid(-180.0, -90.0, 0.01, 0.01)
NEAR_GRID = Grid(-180.0, -90.0, 0.0005, 0.0005)


def within_country(buildings: DataFrame, country: DataFrame, grid: Grid = REGION_GRID) -> DataFrame:
    """Buildings whose centroid is in the country; each once, whatever the number of parts."""
    tagged = country.withColumn("_in", F.lit(1)).withColumn("_order", F.lit(1))
    cover = C.cell_cover(tagged.select("_in", "_order", "edges", "bbox"), ["_in", "_order"], grid)
    return C.locate(buildings, cover, grid, ["building_id"], "_order").where("_in = 1").drop("_in")


def buildings_in_aoi(buildings: DataFrame, aois: DataFrame, grid: Grid = AOI_GRID) -> DataFrame:
    """(building_id, aoi) pairs whose polygons share a point."""
    return C.polygons_meeting(buildings, ["building_id"], C.cell_cover(aois, ["aoi"], grid, whole=C.FEW_EDGES), grid)


def labels_near_buildings(points, buildings, metres: float = NEAR_METRES, grid: Grid = NEAR_GRID) -> DataFrame:
    """Label columns and the id of every building within reach."""
    return C.points_near_polygons(points, buildings, ["building_id"], grid, metres)


def worst_labels(buildings: DataFrame, labels: DataFrame, aois: DataFrame, aoi_grid: Grid = AOI_GRID) -> DataFrame:
    """Worst label within reach, of an area the building meets, for every building that has one.

    Labels at one place are reduced to the worst before the spatial join. Buildings meet the areas first, then only labels of
    these areas, of which the worst within reach is looked for in every cell: pairs of buildings and labels are no rows.
    """
    row = F.struct("damage", "unosat_id", "date")
    places = labels.groupBy("aoi", "lon", "lat").agg(F.min_by(row, F.struct("damage", "unosat_id")).alias("_l"))
    shapes = buildings.select("building_id", "edges", "bbox")
    found = settle(shapes.join(buildings_in_aoi(shapes, aois, aoi_grid), "building_id"))
    places = places.select("aoi", "lon", "lat", "_l.*")
    near = C.first_points_near(places, found, ["building_id", "aoi"], NEAR_GRID, NEAR_METRES, ["damage", "unosat_id"])
    return L.worst_label_per_building(near)


def add_damage_labels(buildings: DataFrame, labels: DataFrame, aois: DataFrame, aoi_grid: Grid = AOI_GRID) -> DataFrame:
    """``buildings`` with their worst labels; buildings without one keep nulls."""
    return L.add_label_info(buildings, worst_labels(buildings, labels, aois, aoi_grid))


ADMIN_COLUMNS = ["ADM1_EN", "ADM2_EN", "ADM3_EN", "adm1_id", "adm2_id", "adm3_id"]


def assign_admin(buildings: DataFrame, admin: DataFrame, grid: Grid = REGION_GRID, order: str = "row_id") -> DataFrame:
    """Names and ids of the region that holds the centroid; null where none does."""
    cover = C.cell_cover(admin, [*ADMIN_COLUMNS, order], grid)
    return C.locate(buildings, cover, grid, ["building_id"], order)


def enrich_buildings(raw, country, labels, aois, adm1, adm2, adm3, order: str = "row_id", aoi_grid: Grid = AOI_GRID, folder: str | None = None) -> DataFrame:
    """Normalised raw buildings to the table the statistics use.

    Raw buildings are projected, measured and tested against the country once: the spatial joins behind read the table that
    this leaves, and of it the columns they need. With ``folder`` a rerun goes on from the stages found there.
    """
    stages = Stages(raw.sparkSession, folder)
    inside = stages.table("inside", lambda: within_country(project_buildings(raw), country))
    worst = stages.table("worst_labels", lambda: worst_labels(inside, labels, aois, aoi_grid))
    return assign_admin(L.add_label_info(inside, worst), A.admin_hierarchy(adm1, adm2, adm3), order=order)


def predictions_to_buildings(buildings: DataFrame, tiles: DataFrame, grid: Grid, dates: list, zoom: int | None = None, margin: int = 1) -> DataFrame:
    """Tiles to one raster, raster onto buildings, one prediction column per window start.

    The raster is pruned by the buildings: with ``zoom``, the level of the tiles' ids ``qk``, only tiles that a building, grown by
    ``margin`` cells, may touch are read (as literals, so other folders of a table partitioned by ``qk`` are not opened); then
    only cells in blocks with buildings are shuffled, once, by cell. Where tiles overlap, the last one by ``qk`` with a value
    wins; that is settled in these partitions before the join, so what a task holds are cells, not their overlaps.
    """
    if zoom is not None:
        around = margin * max(grid.dx, grid.dy)
        tiles = tiles.where(F.col("qk").isin(tiles_of_boxes(buildings, zoom, around)))
    # as numbers, ids keep their order and the aggregate needs no sort
    order = F.conv("qk", 4, 10).cast("long").alias("_order")
    near = Z.pixels_near(tiles.select("cx", "cy", "post_date", order, "value"), buildings, grid)
    tasks = Z.overlap_tasks(buildings, grid)
    once = R.mosaic(near.repartition(tasks, "cx", "cy"), ["cx", "cy", "post_date"], "_order")
    overlaps = Z.pixel_overlaps(buildings, ["building_id"], grid).repartition(tasks, "cx", "cy")
    return buildings.join(Z.wide_means(overlaps.join(once, ["cx", "cy"]), dates), "building_id", "left")
