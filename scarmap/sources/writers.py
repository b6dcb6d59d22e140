"""Sinks. Results go to new folders; reruns replace the partitions they write and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.config import Period, period_name
from scarmap.functions.geometry import signed_area
from scarmap.operators.raster import morton
from scarmap.sources.readers import feature_folder

# Cells of a page of stored predictions: a square of 32 x 32.
PAGE_CELLS = 1_024


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    df.write.partitionBy(*(partition_by or [])).mode(mode).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str], sort: list[str | Column] | None = None, page_rows: int | None = None) -> None:
    """Writes partitions in files of even size: rows of one partition may go to many tasks. ``page_rows``: rows that a scan with
    a filter can pass over together."""
    even = df.hint("rebalance", *by)
    if sort:
        even = even.sortWithinPartitions(*by, *sort)
    out = even.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if page_rows:
        out = out.option("parquet.page.row.count.limit", page_rows)
    out.parquet(path)


def write_observations(df: DataFrame, path: str, sat: str, window: str) -> None:
    """Point series by sensor, window, area (and orbit, where there is one)."""
    tagged = df.withColumns({"sat": F.lit(sat), "window": F.lit(window)})
    if "orbit" not in tagged.columns:
        tagged = tagged.withColumn("orbit", F.lit(None).cast("int"))
    replace_partitions(tagged, path, ["sat", "window", "aoi", "orbit"], ["unosat_id", "ts"])


def write_features(df: DataFrame, root: str, sat: str, window: str, post: list[Period], split: str) -> str:
    path = f"{root}/{feature_folder(sat, window, period_name(post), split)}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_pred_tiles(preds: DataFrame, path: str) -> None:
    """Quantised predictions by window (``period=start_end``) and tile, inside a tile along a curve that keeps neighbours together."""
    replace_partitions(preds, path, ["period", "qk"], [morton(F.col("cx"), F.col("cy"))], PAGE_CELLS)


def point_geometry(lon: str = "lon", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def polygon_geometry(rings: str = "rings") -> Column:
    """MultiPolygon: every counter-clockwise ring starts a part, the following holes belong to it."""
    xy = "array<array<array<array<double>>>>"
    ring = lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))

    def add(parts: Column, r: Column) -> Column:
        fresh = F.concat(parts, F.array(F.array(ring(r))))
        before = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
        grown = F.concat(before, F.array(F.concat(F.element_at(parts, -1), F.array(ring(r)))))
        return F.when((signed_area(r) >= 0) | (F.size(parts) == 0), fresh).otherwise(grown)

    parts = F.aggregate(rings, F.array().cast(xy), add)
    return F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))


def write_geojson(df: DataFrame, path: str, geometry: Column, properties: list[str]) -> None:
    """One GeoJSON feature per line."""
    geojson_lines(df, geometry, properties).write.mode("overwrite").text(path)


def geojson_lines(df: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[F.col(c).cast("string").alias(c) if df.schema[c].dataType.typeName() == "date" else F.col(c) for c in properties]).alias("properties"),
        geometry.alias("geometry"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))
