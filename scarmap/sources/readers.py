"""Scans: every filter and column choice reaches the file scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from scarmap.config import BAD_ORBITS, Period
from scarmap.functions import geometry as G
from scarmap.functions.values import json_value, nan_to_null, period_text
from scarmap.operators import labels as L
from scarmap.operators.scenes import valid_orbits
from scarmap.operators.series import join_features
from scarmap.sources import schemas as S


def features_of(lines: DataFrame) -> DataFrame:
    """GeoJSON features: one per line (alone or inside a collection), or whole collections on a line.

    Keys may come in any order. Lines that only frame a collection are passed over; any other line that is
    not a feature is an error, as a feature spread over several lines would be lost.
    """
    line = F.regexp_replace(F.col("value"), r"^\s+|\s*,?\s*$", "")
    parsed = F.from_json(line, f"{S.FEATURE}, features {S.FEATURES}")
    frame = line.rlike(r"^[\s\[\]{},]*$") | (
        line.rlike(r'^\{?\s*"(type|name|crs|bbox|features)"\s*:') & ~line.rlike(r'"geometry"|"type"\s*:\s*"Feature"')
    )
    one = F.struct(*[F.col(f"_f.{c}").alias(c) for c in ("type", "properties", "geometry")])
    wrong = F.raise_error(F.concat(F.lit("not a GeoJSON feature: "), F.substring("value", 1, 200)))
    found = (
        F.when((F.col("_f.type") == "Feature") & F.col("_f.geometry").isNotNull(), F.array(one))
        .when(F.col("_f.features").isNotNull(), F.col("_f.features"))
        .when(frame, F.slice(F.array(one), 1, 0))
        .otherwise(wrong.cast(S.FEATURES))
    )
    return lines.withColumn("_f", parsed).select(F.explode(found).alias("f")).select("f.*")


def geojson_rings(geometry: Column) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon, oriented."""
    kind, text = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    one = F.array(F.from_json(text, "array<array<array<double>>>"))
    parts = F.when(kind == "Polygon", one).otherwise(F.from_json(text, "array<array<array<array<double>>>>"))
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    rings = lambda part: G.oriented(F.transform(part, lambda r: F.transform(r, point)))
    return F.flatten(F.transform(parts, rings))


def with_geometry(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds ``edges`` and ``bbox`` to a table with rings."""
    return df.withColumns({"edges": G.edges_of(F.col(rings)), "bbox": G.bounds_of(F.col(rings))})


def scan_labels(spark: SparkSession, path: str) -> DataFrame:
    """Damage points."""
    return labels_of(spark.read.text(path))


def labels_of(lines: DataFrame) -> DataFrame:
    f = features_of(lines)
    p = F.from_json("properties", S.LABEL_PROPERTIES)
    at = F.from_json(F.get_json_object("geometry", "$.coordinates"), "array<double>")
    rows = f.select(p.alias("p"), at.alias("c"))
    return rows.select(
        "p.unosat_id", "p.aoi", "p.damage", F.to_date(F.substring("p.date", 1, 10)).alias("date"), "p.ep",
        F.col("c")[0].alias("lon"), F.col("c")[1].alias("lat"),
    )


def scan_labels_by_aoi(labels: DataFrame, aoi: str, all_labels: bool = False) -> DataFrame:
    """Labels of one area: all classes, or the two strongest."""
    return L.keep_damage(L.keep_aoi(labels, aoi), None if all_labels else [1, 2])


def scan_polygons(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON polygons with the given properties, rings, edges and bounds."""
    return polygons_of(spark.read.text(path), properties)


def polygons_of(lines: DataFrame, properties: str) -> DataFrame:
    rows = features_of(lines).select(F.from_json("properties", properties).alias("p"), geojson_rings(F.col("geometry")).alias("rings"))
    return with_geometry(rows.select("p.*", "rings"))


def scan_aois(spark: SparkSession, path: str) -> DataFrame:
    return scan_polygons(spark, path, "aoi string")


def aoi_geometry(aois: DataFrame, aoi: str) -> DataFrame:
    return aois.where(F.col("aoi") == aoi)


def country_boundary(spark: SparkSession, path: str, name: str) -> DataFrame:
    return scan_polygons(spark, path, "name string").where(F.col("name") == name)


def scan_admin(spark: SparkSession, path: str, level: int) -> DataFrame:
    """Admin polygons with the names of all parent levels; the id comes from the stored row number, which is kept."""
    names = ", ".join(f"ADM{i}_EN string" for i in range(1, level + 1))
    rows = scan_polygons(spark, path, f"row_id int, {names}")
    return rows.withColumn("admin_id", admin_id(level, F.col("row_id")))


def admin_id(level: int, row: Column) -> Column:
    """Level and row number; without a number regions would share an id, so that is an error."""
    missing = F.raise_error(F.lit(f"an admin polygon of level {level} has no row_id")).cast("string")
    return F.when(row.isNull(), missing).otherwise(F.concat_ws("_", F.lit(level), row))


def scan_orbits(spark: SparkSession, path: str, bad=BAD_ORBITS) -> DataFrame:
    return valid_orbits(spark.read.schema(S.ORBITS).csv(path, header=True), bad)


def scan_buildings(spark: SparkSession, path: str, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Buildings whose box lies inside ``bbox``; pushed down on the nested fields."""
    return within_bbox(spark.read.parquet(path), bbox)


def within_bbox(df: DataFrame, bbox: tuple[float, float, float, float], box: str = "bbox") -> DataFrame:
    minx, miny, maxx, maxy = bbox
    c = lambda n: F.col(f"{box}.{n}")
    return df.where((c("minX") >= minx) & (c("minY") >= miny) & (c("maxX") <= maxx) & (c("maxY") <= maxy))


def scan_observations(spark: SparkSession, path: str, sat: str, window: str, aoi=None, orbit=None, damages=None) -> DataFrame:
    """Stored point series; sensor, window, area and orbit select partitions. NaN becomes null."""
    df = spark.read.parquet(path).where((F.col("sat") == sat) & (F.col("window") == window))
    return select_observations(df, aoi, orbit, damages)


def select_observations(df: DataFrame, aoi=None, orbit=None, damages=None) -> DataFrame:
    if aoi is not None:
        df = L.keep_aoi(df, aoi)
    if orbit is not None:
        df = df.where(F.col("orbit") == orbit)
    return clean(L.keep_damage(df, damages))


def clean(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column."""
    return df.withColumns({f.name: nan_to_null(F.col(f.name)) for f in df.schema if f.dataType.typeName() in ("double", "float")})


def scan_features(spark: SparkSession, root: str, sat: str, split: str, period: str, windows: str | list[str]) -> DataFrame:
    """Stored feature table; two windows are joined. A table that was never written is an error."""
    windows = [windows] if isinstance(windows, str) else windows
    tables = [spark.read.parquet(f"{root}/{feature_folder(sat, w, period, split)}") for w in windows]
    out = tables[0]
    for t in tables[1:]:
        out = join_features(out, t)
    return out


def feature_folder(sat: str, window: str, period: str, split: str) -> str:
    return f"features/{sat}_{window}_{period}_{split}"


def discover_periods(spark: SparkSession, path: str) -> list[Period]:
    """Periods named in the paths of stored predictions, in order."""
    names = [n for n in partition_values(spark, path) if n]
    start, end = period_text(F.col("f"))
    found = spark.createDataFrame([(n,) for n in names], "f string").select(start.alias("s"), end.alias("e"))
    return [Period(r.s, r.e) for r in found.where("s is not null").distinct().orderBy("s", "e").collect()]


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def partition_values(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Names of the folders ``depth`` levels below ``path``, relative to it; no file is opened. None if it does not exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    level = [("", root)]
    for _ in range(depth):
        level = [
            (f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath())
            for name, folder in level for s in system.listStatus(folder) if s.isDirectory() and s.getPath().getName()[:1] not in "._"
        ]
    return sorted(name for name, _ in level)


def scan_buildings_of_admin(buildings: DataFrame, admin: str) -> DataFrame:
    return buildings.where(F.col("adm3_id") == admin)


def scan_building_preds(spark: SparkSession, path: str) -> DataFrame:
    return clean(spark.read.parquet(path))


_RINGS = ArrayType(ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])))


def _read(data: np.ndarray, at: np.ndarray, big: np.ndarray, kind: str) -> np.ndarray:
    """Numbers of the given kind at byte positions, big-endian where ``big``."""
    raw = data[at[:, None] + np.arange(np.dtype(kind).itemsize)]
    return np.where(big, raw.view(f">{kind}")[:, 0], raw.view(f"<{kind}")[:, 0])


def _wkb_layout(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first byte, vertices, numbers per vertex, big-endian, outer) of every ring, in order per row.

    All geometries of a batch are read side by side, one header or ring of each at a time.
    """
    n = len(starts)
    at, parts, rings = starts.astype("i8"), np.ones(n, "i8"), np.zeros(n, "i8")
    dims, big, outer = np.full(n, 2), np.zeros(n, bool), np.zeros(n, bool)
    found = []
    while len(head := np.flatnonzero((rings == 0) & (parts > 0))) or rings.any():
        if len(head):
            big[head] = data[at[head]] == 0
            kind = _read(data, at[head] + 1, big[head], "u4").astype("i8")
            dims[head] = 2 + np.isin(kind // 1000, (1, 2)) + 2 * (kind // 1000 == 3)
            kind %= 1000
            if not np.isin(kind, (1, 3, 4, 6)).all():
                raise ValueError(f"geometry type {kind[~np.isin(kind, (1, 3, 4, 6))][0]} is not supported")
            at[head] += 5
            point, counted = head[kind == 1], head[kind != 1]
            many = kind[kind != 1] != 3
            count = _read(data, at[counted], big[counted], "u4").astype("i8")
            at[counted] += 4
            parts[counted[many]] += count[many] - 1
            rings[counted[~many]] = count[~many]
            parts[counted[~many][count[~many] == 0]] -= 1
            outer[counted] = True
            found.append((point, at[point], np.ones(len(point), "i8"), dims[point], big[point], np.ones(len(point), bool)))
            at[point] += 8 * dims[point]
            parts[point] -= 1
        ring = np.flatnonzero(rings > 0)
        size = _read(data, at[ring], big[ring], "u4").astype("i8")
        found.append((ring, at[ring] + 4, size, dims[ring], big[ring], outer[ring]))
        at[ring] += 4 + 8 * size * dims[ring]
        rings[ring] -= 1
        outer[ring] = False
        parts[ring[rings[ring] == 0]] -= 1
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, "i8")] * 6
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


def _wkb_vertices(data: np.ndarray, at: np.ndarray, size: np.ndarray, dims: np.ndarray, big: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Vertices (x, y) of all rings, outer rings counter-clockwise, holes clockwise."""
    ring = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(ring)) - np.repeat(np.cumsum(size) - size, size)
    first = at[ring] + 8 * place * dims[ring]
    xy = np.stack([_read(data, first + 8 * k, big[ring], "f8") for k in (0, 1)], 1) if len(ring) else np.zeros((0, 2))
    begin = np.cumsum(size) - size
    x, y = (xy - xy[begin[ring]]).T if len(ring) else xy.T
    last = place == size[ring] - 1
    cross = np.zeros(len(ring))
    cross[:-1] = x[:-1] * y[1:] - x[1:] * y[:-1]
    cross[last] = 0
    turned = (np.bincount(ring, cross, len(size)) >= 0) != outer
    source = np.where(turned[ring], begin[ring] + size[ring] - 1 - place, np.arange(len(ring)))
    return xy[source]


def normalise_geometry(df: DataFrame, wkb: str = "geometry") -> DataFrame:
    """Replaces a WKB column by ``rings``, and adds ``edges`` and ``bbox``. Run once, store the result."""
    kept = [f for f in df.schema if f.name != wkb]
    names = [f.name for f in kept]

    def decode(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(wkb)).cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], "i8")[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", "u1")
            missing = column.is_null().to_numpy(zero_copy_only=False)
            there = np.flatnonzero(~missing)
            row, *rings = _wkb_layout(data, offsets[there])
            flat = _wkb_vertices(data, *rings)
            xy = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["x", "y"])
            ends = np.concatenate([[0], np.cumsum(rings[1])]).astype("int32")
            per_ring = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), xy)
            upto = np.concatenate([[0], np.cumsum(np.bincount(there[row], minlength=len(column)))]).astype("int32")
            per_row = pa.ListArray.from_arrays(pa.array(upto, pa.int32(), mask=np.append(missing, False)), per_ring)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + [per_row], names=[*names, "rings"])

    decoded = df.select(*names, wkb).mapInArrow(decode, StructType([*kept, StructField("rings", _RINGS)]))
    return with_geometry(decoded)


def project_buildings(raw: DataFrame) -> DataFrame:
    """Source, id, class, area in square metres and centroid of normalised buildings."""
    centre = G.centroid(F.col("edges"))
    return raw.select(
        json_value(F.col("sources"), "$[0].dataset").alias("dataset"),
        F.col("id").alias("building_id"),
        F.col("class").alias("osm_class"),
        "rings",
        "edges",
        "bbox",
        G.area_spheroid(F.col("edges")).alias("area"),
        centre["x"].alias("lon"),
        centre["y"].alias("lat"),
    )
