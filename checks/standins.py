"""The driver tables read as the domain's tables, in Spark and in SQL.

Each function has a SQL twin in ``CTE`` under the same name.
"""

from __future__ import annotations

import struct
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.config import Period
from scarmap.functions import geometry as G
from scarmap.operators.raster import Grid
from scarmap.sources.readers import with_geometry

EVENT = date(2024, 1, 17)
PRE = [Period.of("2024-01-01", "2024-01-08")]
# The uncovered day between two windows is intended.
POST = [
    Period.of("2024-01-08", "2024-01-12"),
    Period.of("2024-01-13", "2024-01-17"),
    Period.of("2024-01-17", "2024-01-21"),
    Period.of("2024-01-22", "2024-01-26"),
]
STARTS = [p.start for p in POST]
BANDS = ["VV", "VH"]
NEGATIVE, POSITIVE = [1995, 1996], [1997, 1998, 1999, 2000, 2001]
YEARS = NEGATIVE + POSITIVE
RASTER_GRID = Grid(-0.5, -0.5, 1.0, 1.0)
PIXEL_GRID = Grid(22.0, 44.4, 0.01, 0.01)
REGION_GRID = Grid(22.0, 44.4, 0.05, 0.05)

CTE: dict[str, str] = {}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """To 6 places. Means of decimals often end in exactly half a unit; the shift decides those alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Given columns, or all floating-point ones, to 6 places."""
    columns = columns or [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: r6(c) for c in columns})


def sql(body: str, *names: str) -> str:
    """Body behind the named tables and those they build on, in order of definition."""
    return ("WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in CTE if n in _needed(names)) + "\n" if names else "") + body


def _needed(names) -> set[str]:
    found, todo = set(), list(names)
    while todo:
        n = todo.pop()
        if n not in found:
            found.add(n)
            todo += [m for m in CTE if m != n and m in CTE[n].replace("(", " ").replace(")", " ").replace(",", " ").split()]
    return found


CTE["obs"] = """SELECT user_id AS unosat_id, 'A' || (user_id % 6) AS aoi, CAST(event_id % 2 AS INT) AS orbit,
  CASE WHEN event_id % 11 <> 0 THEN value END AS VV, value * 0.5 + event_id % 13 AS VH, ts FROM events"""


def obs(spark, sf):
    e = read(spark, sf, "events")
    return e.select(
        F.col("user_id").alias("unosat_id"),
        F.concat(F.lit("A"), F.col("user_id") % 6).alias("aoi"),
        (F.col("event_id") % 2).cast("int").alias("orbit"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("VV"),
        (F.col("value") * 0.5 + F.col("event_id") % 13).alias("VH"),
        "ts",
    )


CTE["labels_raw"] = """SELECT o_orderkey AS unosat_id, o_custkey // 10 AS place, 'A' || ((o_custkey // 10) % 6) AS aoi,
  CAST(left(o_orderpriority, 1) AS INT) AS damage, CAST(o_orderdate AS DATE) AS ep,
  DATE '2024-01-01' + CAST(o_orderkey % 28 AS INT) AS date FROM orders"""


def labels_raw(spark, sf):
    o = read(spark, sf, "orders")
    place = F.floor(F.col("o_custkey") / 10)
    return o.select(
        F.col("o_orderkey").alias("unosat_id"),
        place.alias("place"),
        F.concat(F.lit("A"), place % 6).alias("aoi"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("damage"),
        F.to_date("o_orderdate").alias("ep"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("o_orderkey") % 28).cast("int")).alias("date"),
    )


# One label per point of `obs`: the newest of each place.
CTE["point_labels"] = """SELECT place AS unosat_id, aoi, damage, date FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY ep DESC, unosat_id) AS k FROM labels_raw) WHERE k = 1"""


def point_labels(spark, sf):
    from scarmap.operators.labels import dedupe_labels

    return dedupe_labels(labels_raw(spark, sf), ["place"]).select(F.col("place").alias("unosat_id"), "aoi", "damage", "date")


CTE["buildings"] = """SELECT c_custkey AS building_id, c_acctbal AS area, CAST(n_regionkey AS VARCHAR) AS adm1_id,
  CAST(c_nationkey AS VARCHAR) AS adm2_id, c_nationkey || '-' || c_mktsegment AS adm3_id,
  22.0005 + (c_custkey * 7919 % 18000) / 1000.0::DOUBLE AS lon, 44.4005 + (c_custkey * 104729 % 8000) / 1000.0::DOUBLE AS lat
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def buildings(spark, sf):
    c, n = read(spark, sf, "customer"), read(spark, sf, "nation")
    key = F.col("c_custkey")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("building_id"),
        F.col("c_acctbal").alias("area"),
        F.col("n_regionkey").cast("string").alias("adm1_id"),
        F.col("c_nationkey").cast("string").alias("adm2_id"),
        F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("adm3_id"),
        (key * 7919 % 18000 / 1000.0 + 22.0005).alias("lon"),
        (key * 104729 % 8000 / 1000.0 + 44.4005).alias("lat"),
    )


# Rectangles around the buildings' positions, some pixels wide.
CTE["shapes"] = """SELECT building_id, lon, lat, lon - (0.011 + building_id % 13 * 0.002::DOUBLE) AS minx,
  lat - (0.008 + building_id % 7 * 0.003::DOUBLE) AS miny, lon + (0.011 + building_id % 13 * 0.002::DOUBLE) AS maxx,
  lat + (0.008 + building_id % 7 * 0.003::DOUBLE) AS maxy FROM buildings"""


def shapes(spark, sf):
    w = F.lit(0.011) + F.col("building_id") % 13 * 0.002
    h = F.lit(0.008) + F.col("building_id") % 7 * 0.003
    lon, lat = F.col("lon"), F.col("lat")
    rings = G.box_rings(lon - w, lat - h, lon + w, lat + h)
    return with_geometry(buildings(spark, sf).select("building_id", "lon", "lat", rings.alias("rings")))


CTE["building_preds"] = """SELECT o_custkey AS building_id, CAST(year(o_orderdate) AS INT) AS post_date,
  CAST(max(floor(o_totalprice) % 256) AS DOUBLE) AS value FROM orders GROUP BY 1, 2"""


def building_preds(spark, sf):
    o = read(spark, sf, "orders")
    value = (F.floor("o_totalprice") % 256).cast("double")
    return o.groupBy(F.col("o_custkey").alias("building_id"), F.year("o_orderdate").alias("post_date")).agg(F.max(value).alias("value"))


CTE["wide"] = (
    "SELECT buildings.*, "
    + ", ".join(f"p.pred_{y}" for y in YEARS)
    + " FROM buildings LEFT JOIN (SELECT building_id, "
    + ", ".join(f"max(CASE WHEN post_date = {y} THEN value END) AS pred_{y}" for y in YEARS)
    + " FROM building_preds GROUP BY 1) p USING (building_id)"
)


def wide(spark, sf):
    from scarmap.operators.zonal import collect_preds

    measures = building_preds(spark, sf).withColumnRenamed("value", "weighted_mean")
    return collect_preds(buildings(spark, sf), measures, YEARS)


DAMAGED_SQL = (
    "(" + " AND ".join(f"coalesce(pred_{y} < 167.025, false)" for y in NEGATIVE) + " AND ("
    + " OR ".join(f"coalesce(pred_{y} >= 167.025, false)" for y in POSITIVE) + ") AND area > 50)"
)

CTE["overlap"] = """SELECT l_partkey AS building_id, l_suppkey AS pixel, CAST(year(l_shipdate) AS INT) AS post_date,
  l_quantity AS overlap_area, floor(l_extendedprice) % 256 AS value FROM lineitem"""


def overlap(spark, sf):
    return read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("building_id"),
        F.col("l_suppkey").alias("pixel"),
        F.year("l_shipdate").alias("post_date"),
        F.col("l_quantity").alias("overlap_area"),
        (F.floor("l_extendedprice") % 256).cast("double").alias("value"),
    )


# 5 x 5 cells with one corner cut off: convex pentagons.
CTE["admin"] = """SELECT n_nationkey AS row_id, '3_' || n_nationkey AS adm3_id, 'region ' || n_regionkey AS ADM1_EN, n_name AS ADM3_EN,
  22 + 3.6::DOUBLE * (n_nationkey // 5) AS x, 44.4 + 1.6::DOUBLE * (n_nationkey % 5) AS y FROM nation"""


def admin(spark, sf):
    n = read(spark, sf, "nation")
    x = F.floor(F.col("n_nationkey") / 5) * 3.6 + 22.0
    y = F.col("n_nationkey") % 5 * 1.6 + 44.4
    corners = [(0, 0), (1, 0), (1, 0.5), (0.5, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.struct((x + u * 3.6).alias("x"), (y + v * 1.6).alias("y")) for u, v in corners])
    rows = n.select(
        F.col("n_nationkey").alias("row_id"),
        F.concat(F.lit("3_"), F.col("n_nationkey")).alias("adm3_id"),
        F.concat(F.lit("region "), F.col("n_regionkey")).alias("ADM1_EN"),
        F.col("n_name").alias("ADM3_EN"),
        F.array(ring).alias("rings"),
    )
    return with_geometry(rows)


IN_ADMIN_SQL = "lon > x AND lat > y AND lon < x + 3.6 AND lat < y + 1.6 AND (lon - x) / 3.6 + (lat - y) / 1.6 < 1.5"

CTE["raster"] = """SELECT CAST(vec_id AS INT) AS cy, CAST(k - 1 AS INT) AS cx, CAST(embedding[k] AS DOUBLE) AS value
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings)"""


def raster(spark, sf):
    e = read(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("cy"), F.posexplode("embedding").alias("cx", "value"))
    return e.select("cy", "cx", F.col("value").cast("double").alias("value"))


CTE["scenes"] = """SELECT o_orderkey AS scene_id, CAST(o_custkey % 7 AS INT) AS orbit, o_orderdate AS ts,
  CASE WHEN o_orderstatus = 'P' THEN 'EW' ELSE 'IW' END AS instrumentMode,
  CASE WHEN o_orderkey % 3 = 0 THEN 'B' ELSE 'A' END AS platform_number,
  CASE WHEN o_orderpriority < '3' THEN ['VV', 'VH'] WHEN o_orderpriority < '4' THEN ['VH', 'VV'] ELSE ['VV'] END
    AS transmitterReceiverPolarisation,
  CAST(o_custkey % 100 AS DOUBLE) AS minx, CAST(o_orderkey % 50 AS DOUBLE) AS miny FROM orders"""


def scenes(spark, sf):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    minx, miny = (cust % 100).cast("double"), (key % 50).cast("double")
    box = F.struct(minx.alias("minx"), miny.alias("miny"), (minx + 3).alias("maxx"), (miny + 2).alias("maxy"))
    pols = (
        F.when(F.col("o_orderpriority") < "3", F.array(F.lit("VV"), F.lit("VH")))
        .when(F.col("o_orderpriority") < "4", F.array(F.lit("VH"), F.lit("VV")))
        .otherwise(F.array(F.lit("VV")))
    )
    return read(spark, sf, "orders").select(
        key.alias("scene_id"),
        (cust % 7).cast("int").alias("orbit"),
        F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderstatus") == "P", "EW").otherwise("IW").alias("instrumentMode"),
        F.when(key % 3 == 0, "B").otherwise("A").alias("platform_number"),
        pols.alias("transmitterReceiverPolarisation"),
        box.alias("bbox"),
    )


# Two periods of the scenes, by date.
SCENE_PERIODS = [Period.of("1996-01-01", "1996-03-01"), Period.of("1997-01-01", "1997-03-01")]

CTE["scene_pixels"] = """SELECT l_orderkey AS scene_id, CAST(l_partkey % 100 AS INT) AS cx, CAST(l_suppkey % 100 AS INT) AS cy,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS B1, l_extendedprice AS B2, l_discount * 100 AS B8, l_shipdate AS ts FROM lineitem"""


def scene_pixels(spark, sf):
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("scene_id"),
        (F.col("l_partkey") % 100).cast("int").alias("cx"),
        (F.col("l_suppkey") % 100).cast("int").alias("cy"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("B1"),
        F.col("l_extendedprice").alias("B2"),
        (F.col("l_discount") * 100).alias("B8"),
        F.col("l_shipdate").alias("ts"),
    )


CTE["scores"] = "SELECT o_orderkey AS scene_id, o_orderkey % 10 / 10.0::DOUBLE AS cs FROM orders WHERE o_orderstatus <> 'P'"


def scores(spark, sf):
    key = F.col("o_orderkey")
    return read(spark, sf, "orders").where("o_orderstatus <> 'P'").select(key.alias("scene_id"), (key % 10 / 10.0).alias("cs"))


# Predictions on the pixel grid over the buildings.
CTE["pred_pixels"] = """SELECT CAST(l_orderkey * 7919 % 1800 AS INT) AS cx, CAST((l_partkey * 13 + l_orderkey) % 800 AS INT) AS cy,
  CAST(year(l_shipdate) AS INT) AS post_date, max(CAST(floor(l_extendedprice) % 256 AS DOUBLE)) AS value
  FROM lineitem GROUP BY 1, 2, 3"""


def pred_pixels(spark, sf):
    l = read(spark, sf, "lineitem")
    cx = (F.col("l_orderkey") * 7919 % 1800).cast("int").alias("cx")
    cy = ((F.col("l_partkey") * 13 + F.col("l_orderkey")) % 800).cast("int").alias("cy")
    value = (F.floor("l_extendedprice") % 256).cast("double")
    return l.groupBy(cx, cy, F.year("l_shipdate").alias("post_date")).agg(F.max(value).alias("value"))


# Scores per point, orbit and window, and their labels.
CTE["scored"] = """SELECT aoi, unosat_id, orbit, start_post, avg(VH) / 256 AS classification FROM obs
  JOIN (VALUES {}) w(start_post, end_post) ON ts >= start_post AND ts < end_post GROUP BY ALL""".format(
    ", ".join(f"(DATE '{p.start}', DATE '{p.end}')" for p in POST)
)


def scored(spark, sf):
    from scarmap.operators.series import tag_periods

    tagged = tag_periods(obs(spark, sf), POST)
    start = F.array(*[F.lit(s) for s in STARTS])[F.col("period")]
    return tagged.groupBy("aoi", "unosat_id", "orbit", start.alias("start_post")).agg((F.avg("VH") / 256).alias("classification"))


CTE["point_preds"] = """SELECT aoi, unosat_id, start_post, least(255, CAST(trunc(avg(classification) * 255) AS INT)) AS pred
  FROM scored GROUP BY ALL"""
CTE["preds_labelled"] = "SELECT p.*, l.date, l.damage FROM point_preds p LEFT JOIN point_labels l USING (aoi, unosat_id)"


def point_preds(spark, sf):
    from scarmap.operators.evaluate import point_predictions

    return point_predictions(scored(spark, sf))


def preds_labelled(spark, sf):
    from scarmap.operators.labels import attach_labels

    return attach_labels(point_preds(spark, sf), point_labels(spark, sf), ["date", "damage"])


def box_wkb(df: DataFrame, keys: list[str]) -> DataFrame:
    """``bbox`` as a WKB polygon, big-endian for even ids: input for the decoder."""

    def encode(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for i, b in zip(ids, batch.column(batch.num_columns - 1).to_pylist()):
                o = ">" if i % 2 == 0 else "<"
                xs = (b["minx"], b["miny"], b["minx"], b["maxy"], b["maxx"], b["maxy"], b["maxx"], b["miny"], b["minx"], b["miny"])
                out.append(struct.pack(o + "BIII10d", i % 2, 3, 1, 5, *xs))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=[*keys, "geometry"])

    kept = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, "bbox").mapInArrow(encode, f"{kept}, geometry binary")
