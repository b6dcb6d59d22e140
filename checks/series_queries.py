"""Time series, labels, scenes and model queries."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks import standins as D
from checks.registry import query
from checks.standins import BANDS, EVENT, POST, PRE, SCENE_PERIODS, r6, read, rounded, sql
from checks.statistics_sql import LABEL_SQL, experiment_sql, features, statistics
from scarmap.cluster import tasks_of
from scarmap.config import REDUCERS, Period, RunConfig
from scarmap.functions import values as V
from scarmap.operators import evaluate as E
from scarmap.operators import labels as L
from scarmap.operators import model as M
from scarmap.operators import raster as R
from scarmap.operators import scenes as S
from scarmap.operators import series as T
from scarmap.plans import experiment, inference
from scarmap.sources import readers, writers

POINT = ["aoi", "unosat_id", "orbit"]
PLACE = "place"
LABEL_COLS = "unosat_id, place, aoi, damage, ep, date"
DEDUPED = f"SELECT {LABEL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY {{}}) AS k FROM labels_raw) WHERE k = 1"


def r6s(cols):
    return ", ".join(f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in cols)


# ---- reducers


def _reducer(name):
    cols = [f"{b}_{name}" for b in BANDS]

    @query(f"reducer_{name.lower()}", sql(f"SELECT aoi, unosat_id, orbit, {r6s(cols)} FROM ({statistics('obs', POINT, BANDS, [name])})", "obs"))
    def run(spark, sf):
        return rounded(T.reduce_groups(D.obs(spark, sf), POINT, BANDS, [name]))


for _name in REDUCERS:
    _reducer(_name)

_ALL = [f"{b}_{n}" for b in BANDS for n in REDUCERS]


@query("reducers_combined", sql(f"SELECT aoi, unosat_id, orbit, n, {r6s(_ALL)} FROM ({statistics('obs', POINT, BANDS, REDUCERS)})", "obs"))
def reducers_combined(spark, sf):
    return rounded(T.reduce_groups(D.obs(spark, sf), POINT, BANDS, REDUCERS, count_as="n"))


@query("hot_group_reducers", sql(f"SELECT orbit, n, {r6s(_ALL)} FROM ({statistics('obs', ['orbit'], BANDS, REDUCERS)})", "obs"))
def hot_group_reducers(spark, sf):
    """Two groups hold all rows: the way for groups that no task may hold."""
    return rounded(T.reduce_groups(D.obs(spark, sf), ["orbit"], BANDS, REDUCERS, count_as="n", hot_rows=300))


# ---- periods and features


@query("in_period", sql(f"SELECT unosat_id, aoi, orbit, VH, ts FROM obs WHERE ts >= DATE '{PRE[0].start}' AND ts < DATE '{PRE[0].end}'", "obs"))
def in_period(spark, sf):
    return D.obs(spark, sf).where(V.in_period(F.col("ts"), PRE[0])).drop("VV")


_VALUES = ", ".join(f"({i}, DATE '{p.start}', DATE '{p.end}')" for i, p in enumerate([*PRE, *POST]))


@query("tag_periods", sql(f"SELECT unosat_id, orbit, VH, ts, i AS period FROM obs JOIN (VALUES {_VALUES}) w(i, s, e) ON ts >= s AND ts < e", "obs"))
def tag_periods(spark, sf):
    return T.tag_periods(D.obs(spark, sf), [*PRE, *POST]).select("unosat_id", "orbit", "VH", "ts", "period")


_PAIRS = ", ".join(f"(DATE '{a.start}', DATE '{a.end}', DATE '{b.start}', DATE '{b.end}')" for a in PRE for b in POST)


@query(
    "period_pairs",
    sql(f"SELECT unosat_id, aoi, w.* FROM point_labels CROSS JOIN (VALUES {_PAIRS}) w(start_pre, end_pre, start_post, end_post)", "point_labels"),
)
def period_pairs(spark, sf):
    return T.period_pairs(D.point_labels(spark, sf).select("unosat_id", "aoi"), PRE, POST)


_LABELLED = f"""SELECT unosat_id, aoi, damage, date, w.*, {LABEL_SQL} AS label FROM point_labels
  CROSS JOIN (VALUES {_PAIRS}) w(start_pre, end_pre, start_post, end_post)
  WHERE end_post <= DATE '{EVENT}' OR date <= end_post"""


@query("label_windows", sql(_LABELLED, "point_labels"))
def label_windows(spark, sf):
    return L.label_windows(D.point_labels(spark, sf), PRE, POST, EVENT)


@query("point_features", sql(features("obs", POINT, BANDS, REDUCERS), "obs"))
def point_features(spark, sf):
    return rounded(T.period_features(D.obs(spark, sf), POINT, BANDS, PRE, POST, REDUCERS))


@query("point_features_counts", sql(features("obs", ["aoi", "unosat_id"], ["VH"], ["mean", "median"], count_as="n_tiles"), "obs"))
def point_features_counts(spark, sf):
    return rounded(T.period_features(D.obs(spark, sf), ["aoi", "unosat_id"], ["VH"], PRE, POST, ["mean", "median"], count_as="n_tiles"))


_OVERLAPPING = [Period.of("2024-01-08", "2024-01-20"), Period.of("2024-01-14", "2024-01-26")]


@query("point_features_two_pre", sql(features("obs", POINT, ["VH"], ["mean", "max"], pre=[*PRE, Period.of("2024-01-03", "2024-01-10")], post=_OVERLAPPING), "obs"))
def point_features_two_pre(spark, sf):
    """Every pre with every post; windows may share days."""
    pre = [*PRE, Period.of("2024-01-03", "2024-01-10")]
    return rounded(T.period_features(D.obs(spark, sf), POINT, ["VH"], pre, _OVERLAPPING, ["mean", "max"]))


_TRAIN, _TEST = ["A0", "A1"], ["A2", "A3", "A4", "A5"]


def _split_sql(aois, names):
    inside = ", ".join(f"'{a}'" for a in aois)
    feats = features("obs", POINT, BANDS, names)
    cols = ", ".join(f"f.{b}_{p}_1x1_{n}" for b in BANDS for p in ("pre", "post") for n in names)
    return sql(
        f"""SELECT s.unosat_id, s.aoi, s.damage, s.date, o.orbit, s.start_pre, s.end_pre, s.start_post, s.end_post, s.label, {cols}
FROM ({_LABELLED}) s JOIN (VALUES (0), (1)) o(orbit) ON true
LEFT JOIN ({feats}) f ON f.aoi = s.aoi AND f.unosat_id = s.unosat_id AND f.orbit = o.orbit AND f.start_pre = s.start_pre AND f.start_post = s.start_post
WHERE s.aoi IN ({inside}) AND s.damage IN (1, 2)""",
        "obs", "point_labels",
    )


def _split(spark, sf, aois):
    points = L.keep_aoi(L.keep_damage(D.point_labels(spark, sf), [1, 2]), aois)
    orbits = D.obs(spark, sf).select("aoi", "orbit").distinct()
    feats = T.period_features(L.keep_aoi(D.obs(spark, sf), aois), POINT, BANDS, PRE, POST, ["mean", "stdDev"])
    return rounded(L.labelled_features(points, feats, PRE, POST, EVENT, orbits))


@query("features_train_split", _split_sql(_TRAIN, ["mean", "stdDev"]))
def features_train_split(spark, sf):
    return _split(spark, sf, _TRAIN)


@query("features_test_split", _split_sql(_TEST, ["mean", "stdDev"]))
def features_test_split(spark, sf):
    return _split(spark, sf, _TEST)


@query("features_union_splits", _split_sql([*_TRAIN, *_TEST], ["mean", "stdDev"]))
def features_union_splits(spark, sf):
    return _split(spark, sf, _TRAIN).unionByName(_split(spark, sf, _TEST))


@query("dataset_size", sql(f"SELECT count(*) AS n FROM ({_LABELLED})", "point_labels"))
def dataset_size(spark, sf):
    return experiment.dataset_size(L.label_windows(D.point_labels(spark, sf), PRE, POST, EVENT))


_PIXEL_KEYS = ["cx", "cy", "orbit"]
_SCENE_POST = [SCENE_PERIODS[1], Period.of("1998-01-01", "1999-01-01")]
_PIXELS_SQL = "(SELECT p.*, s.orbit FROM scene_pixels p JOIN scenes s USING (scene_id))"


@query("pixel_features", sql(features(_PIXELS_SQL, _PIXEL_KEYS, ["B2"], ["mean", "median", "max"], pre=SCENE_PERIODS[:1], post=_SCENE_POST), "scene_pixels", "scenes"))
def pixel_features(spark, sf):
    pixels = D.scene_pixels(spark, sf).join(D.scenes(spark, sf).select("scene_id", "orbit"), "scene_id")
    return rounded(T.period_features(pixels, _PIXEL_KEYS, ["B2"], SCENE_PERIODS[:1], _SCENE_POST, ["mean", "median", "max"]))


@query("rename_features", sql("SELECT unosat_id, round(avg(VV) + 1e-9, 6) + 0.0 AS VV_pre_1x1_mean FROM obs GROUP BY 1", "obs"))
def rename_features(spark, sf):
    stats = T.reduce_groups(D.obs(spark, sf), ["unosat_id"], ["VV"], ["mean"])
    return rounded(T.rename_features(stats, ["VV"], ["mean"], "pre", "1x1"))


@query("series_of_point", sql("SELECT o.unosat_id, o.orbit, o.VH, o.ts, l.damage FROM obs o JOIN point_labels l USING (aoi, unosat_id) WHERE damage = 1", "obs", "point_labels"))
def series_of_point(spark, sf):
    points = L.keep_damage(D.point_labels(spark, sf), [1])
    return T.series_of_points(D.obs(spark, sf), points, ["damage"]).select("unosat_id", "orbit", "VH", "ts", "damage")


@query(
    "fill_gaps",
    sql("SELECT unosat_id, orbit, ts, round(coalesce(VV, avg(VV) OVER (PARTITION BY unosat_id, orbit)) + 1e-9, 6) + 0.0 AS VV, VH FROM obs", "obs"),
)
def fill_gaps(spark, sf):
    return rounded(T.fill_gaps(D.obs(spark, sf), ["unosat_id", "orbit"], ["VV"]).drop("aoi"), "VV")


_F1 = "SELECT aoi, unosat_id, orbit, start_pre, start_post, VH_post_1x1_mean, VV_pre_1x1_mean FROM (" + features("obs", POINT, BANDS, ["mean"]) + ")"
_F2 = "SELECT aoi, unosat_id, orbit, start_pre, start_post, VH_post_3x3_max, end_post FROM (" + features("obs", POINT, ["VH"], ["max"], "3x3") + ")"


@query("join_features", sql(f"SELECT * FROM ({_F1}) JOIN ({_F2}) USING (aoi, unosat_id, orbit, start_pre, start_post)", "obs"))
def join_features(spark, sf):
    one = T.period_features(D.obs(spark, sf), POINT, BANDS, PRE, POST, ["mean"])
    two = T.period_features(D.obs(spark, sf), POINT, ["VH"], PRE, POST, ["max"], "3x3")
    return rounded(T.join_features(one, two, ["VH_post_1x1_mean", "VV_pre_1x1_mean"], ["VH_post_3x3_max", "end_post"]))


_TWO_PRE = [*PRE, Period.of("2024-01-02", "2024-01-06")]
_N1 = "SELECT aoi, unosat_id, start_pre, start_post, VH_post_1x1_mean FROM (" + features("obs", ["aoi", "unosat_id"], BANDS, ["mean"]) + ")"
_N2 = "SELECT aoi, unosat_id, start_pre, start_post, VH_post_3x3_max FROM (" + features("obs", ["aoi", "unosat_id"], ["VH"], ["max"], "3x3") + ")"
_P1 = "SELECT aoi, unosat_id, orbit, start_pre, start_post, VV_pre_1x1_mean FROM (" + features("obs", POINT, BANDS, ["mean"], pre=_TWO_PRE) + ")"
_P2 = "SELECT aoi, unosat_id, orbit, start_pre, start_post, VH_post_3x3_max FROM (" + features("obs", POINT, ["VH"], ["max"], "3x3", pre=_TWO_PRE) + ")"
_S1 = "SELECT aoi, unosat_id, orbit, start_pre, start_post, VH_post_1x1_mean FROM (" + features("obs", POINT, BANDS, ["mean"]) + ")"
_S2 = "SELECT aoi, unosat_id, start_pre, start_post, VV_post_1x1_max FROM (" + features("obs", ["aoi", "unosat_id"], ["VV"], ["max"]) + ") WHERE VV_post_1x1_max > 100"


@query("join_sensors", sql(f"SELECT * FROM ({_S1}) LEFT JOIN ({_S2}) USING (aoi, unosat_id, start_pre, start_post)", "obs"))
def join_sensors(spark, sf):
    o = D.obs(spark, sf)
    one = T.period_features(o, POINT, BANDS, PRE, POST, ["mean"]).select(*POINT, "start_pre", "start_post", "VH_post_1x1_mean")
    two = T.period_features(o, ["aoi", "unosat_id"], ["VV"], PRE, POST, ["max"]).where("VV_post_1x1_max > 100")
    return rounded(T.join_sensors(one, two.select("aoi", "unosat_id", "start_pre", "start_post", "VV_post_1x1_max")))


# ---- labels


@query("dedupe_labels_last", sql(DEDUPED.format("ep DESC, unosat_id"), "labels_raw"))
def dedupe_labels_last(spark, sf):
    return L.dedupe_labels(D.labels_raw(spark, sf), [PLACE], "last")


@query("dedupe_labels_min", sql(DEDUPED.format("damage, unosat_id"), "labels_raw"))
def dedupe_labels_min(spark, sf):
    return L.dedupe_labels(D.labels_raw(spark, sf), [PLACE], "min")


@query("labels_for_areas", sql(f"SELECT * FROM ({DEDUPED.format('ep DESC, unosat_id')}) WHERE damage IN (1, 2) AND aoi IN ('A1', 'A4')", "labels_raw"))
def labels_for_areas(spark, sf):
    return L.labels_for(D.labels_raw(spark, sf), [PLACE], ["A1", "A4"])


@query("keep_damage", sql(f"SELECT {LABEL_COLS} FROM labels_raw WHERE damage IN (1, 2)", "labels_raw"))
def keep_damage(spark, sf):
    return L.keep_damage(D.labels_raw(spark, sf), [1, 2])


@query("keep_aoi", sql(f"SELECT {LABEL_COLS} FROM labels_raw WHERE aoi IN ('A0', 'A5')", "labels_raw"))
def keep_aoi(spark, sf):
    return L.keep_aoi(D.labels_raw(spark, sf), ["A0", "A5"])


@query("labels_by_aoi", sql(f"SELECT {LABEL_COLS} FROM labels_raw WHERE aoi = 'A2' AND damage IN (1, 2)", "labels_raw"))
def labels_by_aoi(spark, sf):
    return readers.scan_labels_by_aoi(D.labels_raw(spark, sf), "A2")


@query("labels_from_geojson", "SELECT CAST(o_orderkey AS VARCHAR) AS unosat_id, 'A' || ((o_custkey // 10) % 6) AS aoi, CAST(left(o_orderpriority, 1) AS INT) AS damage,"
       " CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS INT) AS ep, o_custkey / 8.0::DOUBLE AS lon, o_orderkey / 4.0::DOUBLE AS lat FROM orders")
def labels_from_geojson(spark, sf):
    """Label features written as lines and read back with the declared schema."""
    rows = read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("unosat_id"),
        F.concat(F.lit("A"), F.floor(F.col("o_custkey") / 10) % 6).alias("aoi"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("damage"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").cast("int").alias("ep"),
        (F.col("o_custkey") / 8.0).alias("lon"),
        (F.col("o_orderkey") / 4.0).alias("lat"),
    )
    return readers.labels_of(writers.geojson_lines(rows, writers.point_geometry(), ["unosat_id", "aoi", "damage", "date", "ep"]))


@query("attach_labels", sql("SELECT aoi, unosat_id, start_post, pred, date, damage FROM preds_labelled", "preds_labelled"))
def attach_labels(spark, sf):
    return D.preds_labelled(spark, sf)


_HITS = "SELECT c_custkey // 3 AS building_id, o_orderkey AS unosat_id, CAST(left(o_orderpriority, 1) AS INT) AS damage, CAST(o_orderdate AS DATE) AS date, 'A' || (o_custkey % 6) AS aoi FROM orders JOIN customer ON o_custkey = c_custkey"


def _hits(spark, sf):
    o, c = read(spark, sf, "orders"), read(spark, sf, "customer").select("c_custkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.floor(F.col("c_custkey") / 3).alias("building_id"),
        F.col("o_orderkey").alias("unosat_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("damage"),
        F.to_date("o_orderdate").alias("date"),
        F.concat(F.lit("A"), F.col("o_custkey") % 6).alias("aoi"),
    )


_WORST = f"SELECT building_id, damage AS unosat_damage, unosat_id, date AS unosat_date, aoi AS unosat_aoi FROM (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY damage, unosat_id) AS k FROM ({_HITS})) WHERE k = 1"


@query("worst_label_per_building", _WORST)
def worst_label_per_building(spark, sf):
    return L.worst_label_per_building(_hits(spark, sf))


@query("add_label_info", sql(f"SELECT b.*, w.* EXCLUDE (building_id) FROM (SELECT building_id, adm3_id FROM buildings) b LEFT JOIN ({_WORST}) w USING (building_id)", "buildings"))
def add_label_info(spark, sf):
    return L.add_label_info(D.buildings(spark, sf).select("building_id", "adm3_id"), L.worst_label_per_building(_hits(spark, sf)))


@query("select_observations", sql("SELECT unosat_id, aoi, orbit, VV, VH, ts FROM obs WHERE aoi = 'A3' AND orbit = 1", "obs"))
def select_observations(spark, sf):
    return readers.select_observations(D.obs(spark, sf), "A3", 1)


# ---- orbits and scenes

_PACKED = "SELECT 'A' || (o_orderkey % 18) AS aoi, string_agg(DISTINCT CAST(o_custkey % 7 AS VARCHAR), ',' ORDER BY CAST(o_custkey % 7 AS VARCHAR)) AS p FROM orders GROUP BY 1"


def _packed(spark, sf):
    o = read(spark, sf, "orders")
    listed = F.array_join(F.sort_array(F.collect_set((F.col("o_custkey") % 7).cast("string"))), ",")
    return o.groupBy(F.concat(F.lit("A"), F.col("o_orderkey") % 18).alias("aoi")).agg(listed.alias("valid_orbits"))


@query("scan_orbits", f"SELECT aoi, unnest(string_split(p, ','))::INT AS orbit FROM ({_PACKED})")
def scan_orbits(spark, sf):
    return S.aoi_orbits(S.valid_orbits(_packed(spark, sf), {}))


@query("aoi_orbits", f"SELECT * FROM (SELECT aoi, unnest(string_split(p, ','))::INT AS orbit FROM ({_PACKED})) WHERE NOT (aoi = 'A8' AND orbit = 5)")
def aoi_orbits(spark, sf):
    return S.aoi_orbits(S.valid_orbits(_packed(spark, sf), {"A8": [5]}))


@query("valid_orbits_of_area", f"SELECT * FROM (SELECT aoi, unnest(string_split(p, ','))::INT AS orbit FROM ({_PACKED})) WHERE aoi = 'A8' AND orbit <> 5")
def valid_orbits_of_area(spark, sf):
    return S.aoi_orbits(L.keep_aoi(S.valid_orbits(_packed(spark, sf), {"A8": [5]}), "A8"))


_S1_WHERE = "list_contains(transmitterReceiverPolarisation, 'VV') AND list_contains(transmitterReceiverPolarisation, 'VH') AND instrumentMode = 'IW' AND platform_number = 'A'"
_RANGE = Period.of("1996-01-01", "1999-06-01")


@query(
    "select_s1",
    sql(f"SELECT scene_id, orbit, ts FROM scenes WHERE {_S1_WHERE} AND ts >= DATE '1996-01-01' AND ts < DATE '1999-06-01' AND orbit = 3"
        " AND minx <= 40 AND minx + 3 >= 20 AND miny <= 30 AND miny + 2 >= 10", "scenes"),
)
def select_s1(spark, sf):
    return S.select_s1(D.scenes(spark, sf), _RANGE, 3, (20.0, 10.0, 40.0, 30.0)).select("scene_id", "orbit", "ts")


@query("select_s1_all", sql(f"SELECT scene_id, orbit, ts FROM scenes WHERE {_S1_WHERE}", "scenes"))
def select_s1_all(spark, sf):
    return S.select_s1(D.scenes(spark, sf)).select("scene_id", "orbit", "ts")


_LINKED = "SELECT p.*, s.cs FROM scene_pixels p LEFT JOIN scores s USING (scene_id)"


@query("link_scores", sql(_LINKED, "scene_pixels", "scores"))
def link_scores(spark, sf):
    return S.link_scores(D.scene_pixels(spark, sf), D.scores(spark, sf), ["scene_id"])


@query("mask_clouds", sql(f"SELECT scene_id, cx, cy, CASE WHEN cs >= 0.6 THEN B1 END AS B1, CASE WHEN cs >= 0.6 THEN B2 END AS B2, cs FROM ({_LINKED})", "scene_pixels", "scores"))
def mask_clouds(spark, sf):
    linked = S.link_scores(D.scene_pixels(spark, sf), D.scores(spark, sf), ["scene_id"])
    return S.mask_clouds(linked, ["B1", "B2"]).select("scene_id", "cx", "cy", "B1", "B2", "cs")


@query(
    "select_s2",
    sql(f"SELECT scene_id, cx, cy, ts, CASE WHEN cs >= 0.6 THEN B2 END AS B2, CASE WHEN cs >= 0.6 THEN round(B8 + 1e-9, 6) + 0.0 END AS B8, cs FROM ({_LINKED}) WHERE ts >= DATE '1996-01-01' AND ts < DATE '1999-06-01'", "scene_pixels", "scores"),
)
def select_s2(spark, sf):
    out = S.select_s2(D.scene_pixels(spark, sf), D.scores(spark, sf), ["scene_id"], _RANGE, bands=["cx", "cy", "B2", "B8"], masked_bands=["B1", "B2", "B8"])
    return rounded(out, "B8")


@query("select_bands", "SELECT l_orderkey AS scene_id, l_extendedprice AS B2 FROM lineitem")
def select_bands(spark, sf):
    return S.select_bands(D.scene_pixels(spark, sf), ["scene_id"], ["B2"], extra=())


@query("drop_missing", sql("SELECT scene_id, cx, cy, B1, B2 FROM scene_pixels WHERE B1 IS NOT NULL AND B2 IS NOT NULL AND B8 IS NOT NULL", "scene_pixels"))
def drop_missing(spark, sf):
    return S.drop_missing(D.scene_pixels(spark, sf)).select("scene_id", "cx", "cy", "B1", "B2")


_COUNTS = ", ".join(f"count(*) FILTER (ts >= DATE '{p.start}' AND ts < DATE '{p.end}') AS n_{i}" for i, p in enumerate(SCENE_PERIODS))
_ORBITS = f"SELECT orbit, {_COUNTS} FROM scenes GROUP BY 1"


@query("orbit_counts", sql(f"SELECT * FROM ({_ORBITS}) WHERE n_0 >= 5 AND n_1 >= 5", "scenes"))
def orbit_counts(spark, sf):
    return S.orbit_counts(D.scenes(spark, sf), SCENE_PERIODS)


@query("on_common_orbits", sql(f"SELECT scene_id, orbit FROM scenes WHERE orbit IN (SELECT orbit FROM ({_ORBITS}) WHERE n_0 >= 57 AND n_1 >= 57)", "scenes"))
def on_common_orbits(spark, sf):
    s = D.scenes(spark, sf)
    return S.on_common_orbits(s.select("scene_id", "orbit"), s, SCENE_PERIODS, minimum=57)


_QUALIFY = f"""SELECT qk, orbit, DATE '{SCENE_PERIODS[0].start}' AS start_pre, DATE '{SCENE_PERIODS[1].start}' AS start_post FROM (
  SELECT CAST(scene_id % 4 AS VARCHAR) AS qk, orbit, {_COUNTS} FROM scenes GROUP BY 1, 2) WHERE n_0 >= 5 AND n_1 >= 5"""


@query("qualifying_orbits_per_tile", sql(_QUALIFY, "scenes"))
def qualifying_orbits_per_tile(spark, sf):
    s = D.scenes(spark, sf).withColumn("qk", (F.col("scene_id") % 4).cast("string"))
    return inference.qualifying_orbits(s, SCENE_PERIODS[:1], SCENE_PERIODS[1:])


_POINTS = "SELECT c_custkey AS unosat_id, CAST(c_custkey % 100 AS INT) AS cx, CAST(c_custkey // 10 % 100 AS INT) AS cy FROM customer"


def _points(spark, sf):
    key = F.col("c_custkey")
    return read(spark, sf, "customer").select(
        key.alias("unosat_id"), (key % 100).cast("int").alias("cx"), (F.floor(key / 10) % 100).cast("int").alias("cy")
    )


@query("extract_points", sql(f"SELECT unosat_id, scene_id, ts, B1, B2 FROM ({_POINTS}) JOIN scene_pixels USING (cx, cy)", "scene_pixels"))
def extract_points(spark, sf):
    return S.extract_points(D.scene_pixels(spark, sf), _points(spark, sf), ["unosat_id"], ["scene_id", "ts"], ["B1", "B2"])


@query(
    "extract_points_3x3",
    sql(f"SELECT unosat_id, scene_id, round(avg(B1) + 1e-9, 6) + 0.0 AS B1, round(avg(B2) + 1e-9, 6) + 0.0 AS B2 FROM ({_POINTS}) p JOIN scene_pixels s ON s.cx BETWEEN p.cx - 1 AND p.cx + 1 AND s.cy BETWEEN p.cy - 1 AND p.cy + 1 GROUP BY 1, 2", "scene_pixels"),
)
def extract_points_3x3(spark, sf):
    return S.extract_points(D.scene_pixels(spark, sf), _points(spark, sf), ["unosat_id"], ["scene_id"], ["B1", "B2"], 3, finish=D.r6)


@query("points_centre", sql("SELECT round(avg(lon) + 1e-9, 6) + 0.0 AS lon, round(avg(lat) + 1e-9, 6) + 0.0 AS lat FROM (SELECT DISTINCT floor(lon) AS lon, floor(lat) AS lat FROM buildings)", "buildings"))
def points_centre(spark, sf):
    b = D.buildings(spark, sf).select(F.floor("lon").cast("double").alias("lon"), F.floor("lat").cast("double").alias("lat"))
    return rounded(S.points_centre(b))


# ---- combining orbits


def _combine(how, expr):
    @query(f"combine_orbits_{how}", sql(f"SELECT unosat_id, start_post, round({expr} + 1e-9, 6) + 0.0 AS value FROM scored GROUP BY 1, 2", "scored"))
    def run(spark, sf):
        preds = D.scored(spark, sf).withColumnRenamed("classification", "value")
        return rounded(R.combine_orbits(preds, ["unosat_id", "start_post"], how))


for _how, _expr in {"mean": "avg", "max": "max", "min": "min", "median": "median"}.items():
    _combine(_how, f"{_expr}(classification)")


# ---- values


@query("quantise", sql("SELECT unosat_id, orbit, start_post, CAST(least(255, trunc(classification * 255)) AS SMALLINT) AS value FROM scored", "scored"))
def quantise(spark, sf):
    return D.scored(spark, sf).select("unosat_id", "orbit", "start_post", V.quantised(F.col("classification")).alias("value"))


@query("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf):
    return read(spark, sf, "events").select("event_id", V.json_value(F.col("props"), "$.k").alias("k"))


@query(
    "period_from_name",
    "SELECT DISTINCT CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 89 AS e FROM orders",
)
def period_from_name(spark, sf):
    d = F.to_date("o_orderdate")
    name = F.concat_ws("_", F.lit("pred"), d, F.date_add(d, 89), F.col("o_orderstatus"))
    s, e = V.period_text(F.concat(name, F.lit(".tif")))
    return read(spark, sf, "orders").select(s.alias("s"), e.alias("e")).distinct()


@query("nan_to_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders")
def nan_to_null(spark, sf):
    v = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    return readers.clean(read(spark, sf, "orders").select("o_orderkey", v.alias("v")))


# ---- models: a rule separates the rows, so every classifier has to find it


def _graded(spark, sf):
    """Orders by the digit of their priority, which a rule labels."""
    digit = F.substring("o_orderpriority", 1, 1).cast("double")
    return read(spark, sf, "orders").select("o_orderkey", digit.alias("a"), (digit * digit).alias("b")).withColumn("label", (F.col("a") <= 2).cast("int"))


_RULE = "SELECT o_orderkey, o_orderpriority < '3' AS damaged FROM orders"


def _decided(df):
    return df.select("o_orderkey", (F.col("classification") >= 0.5).alias("damaged"))


def _model(name, **kwargs):
    @query(f"classify_{name}", _RULE)
    def run(spark, sf):
        df = _graded(spark, sf)
        return _decided(M.classify(df, M.fit(df, ["a", "b"], M.make_classifier(name, 0, **kwargs))))


_model("random_forest", trees=50, min_leaf=3)
_model("svm", maxIter=100)
_model("boosted_trees", trees=5)


@query("train_on_both_splits", _RULE)
def train_on_both_splits(spark, sf):
    """Either split has one class only: the rule can be learnt from both."""
    df = _graded(spark, sf)
    model = M.fit(df.where("a <= 2"), ["a", "b"], M.make_classifier("random_forest", 0, trees=10), df.where("a > 2"))
    return _decided(M.classify(df, model))


class Step:
    """A fixed model: 0.75 where a feature reaches a value, else 0.25; null features give no score."""

    def __init__(self, feature, at):
        self.feature, self.at = feature, at

    def transform(self, df):
        p = F.when(F.col(self.feature) >= self.at, 0.75).otherwise(0.25)
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def _area_pixels(spark, sf):
    pixels, scenes = D.scene_pixels(spark, sf), D.scenes(spark, sf).select("scene_id", F.pmod("orbit", F.lit(2)).alias("orbit"))
    tasks = tasks_of(spark, pixels.count())
    pixels = pixels.repartition(tasks, "scene_id").join(scenes.repartition(tasks, "scene_id"), "scene_id")
    cx, cy = ((F.col(c) % 10).cast("int") for c in ("cx", "cy"))
    tile = F.concat(F.floor(cx / 5), F.floor(cy / 5))
    return pixels.select("scene_id", "orbit", "ts", "B2", tile.alias("qk"), cx.alias("cx"), cy.alias("cy"))


_AREA = """SELECT p.scene_id, s.orbit % 2 AS orbit, p.ts, B2, (cx % 10) // 5 || '' || (cy % 10) // 5 AS qk, cx % 10 AS cx, cy % 10 AS cy
  FROM scene_pixels p JOIN scenes s USING (scene_id)"""
_AT = 40_000


def _area_sql(size):
    """Scores of all tiles by the fixed model: smoothed per scene across tiles, then per orbit, then the mean of orbits."""
    h = size // 2
    periods = [*SCENE_PERIODS[:1], *_SCENE_POST]
    within = lambda p: f"ts >= DATE '{p.start}' AND ts < DATE '{p.end}'"
    counts = ", ".join(f"count(*) FILTER ({within(p)}) AS n_{i}" for i, p in enumerate(periods))
    seen = f"SELECT qk, orbit, {counts} FROM (SELECT DISTINCT qk, scene_id, orbit, ts FROM a) GROUP BY ALL"
    means = ", ".join(f"avg(B2) FILTER ({within(p)}) AS m_{i}" for i, p in enumerate(periods))
    any_period = " OR ".join(f"({within(p)})" for p in periods)
    rows = " UNION ALL ".join(
        f"SELECT qk, cx, cy, DATE '{p.start}' AS start_post, DATE '{p.end}' AS end_post, avg(CASE WHEN m_{i} >= {_AT} THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END) AS value"
        f" FROM f JOIN seen USING (qk, orbit) WHERE n_0 >= 5 AND n_{i} >= 5 GROUP BY ALL"
        for i, p in enumerate(periods) if i
    )
    smooth = (
        "SELECT p.qk, p.cx, p.cy, p.scene_id, p.orbit, p.ts, avg(q.B2) AS B2 FROM (SELECT DISTINCT qk, cx, cy, scene_id, orbit, ts FROM a) p"
        f" JOIN a q ON q.scene_id = p.scene_id AND q.orbit = p.orbit AND q.ts = p.ts AND abs(q.cx - p.cx) <= {h} AND abs(q.cy - p.cy) <= {h} GROUP BY ALL"
    )
    return f"WITH a AS MATERIALIZED ({_AREA}), seen AS ({seen}), g AS ({smooth if h else 'SELECT * FROM a'}), f AS (SELECT qk, orbit, cx, cy, {means} FROM g WHERE {any_period} GROUP BY ALL) SELECT qk, CAST(cx AS INT) AS cx, CAST(cy AS INT) AS cy, start_post, end_post, value FROM ({rows})"


def _area(size):
    @query("predict_area" if size == 1 else f"predict_area_{size}x{size}", sql(f"SELECT * FROM ({_area_sql(size)})", "scene_pixels", "scenes"))
    def run(spark, sf):
        """Features per cell and orbit, a fixed model, scores averaged over orbits."""
        cfg = RunConfig(s1_bands=["B2"], pre=SCENE_PERIODS[:1], post=_SCENE_POST, reducers=["mean"], window=[f"{size}x{size}"])
        pixels = _area_pixels(spark, sf)
        scenes = pixels.select("qk", "scene_id", "orbit", "ts").distinct()
        return inference.predict_area(pixels, scenes, Step(f"B2_post_{size}x{size}_mean", _AT), cfg, cfg.post)


_area(1)
_area(3)

_SCORED_RULE = f"""SELECT aoi, unosat_id, start_post, CAST(trunc(avg(CASE WHEN VH_post_1x1_mean >= 100 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END) * 255) AS INT) AS pred
  FROM ({features("obs", POINT, BANDS, ["mean"])}) GROUP BY ALL"""


@query("experiment_metrics", sql(f"SELECT * FROM ({experiment_sql(_SCORED_RULE)})", "obs", "point_labels"))
def experiment_metrics(spark, sf):
    """The steps of an experiment after training: scores of stored features, mean over orbits, labels, metrics."""
    cfg = RunConfig(post=POST, event_date=EVENT)
    preds = experiment.predict_points(T.period_features(D.obs(spark, sf), POINT, BANDS, PRE, POST, ["mean"]), Step("VH_post_1x1_mean", 100.0), D.point_labels(spark, sf))
    return rounded(experiment.evaluate_points(preds, cfg, 0.5))


@query("join_features_s2", sql(f"SELECT * FROM ({_N1}) JOIN ({_N2}) USING (aoi, unosat_id, start_pre, start_post)", "obs"))
def join_features_s2(spark, sf):
    """Two windows of a sensor without orbits."""
    keys = ["aoi", "unosat_id"]
    one = T.period_features(D.obs(spark, sf), keys, BANDS, PRE, POST, ["mean"])
    two = T.period_features(D.obs(spark, sf), keys, ["VH"], PRE, POST, ["max"], "3x3")
    return rounded(T.join_features(one, two, ["VH_post_1x1_mean"], ["VH_post_3x3_max"]))


@query("join_features_two_pre", sql(f"SELECT * FROM ({_P1}) JOIN ({_P2}) USING (aoi, unosat_id, orbit, start_pre, start_post)", "obs"))
def join_features_two_pre(spark, sf):
    """Two windows before the event: pairs do not mix."""
    one = T.period_features(D.obs(spark, sf), POINT, BANDS, _TWO_PRE, POST, ["mean"])
    two = T.period_features(D.obs(spark, sf), POINT, ["VH"], _TWO_PRE, POST, ["max"], "3x3")
    return rounded(T.join_features(one, two, ["VV_pre_1x1_mean"], ["VH_post_3x3_max"]))
