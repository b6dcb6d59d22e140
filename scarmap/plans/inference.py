"""Country inference: pixels -> features per orbit -> scores -> one value per cell and window."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.cluster import checked_broadcast, settle
from scarmap.config import Period, RunConfig
from scarmap.functions.values import in_period, quantised
from scarmap.operators import model as M
from scarmap.operators import raster as R
from scarmap.operators import scenes as S
from scarmap.operators import series as T
from scarmap.operators.tiles import pending, with_neighbours
from scarmap.sources.readers import partition_values
from scarmap.sources import writers as W


def window_size(window: str | list[str]) -> int:
    """Cells per side of the one window that inference uses; features of several windows are refused."""
    names = [window] if isinstance(window, str) else list(window)
    sizes = {int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)x\1", n))}
    if len(names) != 1 or len(sizes) != 1 or not (size := sizes.pop()) % 2:
        raise ValueError(f"inference takes one window of an odd size, such as 3x3, not {window}")
    return size


def predict_area(
    pixels: DataFrame, scenes: DataFrame, model, cfg: RunConfig, post: list[Period], by=("qk",), orbits: list[int] | None = None
) -> DataFrame:
    """``by, cx, cy, start_post, end_post, value`` for all tiles and windows in one plan.

    An orbit takes part in a tile and window if it has enough images before and after; ``orbits`` names the
    orbits instead. Means over a window cross the borders of tiles: images are smoothed whole, and a cell keeps its
    tile. Rows are shuffled by cell once (and once before by block, if smoothed): statistics, scores and the mean over
    orbits follow in that stage. Only ``scenes`` is evaluated while the plan is built.
    """
    size = window_size(cfg.window)
    place = [*by, "cx", "cy"]
    # windows lie in one image, so images of no period are left out before anything is moved
    seen = R.any_of([in_period(F.col("ts"), p) for p in dict.fromkeys([*cfg.pre, *post])])
    pixels, usable = pixels.where(seen), None
    if orbits is not None:
        pixels = pixels.where(F.col("orbit").isin(list(orbits)))
    else:
        usable = settle(qualifying_orbits(scenes.where(seen), cfg.pre, post, by))
        # a neighbour tile may lack images of an orbit, but its cells belong to windows at the border
        early = ["orbit"] if size > 1 else [*by, "orbit"]
        pixels = pixels.join(checked_broadcast(usable.select(*early).distinct()), early, "left_semi")
    if size > 1:
        pixels = R.focal_mean(pixels, ["scene_id", "orbit", "ts"], cfg.bands, size // 2, payload=list(by))
    window = f"{size}x{size}"
    # the images of a period bound the rows of a cell: no group is hot
    feats = T.period_features(pixels, [*place, "orbit"], cfg.bands, cfg.pre, post, cfg.reducers, window, hot_rows=None, cluster_by=place)
    if usable is not None:
        feats = feats.join(checked_broadcast(usable), [*by, "orbit", "start_pre", "start_post"], "left_semi")
    return R.combine_orbits(M.classify(feats, model, "value"), [*place, "start_post", "end_post"], cfg.aggregation)


def qualifying_orbits(scenes: DataFrame, pre: list[Period], post: list[Period], by=("qk",)) -> DataFrame:
    """Orbits with enough images in both periods, per pair of periods."""
    keys = [*by, "orbit"]
    periods = list(dict.fromkeys([*pre, *post]))
    counts = S.orbit_counts(scenes, periods, keys, minimum=0)
    enough = [F.col(f"n_{i}") >= S.MIN_IMAGES_PER_ORBIT for i in range(len(periods))]
    pairs = [
        F.when(
            enough[periods.index(a)] & enough[periods.index(b)],
            F.struct(F.lit(a.start).alias("start_pre"), F.lit(b.start).alias("start_post")),
        )
        for a in pre
        for b in post
    ]
    return counts.select(*keys, F.explode(F.array_compact(F.array(*pairs))).alias("p")).select(*keys, "p.*")


def quantise(preds: DataFrame) -> DataFrame:
    """0..255 values with the partition columns of stored tiles."""
    period = F.concat_ws("_", F.col("start_post").cast("string"), F.col("end_post").cast("string"))
    return preds.select("qk", "cx", "cy", period.alias("period"), F.col("start_post").alias("post_date"), quantised(F.col("value")).alias("value"))


#: tiles that one job predicts
TILES_TOGETHER = 500
UNITS = "qk string, period string"


def finished(path: str) -> str:
    """Where a country run notes its finished (qk, period), with or without pixels. Spark reads pass it over."""
    return f"{path}/_finished"


def written_units(spark: SparkSession, path: str) -> DataFrame:
    """(qk, period) already stored or noted as finished; nothing if the folder does not exist yet. No prediction is read."""
    stored = [tuple(part.split("=", 1)[1] for part in name.split("/")) for name in partition_values(spark, path, 2)]
    units = spark.createDataFrame([(qk, period) for period, qk in stored], UNITS)
    folder = spark._jvm.org.apache.hadoop.fs.Path(finished(path))
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        units = units.unionByName(spark.read.schema(UNITS).parquet(finished(path)))
    return units.distinct()


def of_tiles(table: DataFrame, tiles: list[str]) -> DataFrame:
    """Rows of the given tiles, as literals: on a table partitioned by tile no other folder is read."""
    return table.where(F.col("qk").isin(tiles))


def predict_country(spark: SparkSession, pixels, scenes, tiles, model, cfg: RunConfig, path: str, orbits: list[int] | None = None) -> None:
    """Predicts and stores what is not finished yet: tiles that lack the same windows together, some at a time."""
    windows = F.explode(F.array(*[F.lit(str(p)) for p in cfg.post]))
    todo = pending(tiles.select("qk").distinct().withColumn("period", windows), written_units(spark, path), ["qk", "period"])
    lacking = todo.groupBy("qk").agg(F.sort_array(F.collect_set("period")).alias("periods"))
    groups: dict[tuple, list[str]] = {}
    for r in lacking.collect():  # one short row per tile
        groups.setdefault(tuple(r.periods), []).append(r.qk)
    for names, members in sorted(groups.items()):
        post = [p for p in cfg.post if str(p) in names]
        for i in range(0, len(members), TILES_TOGETHER):
            own = sorted(members)[i : i + TILES_TOGETHER]
            seen = own if window_size(cfg.window) == 1 else with_neighbours(own)
            preds = predict_area(of_tiles(pixels, seen), of_tiles(scenes, seen), model, cfg, post, orbits=orbits)
            W.write_pred_tiles(quantise(of_tiles(preds, own)), path)
            done = spark.createDataFrame([(qk, period) for qk in own for period in names], UNITS)
            done.coalesce(1).write.mode("append").parquet(finished(path))
