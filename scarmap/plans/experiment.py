"""Point experiment: series -> features -> model -> predictions -> metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.cluster import checked_broadcast
from scarmap.config import CLOUD_BAND, OBSERVED, RunConfig
from scarmap.operators import evaluate as E
from scarmap.operators import labels as L
from scarmap.operators import model as M
from scarmap.operators import scenes as S
from scarmap.operators import series as T
from scarmap.sources import readers as R
from scarmap.sources import writers as W


@dataclass(frozen=True)
class Store:
    """Folders of one project."""

    root: str

    @property
    def observations(self) -> str:
        return f"{self.root}/observations"

    def model(self, cfg: RunConfig) -> str:
        return f"{self.root}/models/{cfg.run_id}"

    def predictions(self, cfg: RunConfig) -> str:
        return f"{self.root}/preds/{cfg.run_id}"


def build_series_s1(scenes, pixels, points, bands, size=1, period=OBSERVED) -> DataFrame:
    """Series of every labelled point and qualifying scene; gaps take the mean of their cell."""
    chosen = S.select_s1(scenes, period).select("scene_id", "ts", "orbit")
    seen = S.pixels_around(pixels, points, size).join(checked_broadcast(chosen), "scene_id")
    filled = T.fill_gaps(seen, ["cx", "cy", "orbit"], bands)
    return S.extract_points(filled, points, ["aoi", "unosat_id", "damage", "date"], ["scene_id", "orbit", "ts"], bands, size)


def build_series_s2(pixels, scores, points, bands, size=1, period=OBSERVED) -> DataFrame:
    """Cloud-masked series; dates without the three marker bands are dropped."""
    pixels, scores = (S.pixels_around(df, points, size) for df in (pixels, scores))
    clear = S.select_s2(pixels, scores, ["scene_id", "cx", "cy"], period, bands=bands, masked_bands=bands)
    series = S.extract_points(clear, points, ["aoi", "unosat_id", "damage", "date"], ["scene_id", "ts"], [*bands, CLOUD_BAND], size)
    return S.drop_missing(series)


def build_features(obs: DataFrame, labels: DataFrame, cfg: RunConfig, sat: str, window: str, orbits: DataFrame | None = None) -> DataFrame:
    """Training rows of one sensor: every kept label x orbit x period pair."""
    points = L.keep_damage(labels, cfg.damages)
    keys = ["aoi", "unosat_id", *([] if orbits is None else ["orbit"])]
    bands = [b for b in cfg.bands if (b in ("VV", "VH")) == (sat == "s1")]
    count = None if sat == "s1" else "n_tiles"
    feats = T.period_features(L.keep_damage(obs, cfg.damages), keys, bands, cfg.pre, cfg.post, cfg.reducers, window, count)
    return L.labelled_features(points, feats, cfg.pre, cfg.post, cfg.event_date, orbits)


def write_split(store: Store, features: DataFrame, cfg: RunConfig, sat: str, window: str, split: str) -> str:
    """Stores the rows of one split (train or test areas)."""
    aois = cfg.aois_train if split == "train" else cfg.aois_test
    return W.write_features(L.keep_aoi(features, aois), store.root, sat, window, cfg.post, split)


def load_split(spark: SparkSession, store: Store, cfg: RunConfig, split: str) -> DataFrame:
    """Stored features of the sensors in use; two sensors are joined."""
    tables = [R.scan_features(spark, store.root, s, split, cfg.period_name, cfg.window) for s in cfg.sensors.split("_")]
    return tables[0] if len(tables) == 1 else T.join_sensors(*tables)


def train(spark: SparkSession, store: Store, cfg: RunConfig):
    classifier = M.make_classifier(cfg.model_name, cfg.seed, **cfg.model_kwargs)
    extra = load_split(spark, store, cfg, "test") if cfg.train_on_all else None
    return M.fit(load_split(spark, store, cfg, "train"), cfg.features, classifier, extra)


def load_or_train(spark: SparkSession, store: Store, cfg: RunConfig):
    return M.load_or_fit(store.model(cfg), lambda: train(spark, store, cfg), spark)


def predict_points(features: DataFrame, model, labels: DataFrame) -> DataFrame:
    """Predictions per point and window, the mean over orbits, with the date and class of the label."""
    return L.attach_labels(E.point_predictions(M.classify(features, model)), labels, ["date", "damage"])


def evaluate_points(preds: DataFrame, cfg: RunConfig, threshold: float = 0.5) -> DataFrame:
    """One row of counts and metrics of stored predictions."""
    rows = E.judged(preds, [p.start for p in cfg.post], event=cfg.event_date, positive_year=cfg.event_date.year)
    return E.with_metrics(E.confusion(rows, threshold))


def run_experiment(spark: SparkSession, store: Store, labels: DataFrame, cfg: RunConfig, threshold: float = 0.5, again: bool = False) -> DataFrame:
    """One row of counts and metrics on the test areas. Stored models and predictions of the run are used again, unless ``again``."""
    path = store.predictions(cfg)
    if again or not R.exists(spark, f"{path}/_SUCCESS"):
        model = load_or_train(spark, store, cfg)
        predict_points(load_split(spark, store, cfg, "test"), model, labels).write.mode("overwrite").parquet(path)
    return evaluate_points(spark.read.parquet(path), cfg, threshold)


def dataset_size(features: DataFrame) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("n"))
