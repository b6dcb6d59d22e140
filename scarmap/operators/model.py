"""Classifiers: choose, train, store, apply."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _forest(seed, trees=50, min_leaf=3, max_depth=30, **kwargs):
    return RandomForestClassifier(
        numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=max_depth, seed=seed,
        featureSubsetStrategy="sqrt", subsamplingRate=0.5, cacheNodeIds=False, maxMemoryInMB=1024, **kwargs,
    )


def _svm(seed, **kwargs):
    return LinearSVC(**kwargs)


def _boosted(seed, trees=50, **kwargs):
    return GBTClassifier(maxIter=trees, seed=seed, **kwargs)


CLASSIFIERS = {"random_forest": _forest, "svm": _svm, "boosted_trees": _boosted}


def make_classifier(name: str, seed: int = 0, **kwargs):
    """Estimator by name; an unknown name is an error."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown model {name}")
    return CLASSIFIERS[name](seed, **kwargs).setLabelCol("label").setFeaturesCol("features")


def fit(features: DataFrame, names: list[str], classifier, extra: DataFrame | None = None) -> PipelineModel:
    """Train on ``features``, and on ``extra`` too if given. Rows with a missing feature are skipped."""
    columns = [*names, "label"]
    rows = features.select(*columns)
    if extra is not None:
        rows = rows.unionByName(extra.select(*columns))
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler, classifier]).fit(rows.withColumn("label", F.col("label").cast("double")))


def classify(df: DataFrame, model: PipelineModel, out: str = "classification") -> DataFrame:
    """Adds the probability of class 1; a margin-only model is mapped by the logistic curve.

    Every row is returned; the score is null where a feature of the model is missing (``unscored`` counts those).
    """
    keeping = model.copy() if hasattr(model, "stages") else model
    needed = []
    for stage in getattr(keeping, "stages", []):
        if isinstance(stage, VectorAssembler):
            stage.setHandleInvalid("keep")
            needed += stage.getInputCols()
    scored = keeping.transform(df)
    if "probability" in scored.columns:
        # a model trained on class 0 alone has no entry for class 1
        p = F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0))
    else:
        p = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in needed], F.lit(False))
    return scored.select(*df.columns, F.when(~missing, p).alias(out))


def unscored(scored: DataFrame, out: str = "classification") -> int:
    """How many rows have no score."""
    return scored.where(F.col(out).isNull()).count()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_fit(path: str, train, spark) -> PipelineModel:
    """The stored model, or the result of ``train()`` after storing it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        save_model(train(), path)
    return load_model(path)
