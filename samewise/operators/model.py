"""Gradient-boosted trees over pair features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.operators.features import FEATURES


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    learning_rate: float = 0.05
    max_depth: int = 6
    subsample: float = 0.8
    feature_share: float = 0.8
    seed: int = 42


def train(labelled_features: DataFrame, settings: Settings = Settings()) -> PipelineModel | None:
    """A fitted pipeline; None if the labels have a single class, which boosting cannot learn from."""
    if labelled_features.select("label").distinct().limit(2).count() < 2:
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="error")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=settings.trees, stepSize=settings.learning_rate, maxDepth=settings.max_depth,
        subsamplingRate=settings.subsample, featureSubsetStrategy=str(settings.feature_share), seed=settings.seed,
    )
    return Pipeline(stages=[assembler, trees]).fit(labelled_features.withColumn("label", F.col("label").cast("double")))


def score(model: PipelineModel | None, features: DataFrame) -> DataFrame:
    """s1, cid, score: the probability of a match (0 without a model)."""
    if model is None:
        return features.select("s1", "cid", F.lit(0.0).alias("score"))
    return model.transform(features).select("s1", "cid", vector_to_array("probability")[1].alias("score"))


def importances(spark: SparkSession, model: PipelineModel | None, most: int = 15) -> DataFrame:
    """Features with the largest gain-based importance."""
    values = model.stages[-1].featureImportances.toArray().tolist() if model else [0.0] * len(FEATURES)
    rows = sorted(zip(FEATURES, values, strict=True), key=lambda r: (-r[1], r[0]))[:most]
    return spark.createDataFrame(rows, "feature string, gain_importance double")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
