"""Pair classifier: boosted trees over a feature set, entity-level hold-out, gains."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import BATCH


#: Settings of the two generations: rounds, depth, rows of a leaf, share of rows and of features of a tree.
CURRENT = {"rounds": 20, "depth": 6, "least": 50, "rows": 0.8, "columns": "0.9"}
OLDER = {"rounds": 300, "depth": 5, "least": 20, "rows": 1.0, "columns": "all"}


def train(
    pairs: DataFrame, features: list[str] = BATCH, rounds: int = 20, depth: int = 5, rate: float = 0.05, least: int = 20,
    rows: float = 0.8, columns: str = "0.9", validation: str | None = None,
):
    """A fitted pipeline; rows where ``validation`` is true only tell when to stop."""
    extra = {"validationIndicatorCol": validation} if validation else {}
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=rate, minInstancesPerNode=least,
        subsamplingRate=rows, featureSubsetStrategy=columns, seed=42, **extra,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), trees]).fit(pairs)


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str):
    return PipelineModel.load(path)


def score(model, pairs: DataFrame) -> DataFrame:
    return model.transform(pairs).withColumn("score", vector_to_array("probability")[1])


def auc(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(scored)


def importance(spark, model, features: list[str] = BATCH, most: int = 8) -> DataFrame:
    gains = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(features, gains, strict=True)), "feature string, gain double")
    return rows.orderBy(F.desc("gain"), "feature").limit(most)
