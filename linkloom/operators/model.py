"""Boosted trees on pair features, calibration, persistence."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decision import Decision, macro

SEED = 42
#: Equal rows travel as one part for so many of them, and as so many parts at most.
SHARED_FROM, SHARES = 100, 10
#: Weighted rows in a task of a tree's level: rounds are many and short.
ROWS_PER_TASK = 50_000


def train(rows: DataFrame, features: list[str], iterations: int = 40, depth: int = 5, step: float = 0.1, validation: str | None = None) -> PipelineModel:
    """A boosted-tree pipeline on label; with a boolean validation column rounds stop early on those rows. Every row counts: rows that are equal in all
    features travel as one with their number as weight."""
    weighted = condensed(rows, [*features, "label", *([validation] if validation else [])]).persist()
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, stepSize=step, subsamplingRate=0.9, seed=SEED, validationTol=1e-4, weightCol="weight")
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    try:
        parts = max(1, -(-weighted.count() // ROWS_PER_TASK))
        whole = [c for c in weighted.columns if c != "weight"]
        dealt = weighted.repartition(parts, *whole).sortWithinPartitions(*whole, "share")
        return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), trees]).fit(dealt)
    finally:
        weighted.unpersist()


def condensed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that are equal in columns as one, with column weight, their number. Many of them are dealt as up to SHARES parts of equal weight (column share),
    so that a round's subsample leaves out a part of them, as it does of single rows."""
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    shares = F.least(F.lit(SHARES), F.ceil(F.col("n") / SHARED_FROM)).cast("int")
    return counted.withColumn("share", F.explode(F.sequence(F.lit(1), shares))).select(*columns, "share", (F.col("n") / shares).alias("weight"))


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """rid, gid, source, p."""
    return model.transform(features).select("rid", "gid", "source", vector_to_array("probability")[1].alias("p"))


def importance(model: PipelineModel, features: list[str], top: int = 40) -> list[tuple[str, float]]:
    return sorted(zip(features, model.stages[-1].featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])[:top]


def _logit(p):
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def calibrators(scored: DataFrame) -> dict[str, object]:
    """none, isotonic and sigmoid, fitted on (p, label)."""
    one = VectorAssembler(inputCols=["x"], outputCol="features")
    iso = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="q").fit(scored.withColumn("label", F.col("label").cast("double")))
    platt = LogisticRegression(featuresCol="features", labelCol="label", regParam=1e-6).fit(one.transform(scored.withColumn("x", _logit(F.col("p")))))
    return {"none": None, "isotonic": iso, "sigmoid": platt}


def calibrate(kind: str, fitted, scored: DataFrame) -> DataFrame:
    if kind == "none":
        return scored
    if kind == "isotonic":
        return fitted.transform(scored).drop("p").withColumnRenamed("q", "p")
    out = fitted.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(scored.withColumn("x", _logit(F.col("p")))))
    return out.withColumn("p", vector_to_array("probability")[1]).drop("x", "features", "rawPrediction", "probability", "prediction")


def best_calibrator(scored: DataFrame, truth: DataFrame, entities: DataFrame) -> tuple[str, object, float]:
    """The calibrator whose scores give the best macro F0.5 at a threshold of 0.5."""
    tried = [(k, f, macro(calibrate(k, f, scored), truth, entities, Decision(threshold=0.5))) for k, f in calibrators(scored).items()]
    return max(tried, key=lambda x: x[2])


def save(model: PipelineModel, decision: Decision, features: list[str], path: str) -> None:
    """The model, and a bundle beside it, both through Spark's file systems."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps({"decision": asdict(decision), "features": features}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/bundle")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, Decision, list[str]]:
    bundle = json.loads(spark.read.text(f"{path}/bundle").first()[0])
    return PipelineModel.load(f"{path}/model"), Decision(**bundle["decision"]), bundle["features"]
