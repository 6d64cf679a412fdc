"""The price-move classifier: text features, scaling, a multinomial model, evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_stages(text: str, dimensions: int = 256) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=dimensions),
        IDF(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="unit"),
    ]


def scaler(column: str = "unit") -> StandardScaler:
    """Zero mean and unit variance per dimension; fit it on the training rows only."""
    return StandardScaler(inputCol=column, outputCol="features", withMean=True, withStd=True)


def fit_classifier(
    train: DataFrame, text: str = "title", label: str = "day_gain_24", rounds: int = 100
) -> PipelineModel:
    """Fit on rows labelled 0, 1 or 2; every stage learns from ``train`` alone."""
    usable = train.where(F.col(label).isin(0, 1, 2)).withColumn("label", F.col(label).cast("double"))
    model = LogisticRegression(family="multinomial", maxIter=rounds, regParam=1e-3)
    return Pipeline(stages=[*text_stages(text), scaler(), model]).fit(usable)


def predict(model: PipelineModel, rows: DataFrame, label: str = "day_gain_24") -> DataFrame:
    usable = rows.where(F.col(label).isin(0, 1, 2)).withColumn("label", F.col(label).cast("double"))
    return model.transform(usable)


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)


def confusion(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Counts per truth and prediction, with the share of the truth class."""
    counts = df.groupBy(truth, prediction).agg(F.count("*").alias("n"))
    totals = df.groupBy(truth).agg(F.count("*").alias("_of"))
    return counts.join(totals, truth).select(
        F.col(truth).alias("truth"),
        F.col(prediction).alias("prediction"),
        "n",
        (F.col("n") / F.col("_of")).alias("share"),
    )
