"""Sentiment of whole texts with Spark ML: features, training, scoring, evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.columns import LABEL_TO_ID, decode

FEATURES = 1 << 14


def feature_stages(text: str = "text", features: int = FEATURES, min_documents: int = 2) -> list:
    """Lower-cased words, hashed counts, inverse document frequency; memory is bounded by ``features``."""
    return [
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\W+", toLowercase=True),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features", minDocFreq=min_documents),
    ]


def text_features(df: DataFrame, text: str = "text", features: int = FEATURES) -> DataFrame:
    return Pipeline(stages=feature_stages(text, features)).fit(df).transform(df)


def train_text(
    df: DataFrame,
    text: str = "text",
    label: str = "label",
    max_iter: int = 20,
    reg: float = 0.01,
    features: int = FEATURES,
) -> PipelineModel:
    classifier = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        probabilityCol="probability",
        family="multinomial",
        maxIter=max_iter,
        regParam=reg,
    )
    return Pipeline(stages=[*feature_stages(text, features), classifier]).fit(df)


def score_text(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the id and the name of the most likely label."""
    scored = model.transform(df).drop("words", "counts", "features", "rawPrediction", "probability")
    predicted = F.col("prediction").cast("int")
    return scored.withColumn("prediction", predicted).withColumn("predicted", decode(predicted, LABEL_TO_ID))


def train_history(model: PipelineModel) -> DataFrame:
    """Loss per training round, as many rows as rounds."""
    losses = model.stages[-1].summary.objectiveHistory
    rows = [(i, float(loss)) for i, loss in enumerate(losses)]
    return SparkSession.active().createDataFrame(rows, "round int, loss double")
