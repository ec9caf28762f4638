"""Text classification from labelled texts: words, hashed counts, inverse document frequency, naive Bayes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 16


def body(text: str = "text"):
    """The text of a mail without its header lines; a text without an empty line stays whole."""
    return F.regexp_replace(F.col(text), r"(?s)\A(?:[^\r\n]+\r?\n)+\r?\n", "")


def train(rows: DataFrame, features: int = FEATURES, text: str = "text", label: str = "label") -> PipelineModel:
    """Model of rows (text, label); rows without a label take no part, a null text is empty.

    What is gathered is one number for each label and hashed word. Equal rows weigh as often as they occur; other columns are not read.
    """
    able = rows.select(F.coalesce(F.col(text), F.lit("")).alias("text__"), F.col(label).alias("label__")).filter("label__ is not null")
    labels = StringIndexer(inputCol="label__", outputCol="number__", stringOrderType="alphabetAsc").fit(able)
    stages = [
        labels, RegexTokenizer(inputCol="text__", outputCol="words__", pattern=r"[\p{L}\p{N}']+", gaps=False), HashingTF(inputCol="words__", outputCol="counts__", numFeatures=features),
        IDF(inputCol="counts__", outputCol="weights__"), NaiveBayes(featuresCol="weights__", labelCol="number__", predictionCol="found__", rawPredictionCol="raw__", probabilityCol="likely__"),
        IndexToString(inputCol="found__", outputCol="prediction", labels=labels.labels),
    ]
    return Pipeline(stages=stages).fit(able)


def predict(model: PipelineModel, rows: DataFrame, text: str = "text") -> DataFrame:
    """rows with ``prediction``, a label of the training; the label of the rows themselves is not read."""
    ready = PipelineModel(model.stages[1:])  # without the stage that numbers the labels
    return ready.transform(rows.withColumn("text__", F.coalesce(F.col(text), F.lit("")))).select(*rows.columns, "prediction")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)


def accuracy(predicted: DataFrame, label: str = "label") -> DataFrame:
    """rows, right, majority: how many rows, how many with their own label as prediction, and how many have the most frequent label."""
    by = predicted.groupBy(label).agg(F.count("*").alias("n"), F.count_if(F.col(label) == F.col("prediction")).alias("right"))
    return by.agg(F.sum("n").alias("rows"), F.sum("right").alias("right"), F.max("n").alias("majority"))
