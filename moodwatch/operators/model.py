"""Sentiment model (M1-M7): whitespace tokens -> term frequency -> IDF ->
multinomial Naive Bayes, then the neutral band and label names.

All stages are Spark ML JVM transformers, so scoring stays out of Python.  The
feature step is ``HashingTF`` (no vocabulary on the driver, fixed vector width);
:mod:`moodwatch.operators.bayes` is the same model over exact terms, as tables.  The model is fitted or loaded once when
a query is defined, never per batch.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwatch.functions.constants import (LABEL_NAMES, LABEL_NEGATIVE, LABEL_NEUTRAL, LABEL_POSITIVE,
                                           NEUTRAL_THRESHOLD)
from moodwatch.operators.text import join_tokens, segment
from moodwatch.session import materialize

MODEL_INPUT = "comment_text"
NUM_FEATURES = 1 << 18


def model_input(df: DataFrame, text: str = "text", **seg) -> DataFrame:
    """T1 + T5: segment ``text`` and re-join with spaces into ``comment_text``."""
    return join_tokens(segment(df, text, "_tokens", **seg), "_tokens", MODEL_INPUT).drop("_tokens")


def sentiment_pipeline(smoothing: float = 1.0) -> Pipeline:
    """M1-M4 as one ML pipeline over ``comment_text`` and ``label``."""
    tok = Tokenizer(inputCol=MODEL_INPUT, outputCol="feature")
    tf = HashingTF(inputCol="feature", outputCol="tf", numFeatures=NUM_FEATURES)
    idf = IDF(inputCol="tf", outputCol="tfidf")
    nb = NaiveBayes(featuresCol="tfidf", labelCol="label", modelType="multinomial", smoothing=smoothing)
    return Pipeline(stages=[tok, tf, idf, nb])


def train(labelled: DataFrame, text: str = "text", **seg) -> PipelineModel:
    """M5: fit on ``(text, label)`` rows; label 0.0 positive, 1.0 negative.

    Each estimator of the pipeline scans its input again, so the segmented
    training rows are materialised once (checkpoint in the shared folder).
    """
    rows = materialize(model_input(labelled, text, **seg).select(MODEL_INPUT, "label"))
    return sentiment_pipeline().fit(rows)


def load(path: str) -> PipelineModel:
    """A saved pipeline (load once per query definition)."""
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, text: str = "text", **seg) -> DataFrame:
    """M1-M4: adds ``prediction``, ``p0``, ``p1``; intermediate vectors dropped."""
    scored = model.transform(model_input(df, text, **seg))
    p = vector_to_array("probability")
    out = scored.withColumn("p0", p[0]).withColumn("p1", p[1])
    return out.drop("feature", "tf", "tfidf", "rawPrediction", "probability", MODEL_INPUT)


def argmax_prediction(p0: str = "p0", p1: str = "p1") -> Column:
    """Class of the larger probability; ties go to class 0 (first maximum)."""
    return F.when(F.col(p1) > F.col(p0), F.lit(LABEL_NEGATIVE)).otherwise(F.lit(LABEL_POSITIVE))


def neutral_band(df: DataFrame, threshold: float = NEUTRAL_THRESHOLD, prediction: str = "prediction",
                 p0: str = "p0", p1: str = "p1") -> DataFrame:
    """M6: ``label`` = 2.0 when ``|p0 - p1| < threshold`` (strict), else the prediction.
    Without a ``prediction`` column the arg-max of (p0, p1) is used."""
    pred = F.col(prediction) if prediction in df.columns else argmax_prediction(p0, p1)
    band = F.abs(F.col(p0) - F.col(p1)) < F.lit(threshold)
    return df.withColumn("label", F.when(band, F.lit(LABEL_NEUTRAL)).otherwise(pred.cast("double")))


def label_name(col: str = "label") -> Column:
    """M7: 0.0 positive, 1.0 negative, 2.0 neutral."""
    (v0, n0), *rest = sorted(LABEL_NAMES.items())
    out = F.when(F.col(col) == F.lit(v0), F.lit(n0))
    for v, name in rest:
        out = out.when(F.col(col) == F.lit(v), F.lit(name))
    return out
