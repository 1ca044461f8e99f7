"""Scoring of new pairs: clean, featurise, predict, name the outcome."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinscope.operators import prepare
from twinscope.operators.features import FEATURES, clean_pairs, pair_features
from twinscope.plans import forest, models


def scoring_features(
    df: DataFrame, left: str = "question1", right: str = "question2", key: str = "id", lemmas: DataFrame | None = None
) -> DataFrame:
    """Features of new pairs; a missing text counts as empty, no pair is dropped."""
    cleaned = clean_pairs(df, left, right, key, lemmas, drop_nulls=False)
    return prepare.repair(pair_features(cleaned, left, right), FEATURES)


def fit_scorer(features: DataFrame, label: str, trees: int = 300) -> PipelineModel:
    """Forest on the raw features, with its assembler, as one saveable model."""
    train = features.select(F.col(label).cast("double").alias("label"), *FEATURES)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    return PipelineModel(stages=[assembler, forest.fit(assembler.transform(train).select("label", "features"), trees)])


def score_pairs(
    df: DataFrame,
    model: PipelineModel,
    left: str = "question1",
    right: str = "question2",
    key: str = "id",
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """``(key, prediction_text, probability)`` for every pair."""
    out = model.transform(scoring_features(df, left, right, key, lemmas))
    return out.select(
        key,
        F.when(F.col("prediction") == 1, "duplicate").otherwise("not duplicate").alias("prediction_text"),
        models.vector_to_array("probability")[1].alias("probability"),
    )
