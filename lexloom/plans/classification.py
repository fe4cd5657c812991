"""Predicting the group of a document from its tf-idf features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators.metrics import f1_accuracy
from lexloom.operators.sampling import split
from lexloom.operators.terms import fit_vocabulary, tfidf_vectors
from lexloom.sources.staging import stage


def _classifier(name: str, parallelism: int):
    columns = {"featuresCol": "features", "labelCol": "label_index"}
    if name == "nb":
        return NaiveBayes(predictionCol="predicted_index", **columns)
    if name == "svm":
        # The settings of the linear support vector machine.
        svm = LinearSVC(maxIter=10, regParam=0.1)
        return OneVsRest(
            classifier=svm, predictionCol="predicted_index", parallelism=parallelism, **columns
        )
    raise ValueError(f"unknown model {name!r}: use 'nb' or 'svm'")


@dataclass(frozen=True)
class Classified:
    """A fitted model and the test rows with their label and prediction, both as text."""

    model: PipelineModel
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        return f1_accuracy(self.predictions, "label", "prediction")


def classify(
    df: DataFrame,
    label: str,
    tokens: str,
    model: str = "nb",
    keys: Sequence[str] = (),
    labels: Iterable | None = None,
    # The usual settings of this analysis.
    weights: Sequence[float] = (0.75, 0.25),
    seed: int = 1,
    max_df: float = 0.5,
    vocab: int = 5000,
    parallelism: int = 4,
) -> Classified:
    """Fit on one part of the rows and predict the other.

    With `keys` the parts are drawn by the key, so the same rows are trained on in every
    run. Rows without a label, or with one not among `labels`, are left out first.
    """
    df = df.filter(F.col(label).isNotNull())
    if labels is not None:
        df = df.filter(F.col(label).isin(*labels))
    df = df.select(*keys, F.col(label).cast("string").alias("label"), tokens)
    vocabulary = fit_vocabulary(df, tokens, max_df, vocab)
    features = tfidf_vectors(df, tokens, vocabulary).select(*keys, "label", "features")
    features = stage(features, "class-features")
    indexer = StringIndexer(inputCol="label", outputCol="label_index").fit(features)
    train, test = split(features, weights, seed, keys)
    back = IndexToString(
        inputCol="predicted_index", outputCol="prediction", labels=indexer.labels
    )
    fitted = Pipeline(stages=[indexer, _classifier(model, parallelism), back]).fit(train)
    predictions = fitted.transform(test).select(*keys, "label", "prediction")
    return Classified(model=fitted, predictions=predictions)
