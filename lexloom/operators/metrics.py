"""Quality of predictions and clusters, as one-row tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): every metric below is computed from these few rows."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def f1_accuracy(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """(n, accuracy, f1): f1 is averaged over the labels by their number of rows."""
    cells = confusion(predictions, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("predicted"),
                    hit.cast("long").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    by_class = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    f1 = 2 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    return by_class.agg(
        F.sum("actual").alias("n"),
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        (F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1"),
    )


def metric_row(spark: SparkSession, **values: float) -> DataFrame:
    """Named numbers as a one-row table."""
    return spark.createDataFrame(pa.table({name: [value] for name, value in values.items()}))


def silhouette(df: DataFrame, cluster: str, features: str) -> DataFrame:
    """(silhouette): mean silhouette with squared Euclidean distance.

    Spark keeps sums per cluster and compares every row with those, not with other rows.
    """
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, distanceMeasure="squaredEuclidean"
    )
    return metric_row(df.sparkSession, silhouette=evaluator.evaluate(df))
