"""Clusters of documents and what they are made of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.sql import DataFrame

from lexloom.operators.metrics import silhouette
from lexloom.operators.rows import group_counts
from lexloom.operators.terms import fit_vocabulary, tfidf_vectors
from lexloom.sources.staging import stage


@dataclass(frozen=True)
class ClusterProfile:
    """A fitted clustering; `assigned` has the keys, the features and the cluster.

    The cluster is worked out again from the written features each time, which is less
    work than writing the features a second time.
    """

    model: BisectingKMeansModel
    assigned: DataFrame

    def clusters(self) -> DataFrame:
        return self.assigned.select("cluster").distinct()

    def composition(self, keys: Sequence[str]) -> DataFrame:
        """(cluster, keys…, n): rows per cluster and key, for every cluster at once."""
        return group_counts(self.assigned, ["cluster", *keys], keys[0])

    def quality(self) -> DataFrame:
        return silhouette(self.assigned, "cluster", "features")


def cluster_profile(
    df: DataFrame,
    tokens: str,
    keys: Sequence[str],
    # The usual settings of this analysis.
    k: int = 4,
    max_df: float = 0.5,
    vocab: int = 2000,
    seed: int = 1,
) -> ClusterProfile:
    """Cluster documents by tf-idf with bisecting k-means.

    Tokens are read twice, once for the vocabulary and once for the features. The features
    are written to the shared folder, as fitting reads them many times.
    """
    vocabulary = fit_vocabulary(df, tokens, max_df, vocab)
    features = stage(
        tfidf_vectors(df, tokens, vocabulary).select(*keys, "features"), "cluster-features"
    )
    fitted = BisectingKMeans(
        k=k, seed=seed, featuresCol="features", predictionCol="cluster"
    ).fit(features)
    return ClusterProfile(model=fitted, assigned=fitted.transform(features))
