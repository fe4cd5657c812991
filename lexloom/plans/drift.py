"""How far the vectors of entities, and of all of them, moved between two periods."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions.vectors import cosine_distance, cosine_similarity, euclidean_distance
from lexloom.operators.pooling import pooled_elements, pooled_vector


def period_vectors(
    df: DataFrame,
    entity: str,
    vector: str,
    period: str,
    pre: tuple,
    during: tuple,
    dims: int,
    how: str = "max",
) -> DataFrame:
    """(entity, pre, during): pooled vectors of both periods, null where there are no rows.

    Both periods are pooled side by side in one scan and one shuffle, which also brings an
    entity's two vectors together: no join is needed. Both ends of a period are included.
    """
    rows = df.filter(F.size(vector) == dims).select(
        entity,
        vector,
        F.col(period).between(*pre).alias("_in_pre"),
        F.col(period).between(*during).alias("_in_during"),
    )
    pooled = (
        rows.filter(F.col("_in_pre") | F.col("_in_during"))
        .groupBy(entity)
        .agg(
            *pooled_elements(vector, dims, how, "_in_pre", "_pre_"),
            *pooled_elements(vector, dims, how, "_in_during", "_during_"),
        )
    )
    return pooled.select(
        entity,
        pooled_vector(dims, "_pre_").alias("pre"),
        pooled_vector(dims, "_during_").alias("during"),
    )


def joined_vectors(
    pre: DataFrame, during: DataFrame, entity: str, vector: str, how: str = "inner"
) -> DataFrame:
    """(entity, pre, during) from two tables with one pooled vector per entity each.

    Entities in one table only are left out, unless `how` asks for an outer join.
    """
    return pre.select(entity, F.col(vector).alias("pre")).join(
        during.select(entity, F.col(vector).alias("during")), entity, how
    )


def drift_by_entity(
    vectors: DataFrame, entity: str, entities: Iterable | None = None
) -> DataFrame:
    """(entity, similarity): cosine between the periods, for entities seen in both.

    Rows without an entity have none to compare.
    """
    if entities is not None:
        vectors = vectors.filter(F.col(entity).isin(*entities))
    in_both = F.col(entity).isNotNull() & F.col("pre").isNotNull() & F.col("during").isNotNull()
    return vectors.filter(in_both).select(
        entity, cosine_similarity("pre", "during").alias("similarity")
    )


def drift_overall(vectors: DataFrame, dims: int) -> DataFrame:
    """(euclidean_distance, cosine_distance) between the periods max-pooled over entities.

    Both are null if a period has no rows.
    """
    pooled = vectors.agg(
        *pooled_elements("pre", dims, prefix="_pre_"),
        *pooled_elements("during", dims, prefix="_during_"),
    )
    both = pooled.select(
        pooled_vector(dims, "_pre_").alias("pre"), pooled_vector(dims, "_during_").alias("during")
    )
    return both.select(
        euclidean_distance("pre", "during").alias("euclidean_distance"),
        cosine_distance("pre", "during").alias("cosine_distance"),
    )
