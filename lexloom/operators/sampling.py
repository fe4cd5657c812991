"""Sampling, splitting and uniting slices. Every draw takes a seed.

With `key`, a draw depends on the key's value and the seed alone: it is the same after a
lost executor, on another cluster and in another file layout. Rows sharing a key value
share its fate, so `key` should be unique. Draws of different kinds are independent, also
with one seed: a sample can be split. Without `key`, Spark's own samplers are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions.randomness import bucket, poisson_copies


def sample(df: DataFrame, fraction: float, seed: int, key: Sequence[str] = ()) -> DataFrame:
    """Sample without replacement."""
    if key:
        return df.filter(bucket(*key, purpose="sample", seed=seed) < F.lit(fraction))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_with_replacement(
    df: DataFrame, fraction: float, seed: int, key: Sequence[str] = ()
) -> DataFrame:
    """Sample with replacement; keyed copies are told apart by the column `copy`."""
    if key:
        copies = poisson_copies(bucket(*key, purpose="copies", seed=seed), fraction)
        numbers = F.when(copies > 0, F.sequence(F.lit(1), copies))
        return df.withColumn("copy", F.explode(numbers))
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def sample_slices(
    df: DataFrame,
    slice_column: str,
    fractions: Mapping[object, float],
    rest: float,
    seed: int,
    key: Sequence[str],
) -> DataFrame:
    """Sample each slice at its own rate, the unnamed ones at `rest`, in one scan."""
    rate = F.lit(rest)
    for value, fraction in fractions.items():
        rate = F.when(F.col(slice_column).eqNullSafe(F.lit(value)), F.lit(fraction)).otherwise(rate)
    return df.filter(bucket(*key, purpose="sample", seed=seed) < rate)


def union_slices(slices: Sequence[DataFrame]) -> DataFrame:
    """All rows of all slices; columns are matched by name."""
    return reduce(DataFrame.unionByName, slices)


def split(
    df: DataFrame, weights: Sequence[float], seed: int, key: Sequence[str] = ()
) -> list[DataFrame]:
    """Disjoint parts that together hold every row, sized by `weights`."""
    if not key:
        return df.randomSplit(list(weights), seed=seed)
    total, edges = float(sum(weights)), [0.0]
    for weight in weights:
        edges.append(edges[-1] + weight / total)
    edges[-1] = 1.0
    u = bucket(*key, purpose="split", seed=seed)
    return [df.filter((u >= F.lit(a)) & (u < F.lit(b))) for a, b in zip(edges, edges[1:])]


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first `n` rows in the given order, so that the limit picks the same rows always."""
    return df.orderBy(*order).limit(n)
