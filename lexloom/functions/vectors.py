"""Vector arithmetic on array<double>, without Python in the row path."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def dot(x: Column | str, y: Column | str) -> Column:
    return _sum(F.zip_with(_col(x), _col(y), lambda a, b: a * b))


def norm(x: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_col(x), lambda a: a * a)))


def cosine_similarity(x: Column | str, y: Column | str) -> Column:
    """x·y / (‖x‖‖y‖); 0 where either vector is all zeros or the quotient is not a number.

    Null where a vector is null, holds a null or is not as long as the other.
    """
    product = dot(x, y)
    lengths = norm(x) * norm(y)
    quotient = F.when(lengths == 0.0, F.lit(0.0)).otherwise(F.nanvl(product / lengths, F.lit(0.0)))
    return F.when(product.isNotNull(), quotient)


def cosine_distance(x: Column | str, y: Column | str) -> Column:
    return F.lit(1.0) - cosine_similarity(x, y)


def euclidean_distance(x: Column | str, y: Column | str) -> Column:
    return F.sqrt(_sum(F.zip_with(_col(x), _col(y), lambda a, b: (a - b) * (a - b))))


def to_vector(x: Column | str) -> Column:
    """Array of numbers → dense ML vector. Nulls must be filtered out before."""
    return array_to_vector(_col(x).cast("array<double>"))
