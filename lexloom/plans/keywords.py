"""Characteristic terms of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.terms import (
    group_term_rows,
    group_term_stats,
    select_vocabulary,
    sliced_tfidf,
    tfidf_rows,
)
from lexloom.sources.staging import stage


def group_keywords(
    df: DataFrame,
    group: str,
    tokens: str,
    # The usual settings of this analysis.
    max_df: float = 0.7,
    vocab: int = 3000,
    below: float | None = 3.0,
    top: int | None = None,
    slice: str | None = None,
) -> DataFrame:
    """(group, term, tf, weight): tf-idf over groups, all rows of a group being one document.

    With `slice` each of its values, null among them, is a corpus of its own, with its own
    vocabulary, and the first column. `below` keeps the terms whose weight is under it; `top`
    keeps that many terms of highest weight per group, ties in alphabetical order.
    """
    keys = [group] if slice is None else [slice, group]
    counts = stage(group_term_rows(df, keys, tokens), "group-terms")
    if slice is None:
        vocabulary = select_vocabulary(group_term_stats(counts), max_df, vocab)
        weights = tfidf_rows(counts, vocabulary)
    else:
        weights = sliced_tfidf(counts, slice, max_df, vocab)
    weights = weights.select(*keys, "term", "tf", "weight")
    if below is not None:
        weights = weights.filter(F.col("weight") < F.lit(below))
    if top is not None:
        order = Window.partitionBy(*keys).orderBy(F.desc("weight"), "term")
        weights = weights.withColumn("rank", F.row_number().over(order))
        weights = weights.filter(F.col("rank") <= top)
    return weights
