"""Row-level operators: which columns and rows go on."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import without_words


def complete_rows(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Drop columns (absent names are fine), then rows with a null in any column left."""
    return df.drop(*drop).na.drop("any")


def with_marker(df: DataFrame, column: str, marker: str) -> DataFrame:
    """Rows whose text holds `marker`; a Parquet scan gets the filter."""
    return df.filter(F.col(column).contains(marker))


def among(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is listed; null is never listed."""
    return df.filter(F.col(column).isin(*values))


def within(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows from `low` to `high`, both included."""
    return df.filter(F.col(column).between(low, high))


def min_tokens(df: DataFrame, tokens: str, n: int = 2) -> DataFrame:
    """Rows with at least `n` tokens."""
    return df.filter(F.size(tokens) >= n)


def exact_length(df: DataFrame, array: str, n: int) -> DataFrame:
    """Rows whose array has exactly `n` values."""
    return df.filter(F.size(array) == n)


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column, how many values are null or hold the text NULL or null.

    The text test is made on string columns only; no number or date is written that way.
    """

    def missing(name: str, data_type: str) -> Column:
        c = F.col(f"`{name}`")
        test = c.isNull()
        if data_type == "string":
            test = test | c.contains("NULL") | c.contains("null")
        return F.count(F.when(test, 1)).alias(name)

    return df.agg(*[missing(name, data_type) for name, data_type in df.dtypes])


def group_counts(df: DataFrame, keys: Sequence[str], counted: str) -> DataFrame:
    """Rows per group with a value in `counted`; a null group counts 0 of its own key."""
    return df.groupBy(*keys).agg(F.count(counted).alias("n"))


def with_tokens(
    df: DataFrame,
    tokens: Column,
    output: str = "tokens",
    min_length: int = 1,
    stop_words: Iterable[str] = (),
    min_count: int = 2,
    case_sensitive: bool = False,
) -> DataFrame:
    """Add a token column and keep rows with at least `min_count` tokens.

    `tokens` is any expression giving an array of tokens, such as `tokenise(text)` or
    `clean_tokens(array)`. Short tokens go first, listed words next, in any case; where the
    tokens and the list are known to be lower-case, `case_sensitive` saves work.
    The array is made by `explode` of a one-element array, which adds no row: a filter
    cannot move below `explode`, so the text is not split a second time inside the filter
    on the number of tokens.
    """
    if min_length > 1:
        tokens = F.filter(tokens, lambda t: F.length(t) >= min_length)
    kept = without_words(tokens, stop_words, case_sensitive)
    made = df.withColumn(output, F.explode(F.array(kept)))
    return min_tokens(made, output, min_count)
