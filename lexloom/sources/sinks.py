"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lexloom.sources.staging import shuffles_removed


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, written so that `read_csv` gives every field back.

    Blanks around a text are kept. CSV cannot tell an empty text from null: `read_csv` gives
    null for both.
    """
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with shuffles_removed(df.sparkSession):
        df.write.mode("append").options(header=True, escape='"', **options).csv(path)


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """Parquet, one directory per value of `by`, so that a filter on it reads only its own."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
