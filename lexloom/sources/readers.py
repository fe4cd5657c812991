"""Scans: Parquet, CSV and word lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCAN_PARTITIONS = "spark.lexloom.scanPartitions"


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan one file, several files or a directory; only `columns` are read."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    escape: str = '"',
) -> DataFrame:
    """Scan CSV with a header line.

    Without a schema every column is a nullable string. Quoted fields may hold line
    breaks and doubled quotes. A multi-line file cannot be split, so a corpus of few huge
    files should either be known to have no line breaks (`multi_line=False`) or be
    converted to Parquet once.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape=escape)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as a table with the column `word`."""
    word = F.trim("value")
    return spark.read.text(path).select(word.alias("word")).filter(F.length("word") > 0)


def with_slice(df: DataFrame, name: str = "slice") -> DataFrame:
    """Add the path of the input file each row came from. Use directly on a scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan over the number of partitions that the session names, if it names one.

    A table of few row groups is read by few tasks, whatever the split size; where that is
    known to matter, set `spark.lexloom.scanPartitions`. Without it the scan is left as it is.
    """
    named = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(named)) if named else df
