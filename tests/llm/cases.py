"""Tables of awkward rows."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **extra):
    """Rows (number, text, …), with more columns of given values."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    from pyspark.sql import functions as F

    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


# Null, empty, blank, odd white space, special strings, combining marks, repeats, one long word.
TEXTS = [
    None,
    "",
    "   ",
    " \n a\n\n  b ",
    "<|endoftext|> a <|startoftext|><|endoftext|>",
    "don't 'tis it's",
    "é é 　x y \x1c z",
    "日本語 テスト 123 4567",
    "same text here",
    "same text here",
    "ab" * 20_000,
    "word " * 5_000,
]
