"""Latent topics by truncated singular value decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.svd import truncated_svd
from lexloom.operators.terms import fit_vocabulary, sliced_tfidf, term_rows, tfidf_rows
from lexloom.sources.staging import Staging

COLUMNS = ("concept", "rank", "term", "weight", "singular_value")


def _loadings(
    df: DataFrame, tokens: str, k: int, max_df: float, vocab: int, slice: str | None
) -> DataFrame:
    """(slice, concept, singular_value, term, weight): all weights of the concepts per slice.

    Without a slice the first column is a constant. Each document has a number of its own,
    and everything after that is one job for all slices.
    """
    part = slice or "_slice"
    own = F.lit(0).alias(part) if slice is None else F.col(f"`{slice}`")
    with Staging(df.sparkSession) as staging:
        docs = df.select(own, tokens, F.monotonically_increasing_id().alias("_doc"))
        docs = staging.write(docs, "topic-tokens")
        keys = [part, "_doc"]
        rows = term_rows(docs, keys, tokens)
        if slice is None:
            weighted = tfidf_rows(rows, fit_vocabulary(docs, tokens, max_df, vocab))
        else:
            # A row without a term stands for the document itself.
            alone = docs.select(*keys, F.lit(None).cast("string"), F.lit(1).cast("bigint"))
            # Read several times, and slow to make.
            rows = staging.write(rows.union(alone), "topic-terms")
            weighted = sliced_tfidf(rows, slice, max_df, vocab)
        entries = staging.write(weighted.select(*keys, "term", "weight"), "topic-entries")
        return truncated_svd(entries, k, part=part, row="_doc")


def term_loadings(df: DataFrame, tokens: str, k: int, max_df: float, vocab: int) -> DataFrame:
    """(concept, singular_value, term, weight): all weights of the concepts."""
    return _loadings(df, tokens, k, max_df, vocab, None).drop("_slice")


def topics(
    df: DataFrame,
    tokens: str,
    # The usual settings of this analysis.
    k: int = 10,
    terms: int = 8,
    max_df: float = 0.2,
    vocab: int = 8000,
    slice: str | None = None,
) -> DataFrame:
    """(concept, rank, term, weight, singular_value), per value of `slice` if one is named.

    The terms of highest weight per concept, ranked; ties go by the alphabet. With slices each
    value, null and the empty text among them, is a corpus of its own with its own vocabulary,
    and the first column; all of them are decomposed in one job, so their number does not
    matter and a big one is no bottleneck. Without a term in the vocabulary there is no
    concept. The sign of a singular vector is arbitrary, so each is turned to make its largest
    weight in magnitude positive. The result is a table in the shared folder.
    """
    if slice is not None and df.isEmpty():
        raise ValueError("there are no rows, so there is no slice")
    found = _loadings(df, tokens, k, max_df, vocab, slice)
    keys = ["concept"] if slice is None else [slice, "concept"]
    order = Window.partitionBy(*keys).orderBy(F.desc("weight"), "term")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= terms)
    return ranked.select(*([] if slice is None else [slice]), *COLUMNS)
