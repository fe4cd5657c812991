"""Terms: counts, vocabulary and tf-idf.

Counting needs no shuffle per document: a document's tokens sit in one row, so they are
sorted inside the row and counted there as runs. Only sums per term are shuffled, after
Spark has added them up on each task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.sources.staging import Staging


@dataclass(frozen=True)
class Vocabulary:
    """At most `size` terms, most frequent first, ties in alphabetical order."""

    n_docs: int
    terms: tuple[str, ...]
    ctf: tuple[int, ...]
    df: tuple[int, ...]

    @property
    def idf(self) -> list[float]:
        return [math.log((self.n_docs + 1.0) / (n + 1.0)) for n in self.df]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(term, term_id, ctf, df, idf)."""
        columns = {
            "term": pa.array(self.terms, pa.string()),
            "term_id": pa.array(range(len(self.terms)), pa.int32()),
            "ctf": pa.array(self.ctf, pa.int64()),
            "df": pa.array(self.df, pa.int64()),
            "idf": pa.array(self.idf, pa.float64()),
        }
        return spark.createDataFrame(pa.table(columns))


def drop_listed_terms(rows: DataFrame, words: DataFrame, term: str = "term") -> DataFrame:
    """Stop-word removal on term rows: no row whose term is listed, whatever its case.

    Spark sends the list to the executors when its size allows and shuffles otherwise.
    """
    listed = words.select(F.lower("word").alias("_listed")).distinct()
    return rows.join(listed, F.lower(F.col(term)) == F.col("_listed"), "left_anti")


def drop_listed_tokens(
    df: DataFrame, keys: Sequence[str], tokens: str, words: DataFrame, min_count: int = 1
) -> DataFrame:
    """(keys…, tokens): token arrays without the words of a list of any size, in any case.

    `keys` identify a row. Rows left with fewer than `min_count` tokens go, so those with none
    go always.
    """
    placed = df.select(*keys, F.posexplode(tokens).alias("_at", "_token"))
    kept = drop_listed_terms(placed, words, "_token").groupBy(*keys)
    parts = F.sort_array(F.collect_list(F.struct("_at", "_token")))
    made = kept.agg(F.transform(parts, lambda p: p["_token"]).alias(tokens))
    return made.filter(F.size(tokens) >= min_count)


def term_rows(df: DataFrame, keys: Sequence[str], tokens: str) -> DataFrame:
    """(keys…, term, tf): one row per distinct token of each input row, without a shuffle."""
    words = df.select(*keys, F.sort_array(tokens).alias("_s"))

    def start(word: Column, i: Column) -> Column:
        return F.when((i == 0) | (word != F.get(F.col("_s"), i - 1)), i)

    starts = F.filter(F.transform("_s", start), lambda i: i.isNotNull())
    runs = words.withColumn("_from", starts)
    ends = F.concat(F.slice("_from", 2, F.size("_from")), F.array(F.size("_s")))
    ends = F.when(F.size("_s") > 0, ends)
    pairs = F.zip_with(
        "_from", ends, lambda a, b: F.struct(a.alias("at"), (b - a).cast("long").alias("tf"))
    )
    runs = runs.select(*keys, "_s", F.explode(pairs).alias("_r"))
    return runs.select(*keys, F.get("_s", F.col("_r.at")).alias("term"), F.col("_r.tf").alias("tf"))


def group_term_rows(df: DataFrame, group: Sequence[str], tokens: str) -> DataFrame:
    """(group…, term, tf) with all rows of a group as one document.

    Counts are added up per (group, term) before and after the shuffle, so a group of any
    size is spread over its terms and no row ever holds a whole group. A row with a null
    term stands for the group itself.
    """
    marked = F.concat(F.col(tokens), F.array(F.lit(None).cast("string")))
    exploded = df.select(*group, F.explode(marked).alias("term"))
    return exploded.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(df: DataFrame, tokens: str) -> DataFrame:
    """(term, ctf, df): occurrences and documents per term, from one scan and one shuffle.

    Each document is sorted and each token laid beside the one before it, so a token
    counts as a document of its term where the two differ. One null is laid behind the
    last token: the row of the null term counts the documents, empty ones too. The tokens
    themselves must not be null.
    """
    nothing = F.array(F.lit(None).cast("string"))
    words = df.select(F.sort_array(tokens).alias("s"))
    laid = F.arrays_zip(
        F.concat(F.col("s"), nothing).alias("term"), F.concat(nothing, F.col("s")).alias("before")
    )
    pairs = words.select(F.explode(laid).alias("p")).select("p.*")
    first = F.col("before").isNull() | ~F.col("term").eqNullSafe(F.col("before"))
    return pairs.groupBy("term").agg(
        F.count(F.lit(1)).alias("ctf"), F.count_if(first).alias("df")
    )


def group_term_stats(rows: DataFrame) -> DataFrame:
    """(term, ctf, df) with groups as documents, from the rows of `group_term_rows`."""
    return rows.groupBy("term").agg(F.sum("tf").alias("ctf"), F.count(F.lit(1)).alias("df"))


def select_vocabulary(stats: DataFrame, max_df: float, size: int) -> Vocabulary:
    """Choose the vocabulary from (term, ctf, df) with its null-term row.

    `max_df` below 1 is a share of the documents, otherwise a number of documents. The
    statistics are written once, so the text behind them is read once; only the chosen
    terms reach the driver.
    """
    with Staging(stats.sparkSession) as staging:
        stats = staging.write(stats, "term-stats")
        counted = stats.filter(F.col("term").isNull()).select("df").collect()
        n_docs = counted[0].df if counted else 0
        most = max_df * n_docs if max_df < 1.0 else max_df
        chosen = (
            stats.filter(F.col("term").isNotNull() & (F.col("df") <= F.lit(float(most))))
            .orderBy(F.desc("ctf"), "term")
            .limit(size)
            .collect()
        )
    return Vocabulary(
        n_docs=n_docs,
        terms=tuple(r.term for r in chosen),
        ctf=tuple(r.ctf for r in chosen),
        df=tuple(r.df for r in chosen),
    )


def sliced_tfidf(
    rows: DataFrame, slice: str, max_df: float, size: int
) -> DataFrame:
    """Rows of `group_term_rows` with a vocabulary of their own per slice, and `weight`.

    `slice` is one of their grouping columns; documents are the groups of a slice. Everything
    is joins and aggregates over all slices at once, so their number does not matter.
    """
    stats = rows.groupBy(slice, "term").agg(
        F.sum("tf").alias("_ctf"), F.count(F.lit(1)).alias("_df")
    )
    sizes = stats.filter("term IS NULL").select(F.col(slice).alias("_of"), F.col("_df").alias("_n"))
    known = stats.filter("term IS NOT NULL").select(
        F.col(slice).alias("_slice"), F.col("term").alias("_term"), "_ctf", "_df"
    )
    most = F.col("_n") * max_df if max_df < 1.0 else F.lit(float(max_df))
    known = known.join(sizes, F.col("_slice").eqNullSafe(F.col("_of"))).filter(F.col("_df") <= most)
    order = Window.partitionBy("_slice").orderBy(F.desc("_ctf"), "_term")
    known = known.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size)
    idf = F.log((F.col("_n") + 1.0) / (F.col("_df") + 1.0))
    known = known.select("_slice", "_term", idf.alias("_idf"))
    same = F.col(slice).eqNullSafe(F.col("_slice")) & (F.col("term") == F.col("_term"))
    weighted = rows.join(known, same).withColumn("weight", F.col("tf") * F.col("_idf"))
    return weighted.drop("_slice", "_term", "_idf")


def fit_vocabulary(df: DataFrame, tokens: str, max_df: float, size: int) -> Vocabulary:
    return select_vocabulary(term_stats(df, tokens), max_df, size)


def tfidf_rows(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add `weight` = tf · ln((N + 1) / (df + 1)) to term rows; other terms are dropped.

    Spark knows the size of the vocabulary: it sends it to the executors below its broadcast
    threshold and shuffles both sides above it.
    """
    terms = vocabulary.to_frame(rows.sparkSession).select("term", "term_id", "idf")
    return rows.join(terms, "term").withColumn("weight", F.col("tf") * F.col("idf")).drop("idf")


def tfidf_vectors(
    df: DataFrame, tokens: str, vocabulary: Vocabulary, output: str = "features"
) -> DataFrame:
    """Add a sparse tf-idf vector.

    The idf is known from the vocabulary, so the counts are scaled by it in the same pass;
    no idf model is fitted.
    """
    if not vocabulary.terms:
        raise ValueError("no term is left in the vocabulary: raise max_df or check the tokens")
    counts = CountVectorizerModel.from_vocabulary(
        list(vocabulary.terms), inputCol=tokens, outputCol="_counts"
    )
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(vocabulary.idf), inputCol="_counts", outputCol=output
    )
    return scale.transform(counts.transform(df)).drop("_counts")
