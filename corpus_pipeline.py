"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written to the shared
folder and read again as the next stage's documents. All but the last keep the columns of the
documents, whatever other columns there are. Null and empty texts, null keys and repeated rows
go through every stage; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import queries
from lexloom.llm.batches import quoted
from lexloom.llm.line_dedup import dedup_lines
from lexloom.llm.packing import pack, tokenized_pieces
from lexloom.llm.quality import fit_quality, quality_scores
from lexloom.llm.secrets import redact
from lexloom.llm.simhash import fingerprints, near_groups
from lexloom.sources import Staging, read_parquet, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _wrapped(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): what the operators read, and all other columns out of their way."""
    others = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("row"))


def _unwrapped(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again, n_chars with the length of the text as it is now."""

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        old = F.col("row")[name]
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.coalesce(F.length("text").cast(kind), old).alias(name)
        return old.alias(name)

    return made.select(*[column(name) for name in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet", ["doc_id", "quality"])
    field = fit_quality(docs, labels.filter(~queries.held_out()))
    scored = quality_scores(_wrapped(docs), field, keep=("doc_id", "text", "row"))
    kept = scored.filter(F.col("score") >= queries.GOOD_FROM)
    return _unwrapped(kept, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that occurred before."""
    return _unwrapped(dedup_lines(_wrapped(docs)), docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least doc_id.

    Near copies are what query 1 links: fingerprints of runs of three words that differ in at
    most three bits, directly or through others. Of rows that share the least doc_id one stays;
    a group without any doc_id keeps one of its rows.
    """
    wrapped = _wrapped(docs)
    prints = fingerprints(wrapped, queries.SIMHASH_SHINGLE, keep=("doc_id", "text", "row"))
    prints = stage(prints.withColumn("number", F.monotonically_increasing_id()), "simhash")
    keys = prints.select("number", "doc_id", "fingerprint")
    groups = near_groups(keys, queries.SIMHASH_RADIUS).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    chosen = groups.groupBy("component_root").agg(F.min("number").alias("number"))
    # The texts are the large side at any size: they are dealt by number, but not sorted.
    only = chosen.select("number").hint("shuffle_hash")
    return _unwrapped(prints.join(only, "number", "left_semi"), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return _unwrapped(redact(_wrapped(docs)), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of the packed pieces."""
    path = public_tokenizers.path(queries.PACK_FILE)
    pieces = tokenized_pieces(docs, path, queries.SEQUENCE_TOKENS, queries.PACK_END_ID)
    return pack(pieces, queries.SEQUENCE_TOKENS, numbered=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("secrets", secrets),
    ("packing", packing),
]

# The classifier's weights and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each stage's table goes after the next one."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    with Staging(spark) as staging:
        before = None
        for name, function in STAGES[:-1]:
            docs = staging.write(function(spark, docs, sf_dir), name)
            if before is not None:
                staging.drop(before)
            before = docs
        return stage(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
