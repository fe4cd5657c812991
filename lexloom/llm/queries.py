"""The registered queries of the operators for training data, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, oracles
from lexloom.llm.chat import conversation_digests, format_conversations
from lexloom.llm.exact_top_k import exact_top_k
from lexloom.llm.licenses import known_licenses, license_scan
from lexloom.llm.line_dedup import dedup_lines
from lexloom.llm.neighbours import nearest_by_product
from lexloom.llm.packing import pack, tokenized_pieces
from lexloom.llm.quality import fit_quality, quality_scores
from lexloom.llm.repeats import periodic_runs, run_digests
from lexloom.llm.secrets import BASE_RULES, find_secrets, spans_text
from lexloom.llm.simhash import fingerprints, near_groups
from lexloom.llm.token_counts import token_counts
from lexloom.llm.whitening import whitened
from lexloom.sources import read_parquet, stage

# Parameters of the queries.
SIMHASH_SHINGLE, SIMHASH_RADIUS = 3, 3
SEQUENCE_TOKENS = 4096
PACK_FILE, PACK_END_ID = "word_bpe_49k.json", 1
FOLDS, GOOD_FROM = 5, 0.3
NEAREST, NEAREST_EVERY = 20, 20
TOP_K, TOP_K_EVERY = 5, 50
TOKEN_LIMIT = 512
WHITE_COMPONENTS = 32
COUNT_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet", columns)


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    prints = stage(fingerprints(docs, SIMHASH_SHINGLE), "simhash")
    groups = near_groups(prints, SIMHASH_RADIUS)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    path = public_tokenizers.path(PACK_FILE)
    pieces = tokenized_pieces(docs, path, SEQUENCE_TOKENS, PACK_END_ID)
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digested, SEQUENCE_TOKENS, numbered=True)


def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    found = license_scan(docs, known_licenses(spark))
    return found.select(
        "doc_id",
        F.array_join("whole", ",").alias("whole_text"),
        F.array_join("in_lines", ",").alias("in_lines"),
    )


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    labels = _table(spark, sf, "labels", "doc_id", "quality").filter(~held_out())
    scored = quality_scores(docs, fit_quality(docs, labels))
    predicted = (F.col("score") >= GOOD_FROM).cast("int")
    part = held_out().alias("held_out")
    return scored.select("doc_id", part, "score", predicted.alias("predicted"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    return token_counts(docs, public_tokenizers.path(COUNT_FILE), TOKEN_LIMIT)


def op6_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    return nearest_by_product(vectors, F.col("id") % NEAREST_EVERY == 0, NEAREST)


def op7_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    return exact_top_k(vectors, F.col("id") % TOP_K_EVERY == 0, TOP_K)


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    runs = F.transform("deleted_runs", lambda r: F.concat_ws("-", r["first"], r["last"]))
    sizes = F.transform("deleted_runs", lambda r: (r["last"] - r["first"] + 1).cast("bigint"))
    return dedup_lines(docs).select(
        "doc_id",
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n_deleted"),
        F.array_join(runs, ",").alias("deleted_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = find_secrets(_table(spark, sf, "documents", "doc_id", "text"))
    base = [rule.kind for rule in BASE_RULES]

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(spans_text(of(*base)).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    path = public_tokenizers.path(RANK_FILE)
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """`conversations`, and number -1: a question and an answer full of control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    return conversations.union(
        conversations.sparkSession.createDataFrame(rows, conversations.schema)
    )


def op11_chat(spark: SparkSession, sf: str) -> DataFrame:
    conversations = _table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    formatted = format_conversations(
        with_control_strings(conversations), public_tokenizers.path(COUNT_FILE)
    )
    return conversation_digests(stage(formatted, "chat"))


def looped_text():
    """The words of the text of `documents`; of every tenth document the last ones in a loop.

    Whether, from where and how often the words repeat is fixed by a hash of the key.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n = F.size(words)
    hashed = F.crc32(F.col("doc_id").cast("string"))
    group = F.floor(hashed / 10)
    before = F.pmod(group, n).cast("int")
    period = (1 + F.floor((n - before) / (3 + group % 8))).cast("int")
    times = F.ceil((n - before) / period).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, before + 1, period), times))
    whole = F.concat(F.slice(words, F.lit(1), before), F.slice(loop, F.lit(1), n - before))
    changed = (hashed % 10 == 0) & (n > 0)
    return F.when(changed, F.array_join(whole, " ")).otherwise(F.col("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    return run_digests(periodic_runs(docs.withColumn("text", looped_text())))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitened(_table(spark, sf, "embeddings", "vec_id", "embedding"), WHITE_COMPONENTS)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_token_counts": op5_token_counts,
    "op6_neighbours": op6_neighbours,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_line_dedup": op8_line_dedup,
    "op9_secrets": op9_secrets,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_chat": op11_chat,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op3_licenses": oracles.op3_licenses(),
    "op11_chat": oracles.op11_chat(),
}
