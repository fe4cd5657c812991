"""The registered queries: every operator and analysis on the given tables.

`documents` stands for the corpus (group = source or lang, text = text), `embeddings` for
document vectors, `conversations` for an author's texts by period and `orders` for dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom import plans
from lexloom.functions import (
    clean_tokens,
    cosine_similarity,
    join_tokens,
    parse_date,
    parse_year,
    period_number,
    rule_tokenise,
    shrink,
    split_tokens,
    to_vector,
    token_rules,
    tokenise,
)
from lexloom.operators import embeddings as emb
from lexloom.operators import metrics, rows, sampling, terms
from lexloom.operators.blocks import union
from lexloom.operators.nearest import nearest
from lexloom.operators.pivots import nearest_by_pivots
from lexloom.operators.paragraphs import DIMS as PARAGRAPH_DIMS
from lexloom.operators.paragraphs import Settings, fit_paragraphs, load_paragraphs
from lexloom.operators.pooling import pool
from lexloom.plans.topics import term_loadings
from lexloom.sources import (
    append_csv,
    append_json,
    read_csv,
    read_parquet,
    read_words,
    spread,
    stage,
    with_slice,
    write_parquet,
)
from lexloom.sources.staging import Staging, new_path, remove

# Parameters shared by the queries and their SQL.
STOP_WORDS = ["and", "avec", "das", "der", "die", "for", "les", "los", "que", "the", "und", "with"]
MIN_LENGTH = 3
SEED = 7
DIMS = 64
TRAIN_SHARE = 0.75
PRE, DURING, NEVER = (0, 0), (1, 1), (5, 5)
SLICE_FRACTIONS = {"src0": 1.0, "src1": 0.5}
REST_FRACTION = 0.1
DRAW_RATE = 0.2
DRAW_LIMIT = 1000
CHUNKS = 4
CHUNK_TOKENS = 500
TOKEN_RULES = token_rules(["e.g.", "i.e.", "Mr.", "Dr.", "z.B."])
CHAIN_LABELS = ["en", "fr"]
SMALL_DIMS = 8
# Documents whose words are joined at a time.
WAVE_DOCUMENTS = 131_072

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spread(read_parquet(spark, f"{sf}/{name}.parquet", columns))


def _documents(
    spark: SparkSession, sf: str, *columns: str, stop_words: tuple | list = STOP_WORDS
) -> DataFrame:
    """(columns…, tokens) of the documents with at least two tokens."""
    df = _table(spark, sf, "documents", *dict.fromkeys([*columns, "text"]))
    tokens = tokenise("text", MIN_LENGTH)
    made = rows.with_tokens(df, tokens, stop_words=stop_words, case_sensitive=True)
    return made.select(*columns, "tokens")


def _r(column, digits: int = 6):
    return F.round(column, digits)


# ---- sources and sinks ---------------------------------------------------------------


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = ("documents", "labels", "embeddings", "conversations", "events", "orders")
    counted = [
        read_parquet(spark, f"{sf}/{t}.parquet").agg(F.count(F.lit(1)).alias("n"))
        for t in tables
    ]
    return sampling.union_slices(
        [n.select(F.lit(t).alias("table"), "n") for t, n in zip(tables, counted)]
    )


def directory_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Write one directory per language, scan all of it, tell rows apart by their file.

    Every file is a slice of its own, also where files of two directories have one name.
    """
    path = new_path(spark, "by-lang")
    write_parquet(_table(spark, sf, "documents", "doc_id", "lang", "n_chars"), path, by=["lang"])
    scan = with_slice(read_parquet(spark, path))
    per_file = scan.groupBy("lang", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars")
    )
    files = len(scan.inputFiles())
    slices = per_file.agg(
        F.count(F.lit(1)).alias("groups"), F.count_distinct("slice").alias("slices")
    )
    agree = (F.col("slices") == files) & (F.col("groups") == files)
    by_lang = per_file.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("n_chars").alias("n_chars"))
    whole = slices.select(F.lit(True).alias("one"), agree.alias("slices_are_files"))
    return by_lang.withColumn("one", F.lit(True)).join(whole, "one").drop("one")


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes and line breaks written to CSV and scanned again."""
    path = new_path(spark, "csv")
    append_csv(_table(spark, sf, "documents", "doc_id", "text", "lang", "source"), path)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
        ]
    )
    scan = read_csv(spark, path, schema)
    return scan.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


def json_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two parts appended to one JSON table hold every row once."""
    path = new_path(spark, "json")
    docs = _table(spark, sf, "documents", "doc_id", "lang", "text")
    for part in sampling.split(docs, [0.5, 0.5], SEED, ["doc_id"]):
        append_json(part, path)
    scan = spark.read.schema("doc_id long, lang string, text string").json(path)
    return scan.select("doc_id", "lang", F.md5("text").alias("text_md5"))


def stop_list_removal(spark: SparkSession, sf: str) -> DataFrame:
    """Write the most frequent terms as a word list, read it back and remove its words."""
    docs = _documents(spark, sf, "doc_id", stop_words=())
    path = new_path(spark, "words")
    frequent = terms.term_stats(docs, "tokens").filter(F.col("term").isNotNull())
    frequent.orderBy(F.desc("ctf"), "term").limit(50).select("term").write.text(path)
    words = read_words(spark, path)
    kept = terms.drop_listed_tokens(docs, ["doc_id"], "tokens", words, min_count=2)
    return kept.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


def listed_terms_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """The same removal as an anti-join of term rows with the list as a table."""
    counts = plans.token_bag(_documents(spark, sf, "lang", stop_words=()), ["lang"], "tokens")
    counts = stage(counts, "lang-terms")
    by_term = counts.groupBy("token").agg(F.sum("n").alias("ctf"))
    words = by_term.orderBy(F.desc("ctf"), "token").limit(50).select(F.col("token").alias("word"))
    return terms.drop_listed_terms(counts, words, "token")


# ---- rows, text, parsing -------------------------------------------------------------


def marker_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Substring, membership and range filters, then only complete rows."""
    docs = read_parquet(spark, f"{sf}/documents.parquet")
    docs = rows.with_marker(docs, "source", "c1")
    docs = rows.among(docs, "lang", ["en", "fr", None])
    docs = rows.within(docs, "n_chars", 100, 5000)
    return rows.complete_rows(docs, drop=["text", "not_there"])


def complete_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label have nulls after the join and are dropped."""
    docs = _table(spark, sf, "documents", "doc_id", "lang", "source")
    labels = _table(spark, sf, "labels", "doc_id", "quality", "toxic")
    joined = docs.join(labels, "doc_id", "left")
    return rows.complete_rows(joined, drop=["source", "toxic"])


def shrunk_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", F.md5(shrink("text")).alias("text_md5"))


def joined_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Join the tokens to a text, split it again, count."""
    docs = _documents(spark, sf, "doc_id").withColumn("line", join_tokens("tokens"))
    return docs.select(
        "doc_id",
        F.md5("line").alias("line_md5"),
        F.size(split_tokens("line")).cast("long").alias("n_tokens"),
    )


def cleaned_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Token arrays as input, some null or empty, with commas and capitals."""
    docs = _table(spark, sf, "documents", "doc_id", "text")
    words = F.when(F.col("doc_id") % 10 == 1, F.array().cast("array<string>")).when(
        F.col("doc_id") % 10 != 0, F.split("text", " ")
    )
    docs = docs.select("doc_id", words.alias("words"))
    kept = rows.with_tokens(docs, F.col("words"), min_length=MIN_LENGTH, stop_words=STOP_WORDS)
    return kept.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(join_tokens("tokens", "|")).alias("tokens_md5"),
        F.md5(join_tokens(clean_tokens("words", MIN_LENGTH), "|")).alias("lowered_md5"),
    )


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = terms.term_stats(_documents(spark, sf), "tokens")
    return counts.filter(F.col("term").isNotNull())


def rule_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens by rules of every whole text: their number, and a digest of them in order."""
    docs = _table(spark, sf, "documents", "doc_id", "text")
    tokens = F.explode(F.array(rule_tokenise("text", TOKEN_RULES))).alias("tokens")
    return docs.select("doc_id", tokens).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(join_tokens("tokens", " ")).alias("tokens_md5"),
    )


def period_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """`period 3` is read as 3, `period review 3` as null; periods in ascending order."""
    turns = _table(spark, sf, "conversations", "turn", "role")
    word = F.when(F.col("role") == "assistant", "period review ").otherwise("period ")
    text = turns.select("role", F.concat(word, F.col("turn").cast("string")).alias("period"))
    numbered = text.select("role", period_number("period").alias("number"))
    return (
        numbered.groupBy("role", "number")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("number", "role")
    )


def years(spark: SparkSession, sf: str) -> DataFrame:
    """Dates as day/month/year text; another format is read as null, and is in no range."""
    orders = _table(spark, sf, "orders", "o_orderdate", "o_orderstatus")
    bad = F.col("o_orderstatus") == "P"
    text = F.when(bad, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    dated = orders.select("o_orderstatus", text.alias("day_text"))
    dated = dated.select(
        "o_orderstatus",
        parse_date("day_text").alias("day"),
        parse_year("day_text").alias("year"),
    )
    return (
        rows.within(dated, "year", 1996, 1999)
        .groupBy("o_orderstatus", "year")
        .agg(F.count(F.lit(1)).alias("n"), F.date_format(F.max("day"), "yyyy-MM-dd").alias("last"))
    )


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rows.null_profile(read_parquet(spark, f"{sf}/events.parquet"))


def null_profile_joined(spark: SparkSession, sf: str) -> DataFrame:
    """Labels missing after an outer join, and texts holding the word null."""
    docs = _table(spark, sf, "documents", "doc_id", "text", "lang")
    labels = _table(spark, sf, "labels", "doc_id", "quality", "toxic")
    return rows.null_profile(docs.join(labels, "doc_id", "left"))


# ---- sampling ------------------------------------------------------------------------


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "lang")
    return sampling.sample(docs, 0.3, SEED, ["doc_id"])


def sample_with_replacement(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "lang")
    return sampling.sample_with_replacement(docs, 0.8, SEED, ["doc_id"])


def sample_slices(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "source")
    return sampling.sample_slices(docs, "source", SLICE_FRACTIONS, REST_FRACTION, SEED, ["doc_id"])


def slice_union(spark: SparkSession, sf: str) -> DataFrame:
    """One slice in full and a sample of the others, united."""
    docs = _table(spark, sf, "documents", "doc_id", "lang", "source")
    first = docs.filter(F.col("source") == "src0")
    others = docs.filter(F.col("source") != "src0").select("source", "doc_id", "lang")
    others = sampling.sample(others, REST_FRACTION, SEED, ["doc_id"])
    return sampling.union_slices([first, others])


def split_parts(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "lang")
    train, test = sampling.split(docs, [TRAIN_SHARE, 1 - TRAIN_SHARE], SEED, ["doc_id"])
    return sampling.union_slices(
        [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    )


def sampled_split(spark: SparkSession, sf: str) -> DataFrame:
    """A sample split with the sample's own seed: rows per slice and part."""
    sampled = sample_slices(spark, sf)
    parts = sampling.split(sampled, [TRAIN_SHARE, 1 - TRAIN_SHARE], SEED, ["doc_id"])
    named = [p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("train", "test"))]
    united = sampling.union_slices(named)
    return united.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))


def spark_sample_strays(spark: SparkSession, sf: str) -> DataFrame:
    """Rows drawn by Spark's samplers that are not in the table."""
    docs = _table(spark, sf, "documents", "doc_id", "lang")
    strays = spark_sample(spark, sf).join(docs, ["doc_id", "lang"], "left_anti")
    return strays.agg(F.count(F.lit(1)).alias("strays"))


def spark_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Spark's own samplers, with a seed."""
    docs = _table(spark, sf, "documents", "doc_id", "lang")
    return sampling.union_slices(
        [sampling.sample(docs, 0.3, SEED), sampling.sample_with_replacement(docs, 0.2, SEED)]
    )


# ---- terms ---------------------------------------------------------------------------


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    fitted = terms.fit_vocabulary(_documents(spark, sf), "tokens", 0.2, 8000)
    return fitted.to_frame(spark).select("term", "term_id", "ctf", "df", _r("idf").alias("idf"))


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, "doc_id")
    fitted = terms.fit_vocabulary(docs, "tokens", 0.2, 8000)
    weighted = terms.tfidf_rows(terms.term_rows(docs, ["doc_id"], "tokens"), fitted)
    return weighted.select("doc_id", "term", "tf", _r("weight").alias("weight"))


def group_keywords_below(spark: SparkSession, sf: str) -> DataFrame:
    found = plans.group_keywords(_documents(spark, sf, "source"), "source", "tokens")
    return found.select("source", "term", "tf", _r("weight").alias("weight"))


def group_keywords_top(spark: SparkSession, sf: str) -> DataFrame:
    found = plans.group_keywords(
        _documents(spark, sf, "lang"), "lang", "tokens", below=None, top=20
    )
    return found.select("lang", "term", "tf", _r("weight").alias("weight"), "rank")


def keywords_by_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords of each source, every language being a corpus of its own."""
    docs = _documents(spark, sf, "lang", "source")
    found = plans.group_keywords(docs, "source", "tokens", slice="lang")
    return found.select("lang", "source", "term", "tf", _r("weight").alias("weight"))


def token_bag(spark: SparkSession, sf: str) -> DataFrame:
    """The tokens of each role and period with their number."""
    turns = _table(spark, sf, "conversations", "role", "turn", "text")
    said = rows.with_tokens(turns, tokenise("text"), min_count=1)
    return plans.token_bag(said, ["role", "turn"], "tokens")


def collect_by(spark: SparkSession, sf: str) -> DataFrame:
    """All tokens of each role and period, dealt over four arrays."""
    turns = _table(spark, sf, "conversations", "conv_id", "role", "turn", "text")
    said = rows.with_tokens(turns, tokenise("text"), min_count=1)
    found = plans.collect_by(
        said, ["role", "turn"], "tokens", ["conv_id"], chunks=CHUNKS, seed=SEED
    )
    return found.select(
        "role",
        "turn",
        "chunk",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(join_tokens("tokens")).alias("tokens_md5"),
    )


def collect_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """All tokens of each role in order, in arrays of 500."""
    turns = _table(spark, sf, "conversations", "conv_id", "role", "turn", "text")
    said = rows.with_tokens(turns, tokenise("text"), min_count=1)
    found = plans.collect_chunks(said, ["role"], "tokens", ["conv_id", "turn"], CHUNK_TOKENS)
    return found.select(
        "role",
        "chunk",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(join_tokens("tokens")).alias("tokens_md5"),
    )


def sampled_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Draw rows with replacement, keep the first thousand, collect tokens per group."""
    turns = _table(spark, sf, "conversations", "conv_id", "role", "turn", "text")
    drawn = sampling.sample_with_replacement(turns, DRAW_RATE, SEED, ["conv_id", "turn"])
    drawn = sampling.first_rows(drawn, DRAW_LIMIT, ["conv_id", "turn", "copy"])
    said = rows.with_tokens(drawn, tokenise("text"), min_count=1)
    found = plans.collect_by(said, ["role", "turn"], "tokens", ["conv_id", "copy"], chunks=1)
    return found.select("role", "turn", F.md5(join_tokens("tokens")).alias("tokens_md5"))


# ---- vectors -------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings", "vec_id", "embedding", "label")


def _long(df: DataFrame, *keys: str) -> DataFrame:
    values = F.posexplode("embedding").alias("i", "value")
    return df.select(*keys, values).withColumn("value", _r("value"))


def max_pool(spark: SparkSession, sf: str) -> DataFrame:
    return _long(pool(_vectors(spark, sf), ["label"], "embedding", DIMS), "label")


def mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    return _long(pool(_vectors(spark, sf), ["label"], "embedding", DIMS, "mean"), "label")


def max_pool_all(spark: SparkSession, sf: str) -> DataFrame:
    return _long(pool(_vectors(spark, sf), [], "embedding", DIMS))


def nearest_k(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest(_vectors(spark, sf), "vec_id", "embedding", k=10)
    return found.select("vec_id", "other", _r("similarity").alias("similarity"), "rank")


def nearest_by_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """The same neighbours, cells of vectors left out where bounds on angles allow it."""
    found = nearest_by_pivots(_vectors(spark, sf), "vec_id", "embedding", k=10)
    return found.select("vec_id", "other", _r("similarity").alias("similarity"), "rank")


def most_similar_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of a label pooled to one, then the most similar labels."""
    found = plans.most_similar(_vectors(spark, sf), "label", "embedding", DIMS, k=3)
    return found.select("label", "other", _r("similarity").alias("similarity"), "rank")


def similarity_to_label(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every vector with the mean vector of its label."""
    vectors = _vectors(spark, sf)
    means = pool(vectors, ["label"], "embedding", DIMS, "mean")
    joined = vectors.join(means.withColumnRenamed("embedding", "mean"), "label")
    own = F.col("embedding").cast("array<double>")
    return joined.select("vec_id", _r(cosine_similarity(own, "mean")).alias("similarity"))


def vector_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every vector with null, zeros, a shorter vector, or its own reverse."""
    own = F.col("embedding").cast("array<double>")
    case = F.col("vec_id") % 4
    other = (
        F.when(case == 1, F.transform(own, lambda x: x * 0.0))
        .when(case == 2, F.slice(own, 1, 10))
        .when(case == 3, F.reverse(own))
    )
    vectors = _vectors(spark, sf).select("vec_id", own.alias("own"), other.alias("other"))
    return vectors.select("vec_id", _r(cosine_similarity("own", "other")).alias("similarity"))


def _dated_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every other vector belongs to the first period, the others to the second."""
    return _vectors(spark, sf).withColumn("period", F.col("vec_id") % 2)


def _period_vectors(spark: SparkSession, sf: str, during: tuple = DURING) -> DataFrame:
    return plans.period_vectors(
        _dated_vectors(spark, sf), "label", "embedding", "period", PRE, during, DIMS
    )


def drift_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    found = plans.drift_by_entity(_period_vectors(spark, sf), "label")
    return found.select("label", _r("similarity").alias("similarity"))


def drift_chosen(spark: SparkSession, sf: str) -> DataFrame:
    found = plans.drift_by_entity(_period_vectors(spark, sf), "label", [1, 3, 5, 7])
    return found.select("label", _r("similarity").alias("similarity"))


def drift_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same from two tables, one per period, joined by entity."""
    vectors = _dated_vectors(spark, sf)
    pre, during = (
        pool(rows.within(vectors, "period", *period), ["label"], "embedding", DIMS)
        for period in (PRE, DURING)
    )
    both = plans.joined_vectors(pre, during, "label", "embedding")
    found = plans.drift_by_entity(both, "label")
    return found.select("label", _r("similarity").alias("similarity"))


def drift_overall(spark: SparkSession, sf: str) -> DataFrame:
    found = plans.drift_overall(_period_vectors(spark, sf), DIMS)
    return found.select(
        _r("euclidean_distance").alias("euclidean_distance"),
        _r("cosine_distance").alias("cosine_distance"),
    )


def drift_to_nowhere(spark: SparkSession, sf: str) -> DataFrame:
    """No distance to a period without rows."""
    found = plans.drift_overall(_period_vectors(spark, sf, NEVER), DIMS)
    return found.select(
        _r("euclidean_distance").alias("euclidean_distance"),
        _r("cosine_distance").alias("cosine_distance"),
    )


def embedding_means(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, and those whose vector is not the mean of their words' vectors."""
    docs = stage(_documents(spark, sf, "doc_id"), "doc-tokens")
    model = emb.fit_embedding(docs, "tokens", SEED, dims=SMALL_DIMS)
    values = vector_to_array("vector")
    words = model.getVectors().select(
        F.col("word").alias("term"), *[values[i].alias(f"v{i}") for i in range(SMALL_DIMS)]
    )
    sums = [F.sum(F.col(f"v{i}") * F.col("tf")) / F.first("n") for i in range(SMALL_DIMS)]
    # The words of a bounded number of documents at a time, so that the disk has room for them.
    waves = max(1, -(-docs.count() // WAVE_DOCUMENTS))
    own = F.pmod(F.xxhash64("doc_id"), F.lit(waves)).cast("int").alias("wave")
    found = []
    with Staging(spark) as staging:
        sized = docs.select("doc_id", "tokens", F.size("tokens").alias("n"), own)
        sized = staging.write(sized, "sized-tokens", ["wave"])
        words = staging.write(words, "terms")
        for wave in range(waves):
            counted = terms.term_rows(sized.filter(F.col("wave") == wave), ["doc_id", "n"], "tokens")
            mean = counted.join(words, "term").groupBy("doc_id").agg(F.array(*sums).alias("mean"))
            found.append(stage(mean, "word-means"))
    means = union(found)
    embedded = emb.embed(docs, model, "tokens").select("doc_id", "embedding")
    both = embedded.join(means, "doc_id", "left")
    mean = F.coalesce("mean", F.array_repeat(F.lit(0.0), SMALL_DIMS))
    apart = F.zip_with("embedding", mean, lambda a, b: F.abs(a - b) > 1e-5)
    both = both.select("doc_id", F.exists(apart, lambda x: x).alias("off"))
    by_doc = both.groupBy("doc_id").agg(F.bool_or("off").alias("off"))
    return by_doc.agg(F.count(F.lit(1)).alias("n"), F.count_if("off").alias("differing"))


def word2vec_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Train and save a model, embed with the saved one, find the most similar sources."""
    docs = stage(_documents(spark, sf, "doc_id", "source"), "doc-tokens")
    path = new_path(spark, "word2vec")
    emb.fit_embedding(docs, "tokens", SEED).save(path)
    embedded = emb.embed(docs, emb.load_embedding(path), "tokens")
    return plans.most_similar(embedded, "source", "embedding", emb.DIMS, k=5)


def _paragraph_vectors(spark: SparkSession, sf: str) -> DataFrame:
    docs = stage(_documents(spark, sf, "doc_id", "source", "lang"), "doc-tokens")
    return fit_paragraphs(docs, "tokens", epochs=12, settings=Settings(dims=32, seed=SEED))[1]


def paragraph_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Train document vectors, save the words' and load them, fit the same documents to them,
    find the most similar sources."""
    docs = stage(_documents(spark, sf, "doc_id", "source"), "doc-tokens")
    model, _ = fit_paragraphs(docs, "tokens", settings=Settings(seed=SEED))
    path = new_path(spark, "paragraphs")
    model.save(path)
    vectors = load_paragraphs(spark, path).vectors(docs, "tokens")
    return plans.most_similar(vectors, "source", "embedding", PARAGRAPH_DIMS, k=5)


def paragraph_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Per language its documents, and whether four in five are nearest to one of the same."""
    vectors = stage(_paragraph_vectors(spark, sf), "paragraph-vectors")
    found = nearest(vectors.select("doc_id", "embedding"), "doc_id", "embedding", k=1)
    langs = vectors.select("doc_id", "lang")
    others = langs.select(F.col("doc_id").alias("other"), F.col("lang").alias("other_lang"))
    pairs = langs.join(found, "doc_id", "left").join(others, "other", "left")
    alike = F.count_if(F.col("lang") == F.col("other_lang"))
    return pairs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), (alike >= 0.8 * F.count(F.lit(1))).alias("alike")
    )


def leaders_drift(spark: SparkSession, sf: str) -> DataFrame:
    """From raw CSV to drift: dated speeches, marked rows, embeddings, two periods.

    A document's date is that of the order with its number, its party the language.
    """
    docs = _table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    dates = _table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    raw = docs.join(dates, docs.doc_id == dates.o_orderkey).select(
        F.col("doc_id").alias("sitting"),
        F.col("text").alias("speech"),
        F.col("source").alias("roles"),
        F.col("lang").alias("party"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("sitting_date"),
    )
    path = new_path(spark, "speeches")
    append_csv(raw, path)
    speeches = rows.complete_rows(read_csv(spark, path), drop=["sitting"])
    tokens = tokenise("speech", MIN_LENGTH)
    speeches = rows.with_tokens(speeches, tokens, stop_words=STOP_WORDS).drop("speech")
    speeches = stage(speeches.withColumn("year", parse_year("sitting_date")), "speeches")
    remove(spark, path)
    model = emb.fit_embedding(speeches, "tokens", SEED)
    leaders = rows.within(rows.with_marker(speeches, "roles", "c1"), "year", 1995, 2001)
    vectors = plans.period_vectors(
        emb.embed(leaders, model, "tokens"),
        "party",
        "embedding",
        "year",
        (1995, 1997),
        (1998, 2001),
        emb.DIMS,
    )
    return plans.drift_by_entity(vectors, "party")


# ---- clusters, classes, metrics ------------------------------------------------------


def composition_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per quality, language and source; unlabelled documents count 0 of their label."""
    docs = _table(spark, sf, "documents", "doc_id", "lang", "source")
    labels = _table(spark, sf, "labels", "doc_id", "quality")
    joined = docs.join(labels, "doc_id", "left")
    return rows.group_counts(joined, ["quality", "lang", "source"], "quality")


def distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents", "lang", "source").distinct()


def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf).select("label", to_vector("embedding").alias("v"))
    found = metrics.silhouette(vectors, "label", "v")
    return found.select(_r("silhouette").alias("silhouette"))


def _lang_classes(spark: SparkSession, sf: str, model: str) -> plans.Classified:
    return plans.classify(
        _documents(spark, sf, "doc_id", "lang"),
        "lang",
        "tokens",
        model,
        keys=["doc_id"],
        weights=(TRAIN_SHARE, 1 - TRAIN_SHARE),
        seed=SEED,
    )


def nb_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _lang_classes(spark, sf, "nb").predictions


def nb_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = _lang_classes(spark, sf, "nb").metrics()
    return found.select("n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


def nb_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The quality label from the text, for documents that have one."""
    labels = _table(spark, sf, "labels", "doc_id", "quality")
    docs = stage(_documents(spark, sf, "doc_id").join(labels, "doc_id"), "labelled")
    found = plans.classify(
        docs, "quality", "tokens", "nb", keys=["doc_id"], seed=SEED
    ).metrics()
    return found.select("n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


def svm_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows per label of the support vector machine."""
    found = _lang_classes(spark, sf, "svm").predictions.filter(F.col("prediction").isNotNull())
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _sampled_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled slices with their tokens, written once for the models that read them."""
    docs = _table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    sampled = sampling.sample_slices(
        docs, "source", SLICE_FRACTIONS, REST_FRACTION, SEED, ["doc_id"]
    )
    tokens = tokenise("text", MIN_LENGTH)
    made = rows.with_tokens(sampled, tokens, stop_words=STOP_WORDS, case_sensitive=True)
    return stage(made.drop("text"), "sampled-tokens")


def sampled_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled slices, two labels, both models: naive Bayes by its metrics, the other's rows."""
    docs = _sampled_tokens(spark, sf)
    nb, svm = (
        plans.classify(
            docs, "lang", "tokens", model, keys=["doc_id"], labels=CHAIN_LABELS, seed=SEED
        )
        for model in ("nb", "svm")
    )
    found = nb.metrics().select("n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))
    return found.join(svm.metrics().select(F.col("n").alias("svm_n")), F.col("n") == F.col("svm_n"))


def sampled_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled slices clustered: rows per source and language, summed over the clusters."""
    docs = _sampled_tokens(spark, sf)
    profile = plans.cluster_profile(docs, "tokens", ["source", "lang"])
    counts = profile.composition(["source", "lang"])
    return counts.groupBy("source", "lang").agg(F.sum("n").alias("n"))


def svm_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _lang_classes(spark, sf, "svm").metrics()


def label_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """f1 and accuracy of the quality label taken as a prediction of toxicity."""
    labels = _table(spark, sf, "labels", "quality", "toxic")
    found = metrics.f1_accuracy(labels, "toxic", "quality")
    return found.select("n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    labels = _table(spark, sf, "labels", "quality", "toxic")
    return metrics.confusion(labels, "toxic", "quality")


def topics(spark: SparkSession, sf: str) -> DataFrame:
    return plans.topics(_documents(spark, sf), "tokens")


def topics_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return plans.topics(_documents(spark, sf, "lang"), "tokens", slice="lang")


def topic_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Per concept: its norm, its largest product with another, and how far the length of the
    projected documents is from its singular value, all worked out relationally."""
    docs = stage(_documents(spark, sf, "doc_id"), "doc-tokens")
    loadings = stage(term_loadings(docs, "tokens", 10, 0.2, 8000), "loadings")
    fitted = terms.fit_vocabulary(docs, "tokens", 0.2, 8000)
    weighted = terms.tfidf_rows(terms.term_rows(docs, ["doc_id"], "tokens"), fitted)
    weighted = weighted.select("doc_id", "term", F.col("weight").alias("x"))
    projected = weighted.join(loadings, "term").groupBy("doc_id", "concept").agg(
        F.sum(F.col("x") * F.col("weight")).alias("y")
    )
    lengths = projected.groupBy("concept").agg(F.sqrt(F.sum(F.col("y") ** 2)).alias("length"))
    others = loadings.select("term", F.col("concept").alias("other"), F.col("weight").alias("w"))
    products = loadings.join(others, "term").groupBy("concept", "other").agg(
        F.sum(F.col("weight") * F.col("w")).alias("p")
    )
    own = F.col("concept") == F.col("other")
    shape = products.groupBy("concept").agg(
        F.max(F.when(own, F.col("p"))).alias("norm"),
        F.max(F.when(~own, F.abs("p"))).alias("overlap"),
    )
    strengths = loadings.groupBy("concept").agg(
        F.max("singular_value").alias("strength"), F.count(F.lit(1)).alias("n_terms")
    )
    joined = strengths.join(shape, "concept").join(lengths, "concept")
    return joined.select(
        "concept",
        "n_terms",
        F.round("norm", 6).alias("norm"),
        F.round("overlap", 6).alias("overlap"),
        F.round(F.abs(F.col("length") / F.col("strength") - 1.0), 6).alias("strength_error"),
    )


def cluster_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per source and language, summed over the clusters."""
    counts = cluster_members(spark, sf)
    return counts.groupBy("source", "lang").agg(F.sum("n").alias("n"))


def silhouette_of_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """How far the silhouette of fitted clusters is from one worked out relationally."""
    profile = plans.cluster_profile(_documents(spark, sf, "doc_id"), "tokens", ["doc_id"])
    assigned = stage(profile.assigned, "assigned")
    values = assigned.select(
        "doc_id", "cluster", F.posexplode(vector_to_array("features")).alias("i", "x")
    ).filter("x != 0")
    square = values.groupBy("doc_id").agg(F.sum(F.col("x") ** 2).alias("square"))
    docs = assigned.select("doc_id", "cluster").join(square, "doc_id", "left").na.fill(0.0)
    sizes = docs.groupBy(F.col("cluster").alias("other")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("square").alias("squares")
    )
    sums = values.groupBy(F.col("cluster").alias("other"), "i").agg(F.sum("x").alias("s"))
    dots = values.join(sums, "i").groupBy("doc_id", "other").agg(
        F.sum(F.col("x") * F.col("s")).alias("dot")
    )
    clusters = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("other")
    pairs = docs.select("*", clusters).join(sizes, "other").join(dots, ["doc_id", "other"], "left")
    total = F.col("n") * F.col("square") + F.col("squares") - 2 * F.coalesce("dot", F.lit(0.0))
    own = F.col("cluster") == F.col("other")
    sides = pairs.groupBy("doc_id").agg(
        F.max(F.when(own, F.col("n"))).alias("own_n"),
        F.max(F.when(own & (F.col("n") > 1), total / (F.col("n") - 1))).alias("own"),
        F.min(F.when(~own, total / F.col("n"))).alias("near"),
    )
    each = F.when(F.col("own_n") == 1, 0.0).otherwise(
        (F.col("near") - F.col("own")) / F.greatest("near", "own")
    )
    mean = sides.agg(F.avg(each).alias("mean")).withColumn("one", F.lit(1))
    found = profile.quality().withColumn("one", F.lit(1))
    difference = F.round(F.abs(F.col("mean") - F.col("silhouette")), 6)
    return found.join(mean, "one").select(difference.alias("difference"))


def cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per cluster, source and language."""
    docs = _documents(spark, sf, "source", "lang")
    return plans.cluster_profile(docs, "tokens", ["source", "lang"]).composition(["source", "lang"])


def cluster_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, "lang")
    return plans.cluster_profile(docs, "tokens", ["lang"]).quality()


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        parquet_scan,
        row_counts,
        directory_slices,
        csv_round_trip,
        json_append,
        stop_list_removal,
        listed_terms_dropped,
        marker_rows,
        complete_labels,
        shrunk_text,
        joined_tokens,
        cleaned_arrays,
        token_counts,
        rule_tokens,
        period_numbers,
        years,
        null_profile,
        null_profile_joined,
        sample_rows,
        sample_with_replacement,
        sample_slices,
        slice_union,
        split_parts,
        sampled_split,
        spark_sample,
        spark_sample_strays,
        vocabulary,
        tfidf_terms,
        group_keywords_below,
        group_keywords_top,
        keywords_by_slice,
        token_bag,
        collect_by,
        collect_chunks,
        sampled_tokens,
        max_pool,
        mean_pool,
        max_pool_all,
        nearest_k,
        nearest_by_bounds,
        most_similar_labels,
        similarity_to_label,
        vector_cases,
        drift_by_entity,
        drift_chosen,
        drift_joined,
        drift_overall,
        drift_to_nowhere,
        embedding_means,
        word2vec_nearest,
        paragraph_nearest,
        paragraph_languages,
        leaders_drift,
        composition_counts,
        distinct_groups,
        silhouette,
        nb_predictions,
        nb_metrics,
        nb_quality_metrics,
        svm_metrics,
        svm_labels,
        sampled_classes,
        sampled_clusters,
        label_metrics,
        confusion,
        topics,
        topics_by_lang,
        topic_properties,
        cluster_members,
        cluster_totals,
        cluster_quality,
        silhouette_of_clusters,
    )
}
