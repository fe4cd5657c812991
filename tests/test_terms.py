from __future__ import annotations

from collections import Counter
from math import log

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from lexloom.operators import terms
from lexloom.plans import group_keywords, token_bag

QUICK = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
WORDS = st.lists(st.sampled_from(["a", "b", "c", "dd", "é"]), max_size=12)


def table(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "id int, tokens array<string>")


@QUICK
@given(st.lists(WORDS, min_size=1, max_size=8))
def test_counts_equal_counting_by_hand(spark, docs):
    df = table(spark, docs)
    rows = {(r.id, r.term): r.tf for r in terms.term_rows(df, ["id"], "tokens").collect()}
    assert rows == {(i, t): n for i, d in enumerate(docs) for t, n in Counter(d).items()}
    stats = {r.term: (r.ctf, r.df) for r in terms.term_stats(df, "tokens").collect()}
    assert stats.pop(None)[1] == len(docs)
    ctf = Counter(t for d in docs for t in d)
    assert stats == {t: (n, sum(t in d for d in docs)) for t, n in ctf.items()}


def test_vocabulary_ties_go_by_the_alphabet(spark):
    df = table(spark, [["z", "y"], ["x", "q"]])
    # Below 1 a share: no term is in at most 0.4 · 2 documents. From 1 on a number.
    assert terms.fit_vocabulary(df, "tokens", 0.4, 2).terms == ()
    assert terms.fit_vocabulary(df, "tokens", 1, 2).terms == ("q", "x")
    assert terms.fit_vocabulary(df, "tokens", 0.5, 9).terms == ("q", "x", "y", "z")


def test_vocabulary_without_terms(spark):
    df = table(spark, [["a"], ["a"]])
    empty = terms.fit_vocabulary(df, "tokens", 0.2, 10)
    assert empty.terms == () and empty.n_docs == 2
    with pytest.raises(ValueError):
        terms.tfidf_vectors(df, "tokens", empty)
    assert terms.tfidf_rows(terms.term_rows(df, ["id"], "tokens"), empty).count() == 0


def test_tfidf_equals_spark_models(spark):
    docs = [["a", "b", "b"], ["b", "c"], ["c", "c", "d"], ["e", "a"], []]
    df = table(spark, docs)
    vocabulary = terms.fit_vocabulary(df, "tokens", 0.9, 100)
    counts = CountVectorizer(inputCol="tokens", outputCol="raw", maxDF=0.9).fit(df)
    raw = counts.transform(df)
    idf = IDF(inputCol="raw", outputCol="f").fit(raw)
    theirs = {
        (r.id, counts.vocabulary[i]): v
        for r in idf.transform(raw).collect()
        for i, v in zip(r.f.indices, r.f.values)
    }
    ours = {
        (r.id, vocabulary.terms[i]): v
        for r in terms.tfidf_vectors(df, "tokens", vocabulary).collect()
        for i, v in zip(r.features.indices, r.features.values)
    }
    rows = terms.tfidf_rows(terms.term_rows(df, ["id"], "tokens"), vocabulary)
    by_rows = {(r.id, r.term): r.weight for r in rows.collect()}
    assert set(ours) == set(theirs) == set(by_rows)
    for key, value in theirs.items():
        assert ours[key] == pytest.approx(value) and by_rows[key] == pytest.approx(value)


def test_only_small_vocabularies_are_broadcast(spark):
    df = table(spark, [["a", "b"], ["b", "c"]])
    vocabulary = terms.fit_vocabulary(df, "tokens", 2, 10)
    large = terms.Vocabulary(2, *(tuple(range(10**6)) for _ in range(3)))
    large = terms.Vocabulary(2, tuple(map(str, large.terms)), large.ctf, large.df)
    for fitted, broadcast in ((vocabulary, True), (large, False)):
        rows = terms.tfidf_rows(terms.term_rows(df, ["id"], "tokens"), fitted)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == broadcast
    assert terms.tfidf_rows(terms.term_rows(df, ["id"], "tokens"), vocabulary).count() == 4


def test_listed_terms_are_dropped_whatever_their_case(spark):
    rows = spark.createDataFrame([("A", 1), ("b", 2)], "term string, tf int")
    words = spark.createDataFrame([("a",), ("a",)], "word string")
    assert [r.term for r in terms.drop_listed_terms(rows, words).collect()] == ["b"]


def test_group_keywords(spark):
    df = spark.createDataFrame(
        [("x", ["a", "a", "b"]), ("x", ["c"]), ("y", ["b", "d"]), (None, ["d", "b"])],
        "g string, tokens array<string>",
    )
    everything = group_keywords(df, "g", "tokens", max_df=0.7, below=None)
    found = {(r.g, r.term): (r.tf, r.weight) for r in everything.collect()}
    # b is in all three groups, over the limit; the null group is a group too.
    assert found == {
        ("x", "a"): (2, pytest.approx(2 * log(4 / 2))),
        ("x", "c"): (1, pytest.approx(log(4 / 2))),
        ("y", "d"): (1, pytest.approx(log(4 / 3))),
        (None, "d"): (1, pytest.approx(log(4 / 3))),
    }
    below = group_keywords(df, "g", "tokens", max_df=0.7, below=0.5)
    assert {r.term for r in below.collect()} == {"d"}
    top = group_keywords(df, "g", "tokens", max_df=0.7, below=None, top=1)
    assert {(r.g, r.term, r["rank"]) for r in top.collect()} == {
        ("x", "a", 1),
        ("y", "d", 1),
        (None, "d", 1),
    }


def test_a_group_with_most_of_the_rows_is_counted_in_parts(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("rest")).otherwise("hot").alias("g"),
        F.array(F.lit("same"), F.concat(F.lit("w"), F.col("id") % 50)).alias("tokens"),
    )
    bag = token_bag(df, ["g"], "tokens")
    plan = bag._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "collect_list" not in plan
    assert {r.g: r.n for r in bag.filter("token = 'same'").collect()} == {"hot": 2000, "rest": 1000}
