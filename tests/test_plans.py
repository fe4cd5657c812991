from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from lexloom import queries as q
from lexloom.operators import embeddings as emb
from lexloom.operators.metrics import f1_accuracy
from lexloom.operators.sampling import sample
from lexloom.operators.terms import fit_vocabulary, tfidf_vectors
from lexloom.plans import (
    classify,
    cluster_profile,
    collect_by,
    collect_chunks,
    group_keywords,
    topics,
)
from lexloom.plans.topics import term_loadings
from lexloom.sources import read_parquet, stage, with_slice


@pytest.fixture(scope="module")
def docs(spark, sf):
    return stage(q._documents(spark, sf, "doc_id", "lang", "source"), "test-docs")


def test_loadings_are_singular_vectors(docs):
    found = term_loadings(docs, "tokens", 5, 0.2, 300).collect()
    vocabulary = fit_vocabulary(docs, "tokens", 0.2, 300)
    v = np.zeros((len(vocabulary.terms), 5))
    place = {t: i for i, t in enumerate(vocabulary.terms)}
    for r in found:
        v[place[r.term], r.concept - 1] = r.weight
    strengths = [next(r.singular_value for r in found if r.concept == c) for c in range(1, 6)]
    assert strengths == sorted(strengths, reverse=True)
    assert np.allclose(v.T @ v, np.eye(5), atol=1e-6)
    assert all(column[np.abs(column).argmax()] > 0 for column in v.T)
    features = tfidf_vectors(docs, "tokens", vocabulary).select("features").collect()
    local = np.linalg.svd(np.stack([r.features.toArray() for r in features]))[1]
    assert strengths == pytest.approx(local[:5].tolist())


def test_topics_are_ranked_and_asking_for_too_many_is_fine(spark):
    df = spark.createDataFrame(
        [(["a", "b"],), (["a", "c", "c"],), (["b", "c"],), (["d", "a"],)], "tokens array<string>"
    )
    found = topics(df, "tokens", k=10, terms=2, max_df=4, vocab=3).collect()
    by_concept = {}
    for r in sorted(found, key=lambda r: (r.concept, r["rank"])):
        by_concept.setdefault(r.concept, []).append(r.weight)
    assert 1 <= len(by_concept) <= 3
    assert all(len(w) == 2 and w[0] >= w[1] for w in by_concept.values())


def test_topics_of_a_slice_are_those_of_its_rows(spark, docs):
    sliced = topics(docs, "tokens", k=3, vocab=300, slice="lang")
    alone = topics(docs.filter("lang = 'fr'"), "tokens", k=3, vocab=300)
    ours = {(r.concept, r["rank"]): r.weight for r in sliced.filter("lang = 'fr'").collect()}
    theirs = {(r.concept, r["rank"]): r.weight for r in alone.collect()}
    assert {r.lang for r in sliced.select("lang").distinct().collect()} == {"de", "en", "es", "fr"}
    assert ours == pytest.approx(theirs)


def test_a_slice_without_terms_has_no_topics(spark):
    df = spark.createDataFrame(
        [("x", ["a", "b"]), ("x", ["a", "c", "c"]), ("x", ["b", "c"]), ("y", ["a", "b"])],
        "s string, tokens array<string>",
    )
    found = topics(df, "tokens", k=2, terms=2, max_df=0.7, vocab=9, slice="s")
    assert {r.s for r in found.collect()} == {"x"}
    assert topics(df.filter("s = 'y'"), "tokens").count() == 0
    with pytest.raises(ValueError):
        topics(df.filter("s = 'z'"), "tokens", slice="s")


def test_clusters_hold_every_row(docs):
    profile = cluster_profile(docs, "tokens", ["source", "lang"], vocab=500)
    assert profile.composition(["source", "lang"]).agg(F.sum("n")).first()[0] == docs.count()
    by_lang = profile.composition(["lang"])
    assert by_lang.columns == ["cluster", "lang", "n"]
    assert {r.cluster for r in profile.clusters().collect()} == {0, 1, 2, 3}
    assert -1.0 <= profile.quality().first().silhouette <= 1.0
    again = cluster_profile(docs, "tokens", ["source", "lang"], vocab=500)
    assert sorted(map(tuple, by_lang.collect())) == sorted(
        map(tuple, again.composition(["lang"]).collect())
    )


@pytest.mark.parametrize("model", ["nb", "svm"])
def test_classes(docs, model):
    found = classify(
        docs, "lang", "tokens", model, keys=["doc_id"], labels=["en", "fr"], vocab=500
    )
    rows = found.predictions.collect()
    assert {r.label for r in rows} == {"en", "fr"}
    total = docs.filter("lang in ('en', 'fr')").count()
    assert total * 0.1 < len(rows) < total * 0.4
    ours = found.metrics().first()
    indexed = StringIndexer(inputCol="label", outputCol="l").fit(found.predictions)
    both = indexed.transform(found.predictions)
    back = StringIndexer(inputCol="prediction", outputCol="p")
    both = back.fit(both).setHandleInvalid("keep").transform(both)
    # Both columns on the same scale: index the prediction by the labels' order.
    order = F.create_map(
        *[x for i, name in enumerate(indexed.labels) for x in (F.lit(name), F.lit(float(i)))]
    )
    both = both.withColumn("p", order[F.col("prediction")])
    for metric, value in (("f1", ours.f1), ("accuracy", ours.accuracy)):
        evaluator = MulticlassClassificationEvaluator(
            labelCol="l", predictionCol="p", metricName=metric
        )
        assert evaluator.evaluate(both) == pytest.approx(value)


def test_classes_without_keys_are_split_by_spark(docs):
    a, b = (
        classify(docs, "lang", "tokens", vocab=200, seed=4).metrics().first() for _ in range(2)
    )
    assert a == b


def test_unknown_model(docs):
    with pytest.raises(ValueError):
        classify(docs, "lang", "tokens", "forest")


def test_f1_of_labels_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "b")], "l string, p string")
    found = f1_accuracy(df, "l", "p").first()
    assert (found.n, found.accuracy) == (3, pytest.approx(1 / 3))
    assert found.f1 == pytest.approx((2 * (2 / 3) + 0) / 3)


def test_collect_by_gives_one_row_per_group(spark):
    df = spark.createDataFrame(
        [(2, "a", ["y"]), (1, "a", ["x", "x"]), (3, "b", ["z"]), (4, None, ["n"])],
        "id int, g string, t array<string>",
    )
    found = collect_by(df, ["g"], "t", ["id"], chunks=1).collect()
    assert {r.g: (r.chunk, r.tokens) for r in found} == {
        "a": (0, ["x", "x", "y"]),
        "b": (0, ["z"]),
        None: (0, ["n"]),
    }


def test_collect_by_deals_every_group_alike_and_loses_nothing(spark):
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("g"), F.col("id") % 100)).alias("g"),
        F.array(F.col("id").cast("string"), F.lit("w")).alias("t"),
    )
    sampled = sample(df, 0.5, 7, ["id"])
    found = collect_by(sampled, ["g"], "t", ["id"], chunks=4, seed=7).cache()
    of_null = [r.n for r in found.filter("g IS NULL").select(F.size("tokens").alias("n")).collect()]
    assert len(of_null) == 4 and max(of_null) < 2 * min(of_null)
    assert found.agg(F.max("chunk")).first()[0] == 3
    ids = found.select(F.explode("tokens").alias("t")).filter("t <> 'w'")
    assert ids.distinct().count() == ids.count() == sampled.count()


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_chunks_are_cut_by_tokens(spark, most):
    draw = np.random.default_rng(1)
    rows = [(g, i, [f"{g}{i}.{j}" for j in range(draw.integers(0, 40))])
            for g in ("a", None, "b") for i in range(60)]
    rows += [("a", 3, ["twice"])] * 50 + [("c", 1, None), ("c", None, []), ("d", None, ["x"] * 3)]
    df = spark.createDataFrame(rows, "g string, i int, t array<string>").repartition(5)
    found = collect_chunks(df, ["g"], "t", ["i"], most).collect()
    for group in ("a", None, "b", "c", "d"):
        chunks = sorted((r.chunk, r.tokens) for r in found if r.g == group)
        joined = [token for _, tokens in chunks for token in tokens]
        assert [c for c, _ in chunks] == list(range(-(-len(joined) // most)))
        assert all(len(tokens) == most for _, tokens in chunks[:-1])
        own = [(i is not None, i or 0, t) for g, i, t in rows if g == group and t]
        if group != "a":
            assert joined == [token for *_, tokens in sorted(own) for token in tokens]
        assert sorted(joined) == sorted(token for *_, tokens in own for token in tokens)
    assert collect_chunks(df.limit(0), ["g"], "t", ["i"], most).count() == 0


def test_slices_may_be_null_or_empty(spark):
    rows = [(s, t) for s in ("", None, "x") for t in (["a", "b"], ["a", "c", "c"], ["b", "c"])]
    df = spark.createDataFrame(rows, "s string, tokens array<string>")
    found = topics(df, "tokens", k=2, terms=2, max_df=4, vocab=9, slice="s").collect()
    assert {r.s for r in found} == {"", None, "x"}
    weights = {s: [r.weight for r in found if r.s == s] for s in ("", None, "x")}
    assert weights[""] == pytest.approx(weights["x"])
    assert weights[None] == pytest.approx(weights["x"])
    df = df.withColumn("g", F.concat_ws("-", "tokens"))
    words = group_keywords(df, "g", "tokens", max_df=9, below=None, slice="s").collect()
    by_slice = {
        s: sorted((r.g, r.term, r.weight) for r in words if r.s == s) for s in ("", None, "x")
    }
    assert by_slice[""] == by_slice[None] == by_slice["x"] != []


def test_topics_by_file(spark, tmp_path):
    rows = [(["a", "b"],), (["a", "c", "c"],), (["b", "c"],), (["d", "a"],)]
    df = spark.createDataFrame(rows, "tokens array<string>").coalesce(1)
    for _ in range(2):
        df.write.mode("append").parquet(str(tmp_path / "t"))
    scan = with_slice(read_parquet(spark, str(tmp_path / "t")), "file")
    found = topics(scan, "tokens", k=1, terms=2, max_df=4, vocab=9, slice="file")
    assert found.count() == 4 and found.select("file").distinct().count() == 2


def test_embedding(spark, docs, tmp_path):
    model = emb.fit_embedding(docs, "tokens", seed=1, dims=20)
    path = str(tmp_path / "model")
    model.save(path)
    a = emb.embed(docs, model, "tokens").orderBy("doc_id").select("embedding").limit(20).collect()
    loaded = emb.load_embedding(path)
    b = emb.embed(docs, loaded, "tokens").orderBy("doc_id").select("embedding").limit(20).collect()
    assert a == b and all(len(r.embedding) == 20 for r in a)


def test_embedding_keeps_every_word_often_enough(spark):
    df = spark.createDataFrame(
        [(["a"] * 9 + ["b"] * 5 + ["c"] * 4 + ["d"],)], "tokens array<string>"
    )
    for least, words in ((1, {"a", "b", "c", "d"}), (5, {"a", "b"})):
        model = emb.fit_embedding(df, "tokens", seed=1, dims=4, min_count=least)
        assert {r.word for r in model.getVectors().collect()} == words
