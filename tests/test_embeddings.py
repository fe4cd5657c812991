"""Word vectors trained as tables, and their means."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lexloom import queries
from lexloom.operators import blocks
from lexloom.operators import embeddings as emb
from lexloom.operators.blocks import union
from lexloom.sources.staging import remove


def planted(n):
    """(id, topic, tokens): words of one topic stand together."""
    draw = random.Random(3)
    return [(i, i % 2, [f"w{i % 2}_{draw.randrange(20)}" for _ in range(30)]) for i in range(n)]


@pytest.mark.parametrize("part_tokens, iterations", [(10**6, 3), (6000, 8)])
def test_words_that_stand_together_are_near(spark, part_tokens, iterations):
    df = spark.createDataFrame(planted(600), "id int, topic int, tokens array<string>")
    model = emb.fit_embedding(
        df, "tokens", 1, 16, iterations=iterations, partitions=1, part_tokens=part_tokens
    )
    rows = model.getVectors().collect()
    m = np.array([r.vector.toArray() for r in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    similar = m @ m.T
    np.fill_diagonal(similar, -9)
    topics = np.array([r.word[1] for r in rows])
    assert len(rows) == 40 and (topics[similar.argmax(axis=1)] == topics).mean() > 0.95


def test_no_vector_reaches_the_driver(spark):
    """The model is a table; a vocabulary larger than the driver's memory can be trained."""
    df = spark.createDataFrame(planted(20), "id int, topic int, tokens array<string>")
    model = emb.fit_embedding(df, "tokens", 1, 4)
    assert model.words.columns == ["word", "hash", "vector"] and model.words.inputFiles()


def test_means_of_awkward_rows(spark):
    rows = [(1, ["a"] * 5 + ["b"] * 5), (2, None), (3, []), (4, ["once"]), (5, ["a", None, "b", "once"])]
    rows += [(6, ["a", "b"])] * 2 + [(None, ["b"])]
    df = spark.createDataFrame(rows, "row int, words array<string>")
    model = emb.fit_embedding(df, "words", 1, 3)
    of = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    assert set(of) == {"a", "b"}
    found = emb.embed(df, model, "words", "v").collect()
    assert len(found) == len(rows)
    for r in found:
        mean = sum((of.get(w, np.zeros(3)) for w in r.words or []), np.zeros(3)) / max(len(r.words or []), 1)
        assert np.allclose(r.v, mean)
    assert emb.embed(df.limit(0), model, "words").count() == 0
    with pytest.raises(ValueError):
        emb.fit_embedding(df, "words", 1, 3, min_count=100)


def test_parts_are_worked_on_in_waves(spark, monkeypatch):
    """No more parts than a wave's have words on the disk, and waves change no vector."""
    df = spark.createDataFrame(planted(60), "id int, topic int, tokens array<string>").coalesce(2)

    def vectors():
        model = emb.fit_embedding(df, "tokens", 1, 4, iterations=2, partitions=5)
        made = emb.embed(df, model, "tokens", part_tokens=100).collect()
        return {r.word: r.vector for r in model.words.collect()}, {r.id: r.embedding for r in made}

    whole, sent, meeting = vectors(), [], emb._meeting

    def counted(docs, known, wave):
        sent.append(known.select("block").distinct().count())
        return meeting(docs, known, wave)

    monkeypatch.setattr(emb, "_meeting", counted)
    monkeypatch.setattr(blocks, "WAVE", 3)
    monkeypatch.setattr(blocks, "WAVE_PER_CORE", 0)
    for one, other in zip(whole, vectors()):
        assert one and all(np.allclose(one[i], other[i], atol=1e-5) for i in one)
    assert sent[:4] == [3, 2, 3, 2] and max(sent) <= 3 and len(sent) == 4 + 18 // 3


@pytest.fixture
def tables(spark, tmp_path):
    """Documents of planted words, and an order with the number of each."""
    texts = [(i, " ".join(f"word{'abcdefgh'[j % 8]}" for j in range(i, i + 9))) for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    docs = docs.selectExpr("*", "'en' AS lang", "concat('c', doc_id % 2) AS source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    dates = "date_add(DATE'1995-01-01', CAST(doc_id * 25 AS int)) AS o_orderdate"
    docs.selectExpr("doc_id AS o_orderkey", dates).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_speeches_in_csv_go_when_they_are_read(spark, tables, monkeypatch):
    gone = []
    monkeypatch.setattr(queries, "remove", lambda spark, path: gone.append(path) or remove(spark, path))
    found = queries.leaders_drift(spark, tables).collect()
    assert [r.party for r in found] == ["en"] and len(gone) == 1 and "speeches" in gone[0]


def test_means_in_waves_of_documents(spark, tables, monkeypatch):
    """The means are worked out wave by wave, and every document is in one."""
    made = []
    monkeypatch.setattr(queries, "union", lambda tables: made.extend(tables) or union(tables))
    monkeypatch.setattr(queries, "WAVE_DOCUMENTS", 40)
    assert queries.embedding_means(spark, tables).first().asDict() == {"n": 90, "differing": 0}
    assert len(made) == 3 and sum(x.count() for x in made) == 90
