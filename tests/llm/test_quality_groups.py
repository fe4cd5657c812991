"""Documents are labelled together within a bound of lines filled up."""

from __future__ import annotations

import numpy as np

from lexloom.llm import quality


def test_a_long_document_is_labelled_alone(monkeypatch):
    seen, marginals = [], quality.Field.marginals

    def watched(self, sizes, features):
        seen.append(len(sizes) * int(sizes.max()))
        return marginals(self, sizes, features)

    monkeypatch.setattr(quality.Field, "marginals", watched)
    draw = np.random.default_rng(1)
    field = quality.Field.from_values(draw.standard_normal(quality.WEIGHTS + 5))
    slots = quality.line_slots(["a b.\nc"] * 300 + ["x y z\n" * 50_000, ""])
    monkeypatch.setattr(quality, "LONG_LINES", 10**9)
    whole = field.means(slots)
    assert seen and max(seen) <= quality.CELLS_AT_ONCE
    monkeypatch.setattr(quality, "CELLS_AT_ONCE", 1)
    assert np.allclose(field.means(slots), whole, rtol=1e-12)


def test_segments_give_the_same_marginals(monkeypatch):
    draw = np.random.default_rng(2)
    field = quality.Field.from_values(draw.standard_normal(quality.WEIGHTS + 5))
    lines = ["".join(draw.choice(list("aB .1#"), 12)) for _ in range(1000)]
    for n in (1, 2, 3, 10, 997, 1000):
        ((slots, _),) = quality.line_slots(["\n".join(lines[:n])])
        good, _ = field.marginals(np.array([n]), quality._features(slots))
        for stretch in (7, 5000):
            monkeypatch.setattr(quality, "LONG_LINES", stretch)
            assert np.allclose(field.long_marginals(slots), good, rtol=1e-9)


def test_a_document_of_a_million_lines_has_a_score():
    field = quality.Field.from_values(np.random.default_rng(3).standard_normal(quality.WEIGHTS + 5))
    slots = quality.line_slots(["a b c.\n" * 1_000_000])
    assert 0 < field.score(slots)[0] < 1


def test_the_sample_is_bounded_in_documents_and_lines(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "train", lambda documents: taken.append(documents))
    rows = [(i, f"line {i}\n" * (1 + i % 5)) for i in range(60)]
    rows += [(7, f"other {i}") for i in range(500)] + [(8, None), (None, "x"), (9, "long\n" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, i % 2) for i in range(60)] * 3 + [(7, 0)] * 9 + [(None, 1), (3, 5)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    quality.fit_quality(docs, labels, documents=40, lines=100)
    (documents,) = taken
    sizes = [len(slots) for slots, *_ in documents]
    assert len(documents) <= 40 and 80 < sum(sizes) <= 100
    quality.fit_quality(docs, labels)
    assert len(taken[1]) == 60
