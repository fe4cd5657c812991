"""Whitening against exact covariances worked out in Python."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from lexloom.llm.queries import QUERIES
from lexloom.llm.whitening import covariances, polarised_squares, whitened

SCHEMA = "vec_id long, embedding array<double>, component int, n string"


def exact_covariance(rows):
    n, dims = len(rows), len(rows[0])
    mean = [Fraction(sum(r[i] for r in rows), n) for i in range(dims)]
    return [
        [float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in rows) / n) for j in range(dims)]
        for i in range(dims)
    ]


def check(found, vectors, components, scale=64.0, shift=1_000_000):
    """`vectors`: (key, values) of the rows that take part."""
    x = [[math.floor(scale * c) + shift for c in v] for _, v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    matrix = np.array(exact_covariance(x))
    values, turned = np.linalg.eigh(matrix)
    values, turned = values[::-1], turned[:, ::-1]
    by_key = {}
    for r in found:
        by_key.setdefault(r.vec_id, []).append(r)
        assert r.n == n and abs(r.identity_error) <= 1e-6
    assert len(found) == n * components
    for (key, _), row in zip(vectors, x):
        own = sorted(by_key[key], key=lambda r: r.component)
        assert own[0].deviation == sum((n * c - s) ** 2 for c, s in zip(row, sums))
        assert [r.component for r in own][:components] == list(range(1, components + 1))
        centred = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(row, sums)])
        for r in own:
            k = r.component - 1
            expected = centred @ turned[:, k] / math.sqrt(values[k])
            assert abs(abs(r.whitened) - abs(expected)) < 1e-6
            assert abs(r.explained - values[k] / matrix.trace()) < 1e-12
    return by_key


def test_query_against_exact_sums(spark, sf):
    found = QUERIES["op13_whitening"](spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    check(found, [(r.vec_id, list(r.embedding)) for r in rows], 32)
    # Signs are the same for all rows: whitened columns are uncorrelated.
    table = {(r.vec_id, r.component): r.whitened for r in found}
    w = np.array([[table[r.vec_id, k] for k in range(1, 33)] for r in rows])
    assert np.abs(w.T @ w / len(rows) - np.eye(32)).max() < 1e-9


def test_awkward_rows(spark):
    draw = random.Random(2)
    good = [(i, [draw.gauss(0, 1 + j) for j in range(3)]) for i in range(40)]
    good += [(40, [1e5, -3.5, 0.0])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0])]
    bad += [(54, [float("inf"), 0.0, 0.0])]
    rows = [(k, v, 9, "clash") for k, v in good + bad]
    found = whitened(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    check(found, good, 3)
    # A row twice, and one without a key, count each.
    twice = [*good, good[0], (None, [0.5, 0.5, 0.5])]
    found = whitened(spark.createDataFrame([(k, v, 9, "") for k, v in twice], SCHEMA), 2).collect()
    assert len(found) == 2 * len(twice) and found[0].n == len(twice)
    assert sum(r.vec_id is None for r in found) == 2
    # No variance, no components.
    for some in (good[:1], [(i, [1.0, 2.0]) for i in range(5)], []):
        df = spark.createDataFrame([(k, v, 9, "") for k, v in some], SCHEMA)
        made = whitened(df)
        assert made.count() == 0 and made.columns[0] == "vec_id" and len(made.columns) == 7
    # A dimension that never varies leaves one component less.
    flat = [(i, [draw.gauss(0, 1), 7.0]) for i in range(20)]
    found = whitened(spark.createDataFrame([(k, v, 9, "") for k, v in flat], SCHEMA)).collect()
    assert {r.component for r in found} == {1}
    with pytest.raises(Exception, match="do not fit a long"):
        wide = [(i, [10.0**9 * i], 9, "") for i in range(9)]
        whitened(spark.createDataFrame(wide, SCHEMA)).collect()
    with pytest.raises(Exception, match="different lengths"):
        ragged = [(1, [1.0, 2.0], 9, ""), (2, [1.0], 9, ""), (3, [4.0, 4.0], 9, "")]
        whitened(spark.createDataFrame(ragged, SCHEMA)).collect()


@pytest.mark.parametrize("size", [10, 10**6, 10**11, 10**17])
def test_squares_are_exact_at_any_size(spark, size):
    draw = random.Random(size)
    rows = [[draw.randint(-size, size) for _ in range(4)] for _ in range(30)]
    df = spark.createDataFrame([(r,) for r in rows], "x array<long>").repartition(2)
    sums = [sum(r[i] for r in rows) for i in range(4)]
    centre = tuple(round(s / 30) for s in sums)
    spread = max(abs(r[i] - centre[i]) for r in rows for i in range(4))
    squares = polarised_squares(df, centre, spread)
    expected = [
        sum((r[i] - centre[i] + (r[j] - centre[j] if i != j else 0)) ** 2 for r in rows)
        for i in range(4)
        for j in range(i, 4)
    ]
    assert squares == expected
    residues = [s - 30 * c for s, c in zip(sums, centre)]
    assert covariances(30, residues, squares).tolist() == exact_covariance(rows)
