"""Searches over vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import exact_top_k as exact
from lexloom.llm import neighbours, vectors
from lexloom.llm.exact_top_k import exact_top_k
from lexloom.llm.neighbours import Index, nearest_by_product
from lexloom.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")
# (vec_id, embedding): ties, repeats, and vectors that take no part.
ROWS = [
    (0, [1.0, 0.5]),
    (1, [0.5, 1.0]),
    (2, [0.5, 1.0]),
    (2, [0.5, 1.0]),
    (3, [-1.0, 0.0]),
    (4, [0.001, -0.001]),
    (5, None),
    (6, []),
    (7, [1.0, None]),
    (8, [NAN, 1.0]),
    (9, [INF, 1.0]),
    (None, [1.0, 1.0]),
    (10, [0.0, 0.0]),
    (11, [2.0]),
]


def _table(spark, rows=ROWS, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn(
        "score", F.lit("clash")
    )


def _used(rows, zero=True):
    used = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            used[key] = np.pad(np.array(v, float), (0, 2 - len(v)))
    return used


def _brute(used, queries, k, score):
    out = []
    for q in sorted(queries):
        ranked = sorted((-score(used[q], v), key) for key, v in used.items() if key != q)
        out += [(q, rank, key, -s) for rank, (s, key) in enumerate(ranked[:k], 1)]
    return out


def _sorted(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


def _integer(a, b):
    return int(np.floor(256 * a) @ np.floor(256 * b))


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_exact_search_of_awkward_rows(spark, kind, k):
    rows = [(key, v and [None if x is None else float(np.float32(x)) for x in v]) for key, v in ROWS]
    used = _used(rows)
    found = _sorted(exact_top_k(_table(spark, rows, kind), F.col("id") >= 0, k))
    assert found == _brute(used, used, k, _integer)


def test_exact_search_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact, "QUERY_BLOCK", 40)
    draw = np.random.default_rng(1)
    values = draw.standard_normal((600, 2)) * draw.exponential(1, (600, 1))
    rows = [(i, [float(x) for x in np.round(v, 2)]) for i, v in enumerate(values)]
    found = exact_top_k(_table(spark, rows, "double"), F.col("id") % 3 == 0, 4, block=50)
    used = _used(rows)
    assert _sorted(found) == _brute(used, [i for i in used if i % 3 == 0], 4, _integer)


def test_exact_search_of_nothing_and_of_too_much(spark):
    assert exact_top_k(_table(spark, []), F.col("id") >= 0, 3).count() == 0
    assert exact_top_k(_table(spark), F.col("id") < 0, 3).count() == 0
    with pytest.raises(Exception, match="does not fit a long"):
        rows = [(1, [1e9]), (2, [2e9])]
        exact_top_k(_table(spark, rows, "double"), F.col("id") >= 0, 3).collect()


@pytest.mark.parametrize("size", [5e4, 3e6, 7e6])
def test_exact_search_of_large_components(spark, size):
    draw = np.random.default_rng(3)
    values = draw.uniform(-size, size, (300, 2))
    # Scores that differ in their last digits only.
    values[100:] = np.floor(values[100]) + np.arange(200)[:, None] / 256
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    found = _sorted(exact_top_k(_table(spark, rows, "double"), F.col("id") % 10 == 0, 4, block=64))
    used = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    score = lambda a, b: a[0] * b[0] + a[1] * b[1]
    assert found == _brute(used, [i for i in used if i % 10 == 0], 4, score)


def test_exact_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    used = {r.vec_id: np.array(r.embedding, float) for r in rows}
    expected = _brute(used, [i for i in used if i % 50 == 0], 5, _integer)
    assert _sorted(QUERIES["op7_exact_top_k"](spark, sf)) == expected


def test_small_tables_are_searched_whole(spark):
    used = _used(ROWS, zero=False)
    found = _sorted(nearest_by_product(_table(spark), F.col("id") >= 0, 20))
    expected = _brute(used, used, 20, lambda a, b: float(a @ b))
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], rtol=1e-6)
    assert nearest_by_product(_table(spark, []), F.col("id") >= 0, 20).count() == 0


def test_neighbours_query_finds_most(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    used = {r.vec_id: np.array(r.embedding, float) for r in rows}
    queries = [i for i in used if i % 20 == 0]
    found = _sorted(QUERIES["op6_neighbours"](spark, sf))
    nearest = {r[:1] + r[2:3] for r in _brute(used, queries, 20, lambda a, b: float(a @ b))}
    assert len(nearest & {(q, i) for q, _, i, _ in found}) >= 0.9 * len(nearest)
    for query, _, key, score in found:
        assert query != key and abs(used[query] @ used[key] - score) < 1e-12
    by_rank = sorted(found, key=lambda r: (r[0], -r[3], r[2]))
    assert [r[2] for r in by_rank] == [r[2] for r in sorted(found, key=lambda r: r[:2])]


@pytest.mark.parametrize("kind", ["unit", "one long", "very long", "log-normal", "tiny"])
def test_neighbours_of_uneven_lengths(spark, kind):
    draw = np.random.default_rng(1)
    values = draw.standard_normal((1500, 64))
    values /= np.sqrt((values**2).sum(axis=1, keepdims=True))
    if kind in ("one long", "very long"):
        values[7] *= 10 if kind == "one long" else 1e6
    if kind == "log-normal":
        values *= draw.lognormal(0, 1, (1500, 1))
    if kind == "tiny":
        values[:40] *= 1e-180
    used = dict(enumerate(values))
    rows = [(i, v.tolist()) for i, v in used.items()]
    found = _sorted(nearest_by_product(_table(spark, rows, "double"), F.col("id") % 20 == 0, 20))
    queries = [i for i in used if i % 20 == 0]
    nearest = {r[:1] + r[2:3] for r in _brute(used, queries, 20, lambda a, b: float(a @ b))}
    assert len(found) == 20 * len(queries)
    assert len(nearest & {(q, i) for q, _, i, _ in found}) >= 0.9 * len(nearest)


def test_a_query_without_candidates_meets_all(spark):
    few = Index(tables=1, functions=4, width=0.01, probes=1)
    draw = np.random.default_rng(1)
    used = dict(enumerate(draw.standard_normal((300, 2))))
    rows = [(i, v.tolist()) for i, v in used.items()]
    for k in (20, 400):
        found = _sorted(nearest_by_product(_table(spark, rows, "double"), F.col("id") < 9, k, few))
        expected = _brute(used, range(9), k, lambda a, b: float(a @ b))
        assert [r[:3] for r in found] == [r[:3] for r in expected]


def test_equal_vectors_and_hot_buckets(spark, monkeypatch):
    """A third of the rows equal; blocks so small that their bucket is dealt over many cells."""
    from lexloom.llm import neighbours

    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    draw = np.random.default_rng(2)
    values = [[0.6, 0.8]] * 150 + [[float(x) for x in v] for v in draw.standard_normal((300, 2)) / 9]
    found = nearest_by_product(_table(spark, list(enumerate(values)), "double"), F.col("id") < 40, 5)
    for query, rank, key, score in _sorted(found):
        assert key == [i for i in range(7) if i != query][rank - 1] and abs(score - 1.0) < 1e-12


def test_best_drops_repeats_and_bounds(monkeypatch):
    monkeypatch.setattr(vectors, "HELD", 10)
    best = vectors.Best(2)
    for start in range(0, 30, 3):
        ids = np.arange(start, start + 3)
        best.add(np.array([1, 1, 2]), ids, ids.astype(float))
        best.add(np.array([1, 1, 2]), ids, ids.astype(float))
    queries, ids, _ = best.results()
    assert queries.tolist() == [1, 1, 2, 2] and ids.tolist() == [28, 27, 29, 26]
    assert best.bounds(np.array([1, 2, 3])).tolist()[2] == -np.inf


def test_blocks_are_ranked_only_where_many_reach_the_bound(monkeypatch):
    """With bounds that few vectors reach, the k-th best of a block is not looked for."""
    rng = np.random.default_rng(2)
    given, queries = rng.normal(size=(500, 8)), rng.normal(size=(9, 8))
    find = neighbours._score(5)(given, np.arange(500))
    scores = queries @ given.T
    ranked, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda x, *rest, **more: ranked.append(len(x)) or partition(x, *rest, **more))
    bounds = np.sort(scores, axis=1)[:, -7]
    row, ids, found = find(queries, bounds)
    assert not ranked and row.size == 63
    bounds[3] = -np.inf
    again, other_ids, _ = find(queries, bounds)
    assert ranked == [1] and np.isneginf(bounds[3])
    for q in range(9):
        best = set(np.argsort(-scores[q])[:5].tolist())
        assert best <= set(ids[row == q].tolist()) and best <= set(other_ids[again == q].tolist())


def test_results_of_many_queries_are_not_sorted_at_every_addition(monkeypatch):
    """Also where the best of all queries are more than may be held."""
    monkeypatch.setattr(vectors, "HELD", 50)
    sorts, results = [], vectors.Best.results
    monkeypatch.setattr(vectors.Best, "results", lambda self: sorts.append(1) or results(self))
    rng = np.random.default_rng(4)
    best, all_scores = vectors.Best(2), rng.random((40, 300))
    for i in range(300):
        best.add(np.arange(40), np.full(40, i), all_scores[:, i])
    assert len(sorts) < 200
    queries, ids, scores = best.results()
    assert np.array_equal(scores.reshape(40, 2), -np.sort(-all_scores, axis=1)[:, :2])
    assert np.array_equal(best.bounds(np.arange(40)) <= scores[1::2], np.full(40, True))
