from __future__ import annotations

import numpy as np
import pytest

from lexloom.operators.nearest import nearest
from lexloom.operators.pivots import nearest_by_pivots, pivot_count, pivot_search, spread


def table(spark, vectors, kind="array<double>"):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"e long, v {kind}")


def ranked(found):
    return [
        (r.e, r["rank"], r.other, r.similarity) for r in found.orderBy("e", "rank").collect()
    ]


def clustered(seed=3, clusters=6, each=60, dims=8, width=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return np.repeat(centres, each, axis=0) + width * rng.normal(size=(clusters * each, dims))


@pytest.mark.parametrize("block_rows", [7, 64, 1000])
@pytest.mark.parametrize("kind", ["clustered", "even", "ties"])
def test_equal_to_all_blocks(spark, block_rows, kind):
    rng = np.random.default_rng(9)
    vectors = {
        "clustered": clustered(each=20),
        "even": rng.normal(size=(120, 5)),
        # Few directions, of several lengths, so most similarities are tied; zeros among them.
        "ties": rng.integers(-1, 2, size=(120, 2)) * rng.integers(1, 4, size=(120, 1)),
    }[kind]
    df = table(spark, vectors)
    found = nearest_by_pivots(df, "e", "v", k=6, block_rows=block_rows, pivots=5)
    assert ranked(found) == ranked(nearest(df, "e", "v", k=6))


def test_cells_are_left_out_on_clustered_vectors(spark):
    df = table(spark, clustered())
    search = pivot_search(df, "e", "v", k=5, pivots=6)
    (made,) = search.visits().collect()
    assert search.cells == 6 and made.rows == 360 and made.all_visits == 1800
    assert made.visits == 0
    assert ranked(search.found) == ranked(nearest(df, "e", "v", k=5))


def test_a_third_of_copies_is_split_over_blocks(spark):
    vectors = [*clustered(each=20), *[[1.0] * 8] * 60]
    df = table(spark, vectors)
    search = pivot_search(df, "e", "v", k=4, block_rows=10, pivots=7)
    assert search.homes.groupBy("block").count().agg({"count": "max"}).first()[0] < 25
    assert ranked(search.found) == ranked(nearest(df, "e", "v", k=4))


def test_rows_without_a_direction_are_similar_to_none(spark):
    vectors = [[1, 0], [0, 0], [0.5, 0.1], [float("nan"), 1], [-1, 0], None, [1], [float("inf"), 0]]
    found = ranked(nearest_by_pivots(table(spark, vectors), "e", "v", k=7, pivots=2))
    assert {e for e, *_ in found} == {0, 1, 2, 3, 4, 7}
    assert len(found) == 6 * 5
    assert [row[1:] for row in found if row[0] == 1] == [
        (1, 0, 0.0), (2, 2, 0.0), (3, 3, 0.0), (4, 4, 0.0), (5, 7, 0.0)
    ]
    assert [row[2] for row in found if row[0] == 0] == [2, 1, 3, 7, 4]


def test_few_rows_and_none(spark):
    assert ranked(nearest_by_pivots(table(spark, [[1, 2]]), "e", "v")) == []
    assert ranked(nearest_by_pivots(table(spark, [[0, 0], [0, 0]]), "e", "v")) == [
        (0, 1, 1, 0.0), (1, 1, 0, 0.0)
    ]
    empty = table(spark, [[1, 2]]).filter("e < 0")
    assert ranked(nearest_by_pivots(empty, "e", "v")) == []
    only_null = table(spark, [None])
    assert ranked(nearest_by_pivots(only_null, "e", "v")) == []


def test_text_keys_floats_and_odd_names(spark):
    rng = np.random.default_rng(1)
    rows = [(f"k{i:02d}", [float(x) for x in rng.normal(size=3)], i) for i in range(40)]
    df = spark.createDataFrame(rows, "`my key` string, v array<float>, cell int")
    found = nearest_by_pivots(df, "my key", "v", k=3, pivots=4)
    other = nearest(df, "my key", "v", k=3)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, other.collect()))
    assert found.columns == ["my key", "other", "similarity", "rank"]


def test_bounds_of_parameters(spark):
    with pytest.raises(ValueError, match="pivots"):
        nearest_by_pivots(table(spark, [[1, 2]]), "e", "v", pivots=257)
    with pytest.raises(ValueError, match="k must"):
        nearest_by_pivots(table(spark, [[1, 2]]), "e", "v", k=0)
    assert [pivot_count(n) for n in (0, 1, 10_000, 10**12)] == [1, 1, 12, 256]


def test_pivots_are_spread():
    units = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]])
    assert spread(units, 3).tolist() == [[1, 0], [-1, 0], [0, 1]]
    assert len(spread(units, 9)) == 3 and len(spread(units[:0], 2)) == 0
