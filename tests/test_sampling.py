from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexloom.operators.sampling import (
    first_rows,
    sample,
    sample_slices,
    sample_with_replacement,
    split,
    union_slices,
)

N = 20_000


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(N).withColumn("s", F.concat(F.lit("s"), F.col("id") % 4))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_keyed_draws_do_not_hang_on_the_layout(rows):
    other = rows.repartition(3).orderBy(F.desc("id"))
    for draw in (sample, sample_with_replacement):
        assert ids(draw(rows, 0.2, 1, ["id"])) == ids(draw(other, 0.2, 1, ["id"]))
        assert ids(draw(rows, 0.2, 1, ["id"])) != ids(draw(rows, 0.2, 2, ["id"]))


def test_rates(rows):
    assert sample(rows, 0.1, 1, ["id"]).count() == pytest.approx(N * 0.1, rel=0.1)
    drawn = ids(sample_with_replacement(rows, 0.8, 1, ["id"]))
    assert len(drawn) == pytest.approx(N * 0.8, rel=0.05)
    assert len(set(drawn)) == pytest.approx(N * (1 - 2.718281828**-0.8), rel=0.05)
    assert sample(rows, 1.0, 1, ["id"]).count() == N
    assert sample(rows, 0.0, 1, ["id"]).count() == 0


def test_keyed_copies_at_any_mean(rows):
    assert sample_with_replacement(rows, 0.0, 1, ["id"]).count() == 0
    few = rows.limit(500)
    for mean in (3.0, 60.0, 2000.0):
        n = sample_with_replacement(few, mean, 1, ["id"]).count()
        assert n == pytest.approx(500 * mean, rel=0.05)
    with pytest.raises(ValueError):
        sample_with_replacement(rows, -1.0, 1, ["id"])


def test_a_sample_can_be_split_with_its_own_seed(rows):
    sampled = sample(rows, 0.1, 7, ["id"])
    train, test = (p.count() for p in split(sampled, [0.75, 0.25], 7, ["id"]))
    assert train + test == sampled.count()
    assert test / (train + test) == pytest.approx(0.25, abs=0.03)


def test_the_same_seed_gives_the_same_rows(rows):
    for draw in (sample, sample_with_replacement):
        assert ids(draw(rows, 0.2, 5)) == ids(draw(rows, 0.2, 5))
    a, b = split(rows, [0.75, 0.25], 5)
    assert sorted(ids(a) + ids(b)) == list(range(N))
    assert ids(a) == ids(split(rows, [0.75, 0.25], 5)[0])


def test_split_by_key_keeps_every_row_once(rows):
    parts = [ids(p) for p in split(rows, [3, 1, 1], 5, ["id"])]
    assert sorted(sum(parts, [])) == list(range(N))
    assert len(parts[0]) == pytest.approx(N * 0.6, rel=0.05)


def test_slices_have_their_own_rates(rows):
    found = sample_slices(rows, "s", {"s0": 1.0, "s1": 0.5}, 0.1, 1, ["id"])
    sizes = {r.s: r["count"] for r in found.groupBy("s").count().collect()}
    assert sizes["s0"] == N / 4
    assert sizes["s1"] == pytest.approx(N / 8, rel=0.1)
    assert sizes["s2"] == pytest.approx(N / 40, rel=0.2)


def test_union_matches_columns_by_name(rows):
    swapped = rows.select("s", "id")
    assert union_slices([rows, swapped]).filter("s = 's1'").count() == N / 2


def test_first_rows(rows):
    assert ids(first_rows(rows.repartition(7), 3, ["id"])) == [0, 1, 2]
