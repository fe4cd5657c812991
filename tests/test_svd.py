"""Decompositions of many matrices at once against NumPy."""

from __future__ import annotations

import importlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from lexloom.operators import svd
from lexloom.operators.svd import truncated_svd
from lexloom.operators.terms import sliced_tfidf

# The package has a function of the same name.
topics_plan = importlib.import_module("lexloom.plans.topics")

SCHEMA = "part string, row long, term string, weight double"


def sparse(draw, rows, terms, share, strong=0):
    """A random matrix; the first `strong` columns of a rank-one structure stand out."""
    m = draw.standard_normal((rows, terms)) * (draw.random((rows, terms)) < share)
    for i in range(strong):
        m[i::7, i :: strong + 3] += 3.0 / (i + 1)
    return m


def entries(spark, matrices):
    rows = [
        (part, int(i), f"t{j}", float(m[i, j]))
        for part, m in matrices.items()
        for i, j in zip(*np.nonzero(m))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def check(found, matrices, k):
    by_part = {}
    for r in found.collect():
        by_part.setdefault(r.part, {}).setdefault(r.concept, []).append(r)
    assert set(by_part) == {part for part, m in matrices.items() if m.any()}
    for part, concepts in by_part.items():
        m = matrices[part]
        values = np.linalg.svd(m)[1]
        rank = min(k, int((values > 1e-9 * values[0]).sum()))
        assert sorted(concepts) == list(range(1, rank + 1))
        for concept, rows in concepts.items():
            v = np.zeros(m.shape[1])
            for r in rows:
                v[int(r.term[1:])] = r.weight
            value = rows[0].singular_value
            assert value == pytest.approx(values[concept - 1], rel=1e-6)
            assert np.linalg.norm(v) == pytest.approx(1.0, abs=1e-6)
            # A right singular vector, whatever its sign.
            assert np.linalg.norm(m.T @ (m @ v) / value**2 - v) < 2e-4
            assert v[np.abs(v).argmax()] > 0


def test_many_small_parts(spark):
    draw = np.random.default_rng(1)
    matrices = {f"p{i}": sparse(draw, 3 + i % 9, 2 + i % 7, 0.6) for i in range(150)}
    matrices[None] = sparse(draw, 8, 8, 0.5)
    matrices[""] = np.outer(np.arange(1, 5), np.arange(1, 4)).astype(float)  # of rank one
    check(truncated_svd(entries(spark, matrices), 3), matrices, 3)


def test_parts_of_one_block_are_iterated_in_their_task(spark, monkeypatch):
    monkeypatch.setattr(svd, "DENSE", 1)
    draw = np.random.default_rng(2)
    matrices = {"a": sparse(draw, 80, 60, 0.2, 4), "b": sparse(draw, 70, 90, 0.1, 5)}
    check(truncated_svd(entries(spark, matrices), 4), matrices, 4)


def test_parts_of_several_blocks_are_iterated_together(spark):
    draw = np.random.default_rng(3)
    matrices = {"a": sparse(draw, 90, 50, 0.3, 4), "b": sparse(draw, 130, 40, 0.3, 5)}
    matrices["small"] = sparse(draw, 20, 30, 0.3)
    check(truncated_svd(entries(spark, matrices), 4, block_rows=45), matrices, 4)


def test_far_apart_and_vanishing_values(spark):
    draw = np.random.default_rng(4)
    left, right = (np.linalg.qr(draw.standard_normal((n, n)))[0] for n in (60, 30))
    values = np.zeros(30)
    values[:5] = [1e3, 1e2, 1e1, 1.0, 1e-3]
    matrices = {"far": left[:, :30] * values @ right.T}
    for blocks in (20, 100):
        found = truncated_svd(entries(spark, matrices), 4, block_rows=blocks)
        strengths = {r.concept: r.singular_value for r in found.collect()}
        assert [strengths[i] for i in (1, 2, 3, 4)] == pytest.approx(values[:4].tolist(), rel=1e-4)


def test_nothing_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert truncated_svd(empty, 3).collect() == []
    with pytest.raises(ValueError, match="names of results"):
        truncated_svd(empty.withColumnRenamed("part", "concept"), 3, part="concept")


def test_blocks_of_a_part_are_tasks_of_their_own(spark):
    """Neither the join with the sizes nor the packing brings a part to one task."""
    rows = spark.range(4000).selectExpr("id % 1 + 7 AS part", "id % 900 AS row", "id AS term_hash", "1D AS weight")
    several = spark.createDataFrame([(7, 6)], "part bigint, several int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = svd._dealt(rows, several)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning(part" not in plan
        placed = svd._together(dealt, 8).select("block", F.spark_partition_id().alias("at"))
        placed = {(r.block, r.at) for r in placed.distinct().collect()}
        assert len(placed) == 6 == len({at for _, at in placed})
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entries_pass_the_rounds_as_bytes(spark):
    """A block's entries go through a task in every round; as arrays that took most of it."""
    draw = np.random.default_rng(5)
    rows = entries(spark, {"a": sparse(draw, 9, 7, 0.6)}).selectExpr(
        "xxhash64(part) AS part", "xxhash64(row) AS row", "xxhash64(term) AS term_hash", "weight"
    )
    several = spark.createDataFrame([], "part bigint, several int")
    packed = svd._packed(svd._dealt(rows, several), 2)
    assert dict(packed.dtypes)["rows"] == dict(packed.dtypes)["weights"] == "binary"
    (block,) = packed.collect()
    assert len(block.weights) == 2 * len(block.rows) == 8 * rows.count() == 8 * block.ends[-1]


def test_tokens_of_slices_are_counted_once(spark, monkeypatch):
    """Terms of documents are a table, not worked out for each of the tables that read them."""
    read = []

    def weighted(rows, *rest):
        read.append(bool(rows.inputFiles()) and "Generate" not in rows._jdf.queryExecution().toString())
        return sliced_tfidf(rows, *rest)

    monkeypatch.setattr(topics_plan, "sliced_tfidf", weighted)
    df = spark.createDataFrame([("x", ["a", "b"]), ("x", ["a", "c"]), ("y", ["b"])], "s string, t array<string>")
    assert topics_plan.topics(df, "t", k=1, max_df=4, slice="s").count() > 0 and read == [True]
