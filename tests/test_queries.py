"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from lexloom.oracles import SQL
from lexloom.queries import QUERIES
from tests.compare import connect, differences

WITHOUT_SQL = {
    "spark_sample",
    "word2vec_nearest",
    "paragraph_nearest",
    "leaders_drift",
    "svm_metrics",
    "topics",
    "topics_by_lang",
    "cluster_members",
    "cluster_quality",
}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_only_models_and_samplers_lack_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) == ""


def test_leaders_drift_has_a_row_per_party(spark, sf):
    found = QUERIES["leaders_drift"](spark, sf).collect()
    assert {r.party for r in found} <= {"de", "en", "es", "fr"} and len(found) > 1
    assert all(-1.0 <= r.similarity <= 1.0 for r in found)


@pytest.mark.parametrize("name", ["word2vec_nearest", "paragraph_nearest"])
def test_embeddings_give_every_source_its_neighbours(spark, sf, name):
    found = QUERIES[name](spark, sf).collect()
    assert len(found) == 20 * 5 and all(r.source != r.other for r in found)


def test_spark_samples_come_from_the_table(spark, sf):
    found = {r.doc_id for r in QUERIES["spark_sample"](spark, sf).collect()}
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    assert 0 < len(found) < documents.count()
    assert found <= {r.doc_id for r in documents.select("doc_id").collect()}


def test_entry(spark):
    found = entry_point.entry(spark)
    assert found.columns == ["source", "term", "tf", "weight"]
    assert found.count() > 0
