"""The pipeline against its stages' meaning, and on awkward tables."""

from __future__ import annotations

import random
from array import array

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from lexloom.llm import queries
from lexloom.llm.quality import fit_quality, quality_scores
from lexloom.sources.staging import application_dir
from tests.llm.cases import TEXTS, documents
from tests.llm.test_simhash import _components, _print_of
from tests.llm.test_texts import _deduped
from tests.llm.test_tokens import WORDS, _check_packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _folder(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(path)} if system.exists(path) else set()


def test_stages_one_by_one(spark, sf, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "simhash", "secrets", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = [docs.orderBy("doc_id").collect()]
    for name, function in corpus_pipeline.STAGES:
        made = function(spark, docs, sf)
        if name != "packing":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        tables.append(docs.orderBy("doc_id").collect())
    raw, good, without, single, clean, packed = tables

    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(~queries.held_out())
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    scores = quality_scores(whole, fit_quality(whole, labels)).collect()
    kept = {r.doc_id for r in scores if r.score >= 0.3}
    assert good == [r for r in raw if r.doc_id in kept] and 0 < len(good) < len(raw)

    texts = [text for text, _ in _deduped([r.text for r in good], 50)]
    assert [r.text for r in without] == texts
    assert all(r.n_chars == len(r.text) for r in without)

    prints = {r.doc_id: _print_of(r.text) for r in without}
    groups = _components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert single == [r for r in without if r.doc_id in set(groups.values())]

    assert [r.doc_id for r in clean] == [r.doc_id for r in single]
    for old, new in zip(single, clean):
        assert (old.text == new.text) or "[secret]" in new.text

    tokenizer = Tokenizer.from_file(WORDS)
    ids = {}
    for r in packed:
        ids.setdefault(r.doc_id, {})[r.piece] = array("I", bytes(r.ids)).tolist()
    for r in clean:
        joined = sum([ids[r.doc_id][i] for i in sorted(ids[r.doc_id])], [])
        assert joined == tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
    assert len(ids) == len(clean)
    _check_packed(packed, 4096)


def test_run_leaves_only_what_its_result_reads(spark, sf):
    before = _folder(spark)
    found = corpus_pipeline.run(spark, sf)
    assert found.count() > 0 and found.columns[-2:] == ["sequence_id", "offset"]
    left = _folder(spark) - before
    assert not any(name.startswith(("quality", "line_dedup", "secrets")) for name in left)


CLASHES = {name: 1 for name in ("row", "key", "score", "number", "fingerprint", "component_id")}


@pytest.mark.parametrize("name,function", corpus_pipeline.STAGES)
def test_awkward_tables(spark, sf, name, function):
    draw = random.Random(1)
    texts = [*TEXTS, " ".join(draw.choice(["river", "stone", "the", "walk."]) for _ in range(80))] * 2
    docs = documents(spark, texts, **CLASHES, deleted_runs="c", spans="c", piece=3, ids="c", length=1)
    docs = docs.union(docs.limit(3)).union(docs.limit(4).selectExpr("null", *docs.columns[1:]))
    made = function(spark, docs, sf)
    rows = made.collect()
    if name != "packing":
        assert made.columns == docs.columns
        assert all(r.score == 1 and r.deleted_runs == "c" and r.row == 1 for r in rows)
    if name in ("line_dedup", "secrets"):
        assert len(rows) == docs.count()
    assert function(spark, docs.limit(0), sf).count() == 0
