"""SimHash groups against all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import components, simhash
from lexloom.llm.components import connected_components
from lexloom.llm.queries import QUERIES
from lexloom.sources import Staging
from tests.llm.cases import TEXTS, documents


def _print_of(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


@given(st.sets(st.integers(0, 63), max_size=3))
@settings(max_examples=200, deadline=None)
def test_some_mask_leaves_out_any_three_bits(bits):
    differing = sum(1 << b for b in bits)
    assert any(not mask & differing for mask in simhash.covering_masks(list(range(64)), 3))


def test_masks_of_other_radii_cover_too():
    draw = random.Random(2)
    for radius in (0, 1, 5):
        masks = simhash.covering_masks(list(range(64)), radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(200):
            differing = sum(1 << b for b in draw.sample(range(64), radius))
            assert any(not mask & differing for mask in masks)


def test_query_equals_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {r.doc_id: _print_of(r.text) for r in rows}
    expected = _components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = QUERIES["op1_simhash"](spark, sf).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in found} == expected


@pytest.mark.parametrize("bucket", [4096, 3])
@pytest.mark.parametrize("radius", [1, 3])
def test_dense_groups(spark, monkeypatch, bucket, radius):
    """Chains and clusters of close fingerprints, with buckets that must be divided."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    draw, prints = random.Random(radius), []
    for _ in range(25):
        now = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):
            prints.append(now)
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                now ^= 1 << bit
    keys = {i: p for i, p in enumerate(prints)}
    rows = [(i, p - (1 << 64) if p >> 63 else p, "x") for i, p in keys.items()]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long, root string").repartition(4)
    found = simhash.near_groups(df, radius).collect()
    expected = _components(keys, lambda a, b: (keys[a] ^ keys[b]).bit_count() <= radius)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert len(found) == len(rows) and {r.root for r in found} == {"x"}


def test_awkward_texts(spark):
    docs = documents(spark, TEXTS, fingerprint="clash")
    found = simhash.fingerprints(docs, 3).orderBy("doc_id").collect()
    assert [r.fingerprint % 2**64 for r in found] == [_print_of(t) for t in TEXTS]
    assert simhash.near_groups(simhash.fingerprints(docs.limit(0), 3)).count() == 0


def test_null_keys_and_repeats(spark):
    far = 0xFFFF << 32
    rows = [(None, 8), (5, 8), (5, 8), (None, far), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    found = simhash.near_groups(df).select("fingerprint", "component_id").collect()
    expected = [(8, 5), (8, 5), (8, 5), (far, None), (None, None)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    clash = df.select("*", F.lit("x").alias("Component_ID"), F.lit(1).alias("joined_fingerprint"))
    again = simhash.near_groups(clash)
    assert again.columns == [*df.columns, "joined_fingerprint", "component_id", "component_root"]
    again = again.select("fingerprint", "component_id").collect()
    assert sorted(map(tuple, again), key=repr) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="names of results"):
        simhash.near_groups(df.withColumnRenamed("doc_id", "component_id"), key="component_id")


@pytest.mark.parametrize("share", [500_000, 10])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, share):
    monkeypatch.setattr(components, "EDGES_AT_ONCE", share)
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(3, 3), (None, 4)]
    edges += [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(150)]
    real = {(a, b) for a, b in edges if a is not None and a != b}
    both = real | {(b, a) for a, b in real}
    expected = _components({n for e in real for n in e}, lambda a, b: (a, b) in both)
    with Staging(spark) as staging:
        df = spark.createDataFrame(edges, "a long, b long")
        found = {r.node: r.root for r in connected_components(df, "a", "b", staging).collect()}
    assert found == {n: r for n, r in expected.items() if n != r}
