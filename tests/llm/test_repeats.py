"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm.queries import QUERIES
from lexloom.llm.repeats import SquareCatcher, periodic_runs, text_runs
from tests.llm.cases import TEXTS, documents


def brute_runs(words, least=6, times=4):
    """For every period the stretches it holds on, without those of a smaller period."""
    n, found = len(words), {}
    for period in range(1, n // times + 1):
        at = 0
        while at + period < n:
            stop = at
            while stop + period < n and words[stop] == words[stop + period]:
                stop += 1
            if stop > at and stop + period - at >= max(least, times * period):
                found.setdefault((at, stop + period), period)
            at = max(stop, at + 1)
    return sorted((a, b - a, period) for (a, b), period in found.items())


def caught(words, sizes, least=6):
    catcher, at, turn = SquareCatcher(), 0, 0
    while at < len(words):
        size = sizes[turn % len(sizes)]
        catcher.append(words[at : at + size])
        at, turn = at + size, turn + 1
    return sorted(catcher.runs(least))


@st.composite
def periodic_words(draw):
    out = []
    for _ in range(draw(st.integers(0, 6))):
        block = draw(st.lists(st.integers(0, draw(st.integers(0, 3))), min_size=1, max_size=9))
        out += block * draw(st.integers(1, 9))
        out += draw(st.lists(st.integers(0, 2), max_size=4))
    return out


@given(periodic_words(), st.lists(st.integers(1, 40), min_size=1, max_size=3))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force_however_words_come(words, sizes):
    assert caught(words, sizes) == brute_runs(words)
    assert caught(words, [1]) == caught(words, [10_000]) == brute_runs(words)


def test_long_periods_and_nested_runs():
    draw = random.Random(5)
    inner = [draw.randrange(50) for _ in range(37)] * 6 + [99]
    words = inner * 5 + [draw.randrange(3) for _ in range(200)]
    assert caught(words, [len(words)]) == caught(words, [64]) == brute_runs(words)
    # One word between stretches of one word: every block meets many equal ones.
    words = ([7] * 40 + [8] + [7] * 90 + [8]) * 5
    assert caught(words, [len(words)]) == caught(words, [33]) == brute_runs(words)


def test_a_long_text_takes_bounded_steps():
    n = 400_000
    block = np.random.default_rng(1).integers(0, 10**9, 70_001)
    words = np.concatenate([np.tile(block, 5)[:290_000], np.zeros(n - 290_000, np.int64)])
    found = caught(words, [1 << 17])
    assert [(a, b, p) for a, b, p in found] == [(0, 290_000, 70_001), (290_000, 110_000, 1)]


@given(st.lists(st.text(alphabet="ab \n", max_size=60) | st.none(), max_size=12))
@settings(max_examples=100, deadline=None)
def test_texts_do_not_reach_into_each_other(texts):
    found, pieces = text_runs(pa.array(texts, pa.string()), 6)
    for text, runs, (numbers, words) in zip(texts, found, pieces):
        own = (text or "").encode().split()
        assert [words[i].encode() for i in numbers] == own
        assert sorted(runs) == brute_runs(own)


def test_awkward_tables(spark):
    docs = documents(spark, [*TEXTS, "a b " * 3 + "a b a", "x"], runs="clash", n_words=1, collapsed=2)
    docs = docs.union(docs.limit(9)).union(docs.selectExpr("null", *docs.columns[1:]).limit(2))
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count()
    texts = {i: t for i, t in enumerate([*TEXTS, "a b " * 3 + "a b a", "x"])}
    for r in rows:
        if r.doc_id is not None:
            own = (texts[r.doc_id] or "").encode().split()
            assert [tuple(x) for x in r.runs] == brute_runs(own, times=4) if len(own) < 100 else True
            assert r.n_words == len(own)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[11].collapsed == "word" and [tuple(x) for x in by_id[11].runs] == [(0, 5000, 1)]
    assert by_id[12].collapsed == "a b" and [tuple(x) for x in by_id[12].runs] == [(0, 9, 2)]
    assert by_id[0].collapsed == "" and by_id[0].runs == []
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="names of results"):
        periodic_runs(docs, keep=("runs",))


def looped(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_against_brute_force(spark, sf):
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    with_runs = 0
    for doc in docs:
        words = looped((doc.text or "").encode().split(), doc.doc_id)
        runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
        row = rows[doc.doc_id]
        assert row.n_runs == len(runs)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = [True] * len(words)
        for start, length, period in runs:
            kept[start + period : start + length] = [False] * (length - period)
        text = b" ".join([w for w, k in zip(words, kept) if k])
        assert row.collapsed_sha256 == hashlib.sha256(text).hexdigest()
        if runs:
            start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
            assert (row.start, row.length, row.period) == (start, length, period)
            assert row.exponent_milli == 1000 * length // period
            with_runs += 1
        else:
            assert row.start is row.length is row.period is row.exponent_milli is None
    assert with_runs > 5
