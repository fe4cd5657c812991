"""Byte-level BPE, token counts and packing against the libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexloom.llm import bpe
from lexloom.llm.packing import Encoder, best_two_fit, pack, tokenized_pieces
from lexloom.llm.queries import QUERIES
from lexloom.llm.token_counts import Counter as TokenCounter
from lexloom.llm.token_counts import token_counts
from tests.llm.cases import TEXTS, documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTS = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.parse_ranks(bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merger(ranks):
    return bpe.Merger(ranks)


@pytest.fixture(scope="module")
def encoder():
    return bpe._encoder(bpe.read_ranks(RANKS), PATTERN)[0]


@pytest.fixture(scope="module")
def words():
    with open(WORDS, encoding="utf-8") as file:
        return Encoder(file.read()), Tokenizer.from_file(WORDS)


def test_merges_as_the_library(merger, library):
    draw = random.Random(3)
    pieces = ["".join(draw.choice("theinsab") for _ in range(draw.randint(1, 60))) for _ in range(2000)]
    pieces += ["aab" * n + "ba" * n for n in range(1, 60)] + ["a" * 5000, "é" * 999, "ß"]
    expected = [array("I", library.encode_ordinary(p)).tobytes() for p in pieces]
    assert merger([p.encode() for p in pieces]) == expected


def test_a_pair_of_lower_rank_goes_first():
    # "ab" joins late; "aba" then has a lower rank and must come before the second "ab".
    ranks = {b"a": 0, b"b": 1, b"aba": 2, b"ab": 3}
    assert bpe.Merger(ranks)([b"abab"]) == [array("I", [2, 1]).tobytes()]
    assert bpe.Merger(ranks)([b"abab", b"ab", b"", b"bab"])[1:] == [
        array("I", x).tobytes() for x in ([3], [], [1, 3])
    ]


@given(st.lists(st.text(alphabet=" \n\t'sa1!é日x", max_size=30), max_size=20))
@settings(max_examples=30, deadline=None)
def test_encoder_equals_library(library, encoder, texts):
    found = encoder(texts, b"".join)
    assert found == [array("I", library.encode_ordinary(t)).tobytes() for t in texts]


@given(st.lists(st.text(alphabet=" \n\t'sa1!é日xA<|", max_size=30) | st.none(), max_size=20))
@settings(max_examples=30, deadline=None)
def test_word_encoder_equals_library(words, texts):
    encode, library = words
    ids, ends = encode(pa.array(texts, pa.string()))
    starts = [0, *ends.tolist()]
    found = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    special = encode(pa.array(["a <|endoftext|>b c\u3000d x"]))[0].tolist()
    assert special == library.encode("a <|endoftext|>b c\u3000d x", add_special_tokens=False).ids


def test_encode_and_decode_tables(spark, library):
    docs = documents(spark, TEXTS, ids="clash", n_tokens=7)
    encoded = bpe.encode(docs, RANKS, PATTERN).orderBy("doc_id").collect()
    expected = [library.encode_ordinary(t or "") for t in TEXTS]
    assert [list(array("I", bytes(r.ids))) for r in encoded] == expected
    assert [r.n_tokens for r in encoded] == [len(x) for x in expected]
    both = bpe.encode(docs, RANKS, PATTERN, decoded=True)
    again = bpe.decode(both.drop("decoded"), RANKS).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in again] == [(t or "").encode() for t in TEXTS]
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError, match="names of results"):
        bpe.encode(docs, RANKS, PATTERN, keep=("ids",))


def test_byte_bpe_query(spark, sf, library):
    found = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = array("I", library.encode_ordinary(row.text))
        own = found[row.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_counts_equal_library(spark, sf):
    tokenizer = Tokenizer.from_file(COUNTS)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = token_counts(documents(spark, texts, n_bytes=1), COUNTS, 100).orderBy("doc_id").collect()
    for row, text in zip(found, texts):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 100)
    assert token_counts(documents(spark, []), COUNTS, 100).count() == 0


def test_proven_tokens_encode_alone():
    with open(COUNTS, encoding="utf-8") as file:
        counter = TokenCounter(file.read())
    tokenizer = Tokenizer.from_file(COUNTS)
    some = sorted(counter.whole)[::50]
    assert len(counter.whole) > 40_000
    assert all(len(tokenizer.encode(t, add_special_tokens=False).ids) == 1 for t in some)


def test_only_byte_level_files_are_counted():
    with open(WORDS, encoding="utf-8") as file, pytest.raises(ValueError, match="byte-level"):
        TokenCounter(file.read())


def test_best_two_fit_improves_on_greedy():
    # Greedy takes 6 and 3 of 10; instead of the 3, two of 2 fill it.
    assert best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [({6: 1, 2: 2}, 1), ({3: 1}, 1)]
    assert best_two_fit({}, 10) == []
    assert best_two_fit({10: 3, 5: 5}, 10) == [({10: 1}, 3), ({5: 2}, 2), ({5: 1}, 1)]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
@settings(max_examples=60, deadline=None)
def test_best_two_fit_uses_every_piece_once(counts):
    patterns = best_two_fit(counts, 50)
    used = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(length * n for length, n in pattern.items()) <= 50
        for length, n in pattern.items():
            used[length] += n * times
    assert used == Counter(counts)
    # One step at a time gives the same sequences.
    single, left = 0, dict(counts)
    while left:
        pattern, _ = best_two_fit(left, 50)[0]
        left = {x: n - pattern.get(x, 0) for x, n in left.items() if n > pattern.get(x, 0)}
        single += 1
    assert single == sum(times for _, times in patterns)


def _check_packed(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_query(spark, sf):
    rows = QUERIES["op2_packing"](spark, sf).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    total, expected = 0, {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids + [1]
        total += len(ids)
        for piece in range(math.ceil(len(ids) / 4096)):
            part = ids[piece * 4096 : (piece + 1) * 4096]
            crc = zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            expected[row.doc_id, piece] = (piece * 4096, len(part), crc)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    assert _check_packed(rows, 4096) <= math.ceil(total / 4096) + 2


def test_pieces_of_awkward_texts(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    docs = documents(spark, TEXTS, piece="clash")
    rows = tokenized_pieces(docs, WORDS, 64, 1).orderBy("doc_id", "piece").collect()
    found = defaultdict(list)
    for r in rows:
        assert r.start == 64 * r.piece and r.length == len(r.ids) // 4 <= 64
        found[r.doc_id] += array("I", bytes(r.ids))
    for i, text in enumerate(TEXTS):
        assert found[i] == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_pack_keeps_columns_and_refuses_bad_lengths(spark):
    df = spark.createDataFrame([(i, 1 + i % 7, "p") for i in range(500)], "id int, length int, part string")
    rows = pack(df.repartition(5), 10).collect()
    assert sorted((r.id, r.length, r.part) for r in rows) == sorted(map(tuple, df.collect()))
    _check_packed(rows, 10)
    assert pack(df.limit(0), 10).count() == 0
    for bad in (0, 11, None):
        with pytest.raises(ValueError, match="lengths"):
            pack(spark.createDataFrame([(bad,)], "length int"), 10)
    clash = pack(df.withColumnRenamed("part", "Offset"), 10)
    assert clash.columns == ["id", "length", "sequence_id", "offset"]
    rows = clash.collect()
    assert sorted((r.id, r.length) for r in rows) == sorted((r.id, r.length) for r in df.collect())
    _check_packed(rows, 10)
    with pytest.raises(ValueError, match="names of results"):
        pack(df.withColumnRenamed("length", "offset"), 10, length="offset")
