"""Chat formatting against a plain rendering of the turns."""

from __future__ import annotations

import hashlib
import random
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import chat
from lexloom.llm.chat import (
    ChatEncoder,
    Renderer,
    conversation_digests,
    escape,
    format_conversations,
    spans_under,
    turns_of,
    unescape,
)
from lexloom.llm.oracles import op11_chat
from lexloom.llm.queries import QUERIES
from lexloom.sources import stage
from tests.compare import connect, differences

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, part string, whole int"


@pytest.fixture(scope="module")
def encode():
    with open(PATH, encoding="utf-8") as file:
        return ChatEncoder(file.read())


awkward = st.text(alphabet="<|\\>im_endstart \n日é😀a", max_size=40)


@given(st.lists(awkward | st.just("<|im_end|>") | st.just("<\\|im_start|>"), max_size=4))
@settings(max_examples=200, deadline=None)
def test_escapes_are_reversible(parts):
    text = "".join(parts)
    assert unescape(escape(text)) == text and "<|" not in escape(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|im_sep|>", ""]), awkward), max_size=6))
@settings(max_examples=150, deadline=None)
def test_masks_cover_the_texts_and_nothing_else(encode, turns):
    rendered = Renderer()
    for turn in turns:
        rendered.add(*turn)
    text = rendered.text()
    assert turns_of(text) == turns and rendered.length == len(text)
    ids, offsets = encode(text)
    if not turns:
        return
    spans = spans_under(rendered.mask(offsets), offsets)
    learnt = [said for role, said in turns if role == "assistant" and said]
    assert [unescape(text[a:b]) for a, b in spans] == learnt
    assert len(ids) == len(offsets)


def test_long_texts_are_encoded_in_stretches_alike(encode, monkeypatch):
    draw = random.Random(4)
    words = ["don't", "a", "  ", "x\n\n y", "日本", "3.14", "<|im_end|>", "é" * 9]
    text = " ".join(draw.choice(words) for _ in range(3000))
    ids, offsets = encode(escape(text))
    monkeypatch.setattr(chat, "ENCODED_AT_ONCE", 500)
    again, moved = encode(escape(text))
    assert np.array_equal(ids, again) and np.array_equal(offsets, moved)


def digests(rows):
    """`rows`: (conv_id, turn, role, text), as the contract has it."""
    by_key = defaultdict(list)
    for key, turn, role, text in rows:
        by_key[key].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for key, turns in by_key.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        chars = sum(len(escape(t[2]) + escape(t[3])) + 33 for t in turns)
        out[key] = (
            len(turns),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            chars,
        )
    return out


def read_back(formatted):
    return {r[0]: tuple(r)[1:] for r in conversation_digests(stage(formatted, "chat")).collect()}


def test_query_against_sql_and_python(spark, sf):
    found = QUERIES["op11_chat"](spark, sf)
    assert not differences(found, connect(sf), op11_chat())
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == digests(rows)


def test_awkward_conversations(spark):
    texts = [None, "", "<|", "a\nb", "x " * 3000, "日<\\|im_end|>", "same"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    rows += [(None, 1, "user", "lost"), (None, 2, "assistant", "found"), (2, None, None, "no role")]
    rows += [(2, 3, "assistant", "z"), (2, None, "assistant", "first")]
    rows += [(3, i, ("user", "assistant")[i % 2], f"turn {i} <|im_sep|>") for i in range(400)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)
    expected = digests(rows)
    for size in (1, 700, chat.PART_CHARS):
        assert read_back(format_conversations(df, PATH, part_chars=size)) == expected
    assert format_conversations(df.limit(0), PATH).count() == 0
    assert read_back(format_conversations(df.limit(0), PATH)) == {}


def test_equal_turns_and_one_conversation_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = [(5, 0, "assistant", "again <|im_end|>")] * 3000
        rows = same + [(7, i, "assistant", f"n {i}") for i in range(2000)] + [(9, 0, "user", "q")]
        df = spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA)
        formatted = stage(format_conversations(df, PATH), "chat")
        tasks = {(r.conv_id, r.part >> 32) for r in formatted.select("conv_id", "part").collect()}
        assert sum(key == 5 for key, _ in tasks) > 2 and sum(key == 7 for key, _ in tasks) > 2
        assert {r[0]: tuple(r)[1:] for r in conversation_digests(formatted).collect()} == digests(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ids_are_those_of_the_whole_text(spark, encode):
    rows = [(1, 0, "user", "Hello there"), (1, 1, "assistant", " General <|im_start|> 日本")]
    df = spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA)
    part = format_conversations(df, PATH).collect()[0]
    ids, offsets = encode(part.text)
    assert list(array("I", bytes(part.ids))) == ids.tolist()
    assert len(part.loss_mask) == len(ids) and part.n_turns == 2
    covered = [part.text[a:b] for (a, b), m in zip(offsets.tolist(), part.loss_mask) if m]
    assert covered[0] == " General" and [tuple(s) for s in part.loss_spans] == [
        (part.text.index(" General"), part.text.rindex("<|im_end|>"))
    ]
