"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text, and encoded once, with the offsets of its tokens. The
texts of the turns are spans of the rendered text, in order; a binary search of the tokens'
offsets in the spans' starts tells which tokens lie in the text of which turn. Those in turns
of the trained role are under the loss mask.

Control strings are tokens of their own, so no token reaches over the border of a text. Texts
and roles cannot hold one: every `<|`, with any backslashes between the two characters, gets
one backslash more, which reading takes away again.

Rows are dealt by ranges of (conversation, turn), so that a conversation of any length is
formatted by many tasks. Each task goes through its turns in order and writes parts of bounded
length, of whole turns. Only conversations in several parts are put together again, as a
stream: a digest of a whole conversation has to pass through its turns in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import AddedToken, Tokenizer, processors

from lexloom.llm.batches import held, quoted, released, ship

# The control strings of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
AFTER_TURN = "\n"
LOSS_ROLE = "assistant"

# Characters of a part, beyond which the next turn begins a new one.
PART_CHARS = 200_000
# Parts written at once, characters encoded at once.
PARTS_AT_ONCE = 64
ENCODED_AT_ONCE = 100_000

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
# Before such a blank a pre-token ends whatever follows, and what follows starts with it.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

SPANS = "array<struct<start: int, end: int>>"


def escape(text: str) -> str:
    """A text without `<|`, from which `unescape` gets the original."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


class Renderer:
    """Renders turns one after another and remembers where their texts are."""

    def __init__(self):
        self._pieces: list[str] = []
        self.length = self.turns = 0
        self._starts: list[int] = []
        self._ends: list[int] = []
        self._loss: list[bool] = []

    def add(self, role: str, text: str) -> None:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        start = self.length + len(head)
        self._pieces += [head, body, END + AFTER_TURN]
        self._starts.append(start)
        self._ends.append(start + len(body))
        self._loss.append(role == LOSS_ROLE)
        self.length = start + len(body) + len(END) + len(AFTER_TURN)
        self.turns += 1

    def text(self) -> str:
        return "".join(self._pieces)

    def mask(self, offsets: np.ndarray) -> np.ndarray:
        """For each token, given by start and end, whether it is part of a text to be learnt."""
        starts, ends = np.array(self._starts, np.int64), np.array(self._ends, np.int64)
        at = np.searchsorted(starts, offsets[:, 0], side="right") - 1
        inside = (at >= 0) & (offsets[:, 0] < ends[at]) & (offsets[:, 1] <= ends[at])
        return inside & np.array(self._loss, bool)[at]


def spans_under(mask: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of text that the masked tokens cover."""
    kept = offsets[mask]
    if not len(kept):
        return []
    # A character of several tokens has the same offsets in each of them.
    reach = np.maximum.accumulate(kept[:, 1])
    new = np.append(True, kept[1:, 0] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(kept) - 1)
    return list(zip(kept[new, 0].tolist(), reach[last].tolist()))


class ChatEncoder:
    """Ids and offsets of rendered texts, for a byte-level tokenizer in a .json file."""

    def __init__(self, content: str):
        self._tokenizer = Tokenizer.from_str(content)
        control = [AddedToken(x, special=True, normalized=False) for x in (START, SEPARATOR, END)]
        self._tokenizer.add_special_tokens(control)
        # Offsets with the blank that belongs to a token, so that nothing lies between two.
        self._tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids (uint32) and offsets (start and end in characters) of the tokens."""
        ids, offsets, start = [], [], 0
        while start < len(text):
            stop = len(text)
            if stop - start > ENCODED_AT_ONCE:
                cut = _SAFE_CUT.search(text, start + ENCODED_AT_ONCE)
                stop = cut.start() if cut else stop
            found = self._tokenizer.encode(text[start:stop], add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            offsets.append(np.array(found.offsets, np.int64).reshape(-1, 2) + start)
            start = stop
        if not ids:
            return np.empty(0, np.uint32), np.empty((0, 2), np.int64)
        return np.concatenate(ids), np.concatenate(offsets)


def _formatted(rendered: Renderer, encode: ChatEncoder) -> tuple:
    text = rendered.text()
    ids, offsets = encode(text)
    mask = rendered.mask(offsets)
    spans = [{"start": a, "end": b} for a, b in spans_under(mask, offsets)]
    return rendered.turns, text, ids.tobytes(), mask.astype(np.uint8).tobytes(), spans


def format_conversations(
    conversations: DataFrame,
    tokenizer_path: str,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """conv_id, part (long), whole, n_turns, text, ids, loss_mask, loss_spans of each part.

    A part holds whole turns of one conversation, ordered by turn, then role, then a hash of
    the text; parts are ordered by `part`, and `whole` says that a part is all of its
    conversation. `text` is the rendered part, `ids` its tokens (binary, 32-bit little-endian),
    `loss_mask` a byte per token, 1 in texts of the role `assistant`, and `loss_spans` the
    characters of `text` that the masked tokens cover.

    A null text or role counts as empty, null turns come first, and rows with a null
    conversation form one together. Repeated rows are a turn each. Very long turns are a part
    of their own, encoded stretch by stretch. An empty table gives no rows. Other columns are
    not read. The result is worked out each time it is read, so it should be staged.
    """
    spark = conversations.sparkSession
    ship(spark)
    rows = conversations.select(
        F.col(quoted(conversation)).alias("conv_id"),
        F.col(quoted(turn)).alias("turn"),
        F.coalesce(F.col(quoted(role)).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"),
    )
    # Equal rows are told apart by their number, so that not even they have to share a task.
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "hash", "number"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "role", "text")
    with open(tokenizer_path, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    kind = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType),
            *T.StructType.fromDDL(
                "part bigint, whole boolean, n_turns bigint, text string, ids binary,"
                f" loss_mask binary, loss_spans {SPANS}"
            ).fields,
        ]
    )
    arrow = to_arrow_schema(kind, prefers_large_types=False)
    name = ("chat", tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(name, lambda: ChatEncoder(content.value))
        first = part = TaskContext.get().partitionId() << 32
        rendered, current, begun, waiting = None, None, False, []

        def close(ended: bool) -> None:
            # The first and the last conversation of a task may go on in another one.
            nonlocal part
            whole = ended and not begun and part > first
            waiting.append((current, part, whole, *_formatted(rendered, encode)))
            part += 1

        for batch in released(batches):
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for key, role_, text_ in zip(*columns):
                if rendered is None or key != current:
                    if rendered is not None:
                        close(ended=True)
                    rendered, current, begun = Renderer(), key, False
                elif rendered.length + len(text_) > part_chars:
                    close(ended=False)
                    rendered, begun = Renderer(), True
                rendered.add(role_, text_)
                if len(waiting) >= PARTS_AT_ONCE:
                    yield _batch(waiting, arrow)
                    waiting = []
        if rendered is not None:
            close(ended=False)
        if waiting:
            yield _batch(waiting, arrow)

    return ordered.mapInArrow(run, kind)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(x), f.type) for x, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a rendered text."""
    turns = []
    for turn in text.split(START)[1:]:
        head, separator, rest = turn.partition(SEPARATOR)
        if not separator or not rest.endswith(END + AFTER_TURN):
            raise ValueError("not a rendered conversation")
        turns.append((unescape(head), unescape(rest[: -len(END + AFTER_TURN)])))
    return turns


class _Digest:
    """What has been read of one conversation."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self._turns, self._loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: Sequence[dict]) -> None:
        turns = turns_of(text)
        self.turns += len(turns)
        self.chars += len(text)
        self._turns.update("".join([f"{role}\n{said}\n" for role, said in turns]).encode())
        for span in spans:
            said = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(said)
            self._loss.update(said.encode())

    def row(self, key) -> tuple:
        digests = self._turns.hexdigest(), self._loss.hexdigest()
        return key, self.turns, digests[0], self.loss_chars, digests[1], self.chars


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back.

    `formatted` is a staged result of `format_conversations`. All is taken from the rendered
    texts and the spans under the loss mask. Parts of one conversation are read in order by one
    task, which holds one part at a time; whole conversations are read where they are.
    """
    key = formatted.schema["conv_id"].dataType
    kind = T.StructType(
        [
            T.StructField("conv_id", key),
            *T.StructType.fromDDL(
                "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
                " formatted_chars bigint"
            ).fields,
        ]
    )
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = current = None
        for batch in released(batches):
            done = []
            names = ("conv_id", "whole", "text", "loss_spans")
            for key_, whole, text, spans in zip(*[batch.column(c).to_pylist() for c in names]):
                if digest is not None and (whole or key_ != current):
                    done.append(digest.row(current))
                    digest = None
                if digest is None:
                    digest, current = _Digest(), key_
                digest.add(text, spans)
            if done:
                yield _batch(done, arrow)
        if digest is not None:
            yield _batch([digest.row(current)], arrow)

    read = formatted.select("conv_id", "part", "whole", "text", "loss_spans")
    apart = read.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return read.filter("whole").mapInArrow(run, kind).union(apart.mapInArrow(run, kind))
