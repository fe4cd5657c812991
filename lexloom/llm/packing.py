"""Packing documents into sequences of a fixed number of tokens, by best-two-fit.

A sequence is filled greedily, always with the longest piece that still fits. Then its
smallest piece is taken out again if two unpacked pieces fit into the gap this leaves more
tightly than it did.

Pieces of one length are interchangeable, so the packing is worked out on the number of pieces
per length: a table of at most `capacity` rows however large the corpus, and as long as the
pieces of a pattern last, the same pattern is used many times over in one step. A piece finds
its place by its number among the pieces of its length. These numbers are made without a sort:
each task counts as it goes, and the counts of the tasks before are added.
"""

from __future__ import annotations

import json
import struct
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from lexloom.llm.batches import (
    Memory,
    held,
    map_columns,
    quoted,
    released,
    ship,
    without_results,
)
from lexloom.llm.token_counts import byte_characters
from lexloom.sources import Staging, stage

# Chunks and pre-tokens of a generation; a worker remembers two of each, some 150 MB in all.
CHUNKS, PRETOKENS = 250_000, 150_000
# Texts whose different chunks are looked up together.
ROWS_AT_ONCE = 4096
# Stands between the ids of two chunks; no tokenizer has it.
MARK = 0xFFFFFFFF
# Bits of a place's key that hold the number of a piece; the length is above them.
NUMBER_BITS = 44
# Tasks whose counts are added up in one group, before the groups are.
TASKS_TOGETHER = 1024


class WordEncoder:
    """Ids of chunks between white space, for a BPE with word ends in a .json file.

    The library's own normalizer and merges are used on whole lists of chunks: pre-tokens
    recur in many chunks, and one call per pre-token is much cheaper than one per chunk.
    Chunks with strings of added tokens or rarer white space go to the library as they are.
    """

    def __init__(self, content: str):
        self._tokenizer = Tokenizer.from_str(content)
        described = json.loads(content)
        steps = described["pre_tokenizer"]["pretokenizers"]
        split = steps[0]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or not split["invert"]:
            raise ValueError("only tokenizers that keep the matches of a pattern, in bytes")
        self._findall = regex.compile(f"(?:{split['pattern']['Regex']})| ").findall
        added = [token["content"] for token in described["added_tokens"]]
        self._odd = regex.compile("|".join([r"[^\S ]", *map(regex.escape, added)])).finditer
        characters = byte_characters()
        self._table = {byte: characters[byte] for byte in range(256)}
        self._known = Memory(PRETOKENS)

    def __call__(self, chunks: list[str]) -> list[bytes]:
        odd = self._odd_ones(chunks)
        usual = [chunk for i, chunk in enumerate(chunks) if i not in odd] if odd else chunks
        found = iter(self._usual(usual) if usual else ())
        if not odd:
            return list(found)
        return [
            self._whole(chunk) if i in odd else next(found) for i, chunk in enumerate(chunks)
        ]

    def _odd_ones(self, texts: list[str]) -> set[int]:
        at = [match.start() for match in self._odd(" ".join(texts))]
        if not at:
            return set()
        ends = np.cumsum(np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts)))
        return set(np.searchsorted(ends, at, side="right").tolist())

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _usual(self, texts: list[str]) -> list[bytes]:
        tokens = self._findall(self._tokenizer.normalizer.normalize_str(" ".join(texts)))
        # Pre-tokens recur where chunks do not: with other punctuation, or in capitals.
        lacking = set(tokens) - self._known.young.keys() - {" "}
        ids = self._known.ready(lacking, lambda new: [self._ids(token) for token in new])
        mark = struct.pack("<I", MARK)
        joined = b"".join([mark if token == " " else ids[token] for token in tokens])
        self._known.close(lacking)
        marks = np.flatnonzero(np.frombuffer(joined, "<u4") == MARK) * 4
        if marks.size != len(texts) - 1:
            raise ValueError("the normalizer changes blanks")
        starts, stops = [0, *(marks + 4).tolist()], [*marks.tolist(), len(joined)]
        return [joined[a:b] for a, b in zip(starts, stops)]

    def _ids(self, token: str) -> bytes:
        text = token.encode().decode("latin-1").translate(self._table)
        return array("I", [t.id for t in self._tokenizer.model.tokenize(text)]).tobytes()


class Encoder:
    """Ids of whole texts: each different chunk of a batch is looked up once."""

    def __init__(self, content: str):
        self._solve, self._memory = WordEncoder(content), Memory(CHUNKS)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts one after another, and where those of each end."""
        chunks = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        cut = chunks.flatten().dictionary_encode()
        words = cut.dictionary.to_pylist()
        lacking = set(words) - self._memory.young.keys() - {""}
        known = self._memory.ready(lacking, self._solve)
        values = [known[word] if word else b"" for word in words]
        self._memory.close(lacking)
        # A batch has few bytes, so 32-bit positions do; a longer text comes alone.
        sizes = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        kind = np.int32 if len(cut) and sizes.max() * len(cut) < 2**31 else np.int64
        sizes = sizes.astype(kind)
        starts = np.cumsum(sizes, dtype=kind) - sizes
        ids = np.frombuffer(b"".join(values), "<u4")
        codes = cut.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.cumsum(lengths, dtype=kind)
        total = int(ends[-1]) if ends.size else 0
        at = np.repeat(starts[codes] - (ends - lengths), lengths)
        at += np.arange(total, dtype=kind)
        ends = np.append(0, ends)[chunks.offsets.to_numpy()[1:]]
        return ids[at], ends


class Numbering:
    """Numbers the pieces that pass through a task among those of their length."""

    def __init__(self, capacity: int):
        self.part, self._counts = TaskContext.get().partitionId(), np.zeros(capacity + 2, np.int64)

    def __call__(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The task of each piece and its number there; lengths are 0 to capacity + 1."""
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        index = np.arange(ordered.size)
        first = np.append(True, ordered[1:] != ordered[:-1])[: ordered.size]
        within = index - np.maximum.accumulate(np.where(first, index, 0))
        numbers = np.empty(ordered.size, np.int64)
        numbers[order] = self._counts[ordered] + within
        np.add.at(self._counts, lengths, 1)
        return np.full(lengths.size, self.part, np.int64), numbers


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    end_id: int,
    text: str = "text",
    keep: tuple = ("doc_id",),
) -> DataFrame:
    """`keep`, piece (int), start, length (long), ids (binary, 32-bit little-endian) per piece.

    The ids of a text end with `end_id`; a null text counts as empty and has that one only.
    More than `capacity` ids are cut into pieces of `capacity`, the last of which may be
    shorter. Repeated rows have their own pieces each; an empty table gives none. The
    tokenizer must be one that drops white space and lets no token reach across it, so that
    words can be encoded one by one. Other columns are not read.

    Two more columns, length_task and length_number (long), say where a piece stands among
    those of its length; `pack` uses them, if no piece has been left out or added.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    end, size = struct.pack("<I", end_id), 4 * capacity
    name = ("packing", tokenizer_path)

    def make():
        encode = held(name, lambda: Encoder(content.value))
        number = Numbering(capacity)

        def work(texts):
            ids, ends = encode(texts)
            packed, start = ids.tobytes(), 0
            index, pieces, repeats = [], [], []
            for stop in (4 * ends).tolist():
                whole = packed[start:stop] + end
                cut = [whole[at : at + size] for at in range(0, len(whole), size)]
                index += range(len(cut))
                repeats.append(len(cut))
                pieces += cut
                start = stop
            index = np.array(index, np.int64)
            lengths = np.array([len(x) // 4 for x in pieces], np.int64)
            return (repeats, index, index * capacity, lengths, pieces, *number(lengths))

        return work

    outputs = "piece int, start bigint, length bigint, ids binary"
    outputs += ", length_task bigint, length_number bigint"
    return map_columns(
        docs, make, [text], keep, outputs, ROWS_AT_ONCE, repeated=True, arrow_inputs=True
    )


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a sequence, number of such sequences), in order of filling."""
    left = {length: n for length, n in counts.items() if n}
    lengths = sorted(left)
    patterns = []
    while lengths:
        taken: dict[int, int] = {}
        gap, below = capacity, capacity
        while (at := bisect_right(lengths, min(gap, below)) - 1) >= 0:
            length = lengths[at]
            taken[length] = min(left[length], gap // length)
            gap -= taken[length] * length
            below = length - 1
        pair = _better_pair(lengths, left, taken, gap) if gap else None
        needed, used = dict(taken), dict(taken)
        if pair:
            smallest = min(taken)
            used[smallest] -= 1
            for length in pair:
                needed[length] = needed.get(length, 0) + 1
                used[length] = used.get(length, 0) + 1
            used = {length: n for length, n in used.items() if n}
        # As long as there is enough of each length, every choice above stays the same.
        times = 1 + min((left[length] - needed[length]) // n for length, n in used.items())
        patterns.append((used, times))
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del lengths[bisect_right(lengths, length) - 1]
    return patterns


def _better_pair(
    lengths: list[int], left: dict[int, int], taken: dict[int, int], gap: int
) -> tuple[int, int] | None:
    """Two unpacked pieces that fill more of the gap than the smallest piece, and most of it."""
    smallest = min(taken)
    room = gap + smallest
    near = lengths[: bisect_right(lengths, room - 1)]
    free = np.array([x for x in near if left[x] > taken.get(x, 0)], np.int64)
    if not free.size:
        return None
    at = np.searchsorted(free, room - free, side="right") - 1
    other = np.where(at >= 0, free[np.maximum(at, 0)], 0)
    twice = (other == free) & (at >= 0)
    if twice.any():
        alone = [left[x] - taken.get(x, 0) < 2 for x in free[twice].tolist()]
        index = at[twice] - np.array(alone)
        other[twice] = np.where(index >= 0, free[np.maximum(index, 0)], 0)
    total = np.where(other > 0, free + other, 0)
    best = int(total.size - 1 - np.argmax(total[::-1]))  # of equal ones the longest first piece
    if total[best] <= smallest:
        return None
    return int(free[best]), int(other[best])


class _Places:
    """Finds sequence and offset of the n-th piece of a length."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]]):
        rows, given, sequence = [], {}, 0
        for used, times in patterns:
            offset = 0
            for length in sorted(used, reverse=True):
                n, first = used[length], given.get(length, 0)
                rows.append(((length << NUMBER_BITS) + first, sequence, n, offset))
                given[length] = first + n * times
                offset += n * length
            sequence += times
        rows.sort()
        self._keys, self._sequences, self._copies, self._offsets = (
            np.array(column, np.int64) for column in zip(*rows)
        )

    def __call__(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (lengths << NUMBER_BITS) + numbers
        at = np.searchsorted(self._keys, keys, side="right") - 1
        behind, copies = keys - self._keys[at], self._copies[at]
        sequences = self._sequences[at] + behind // copies
        return sequences, self._offsets[at] + behind % copies * lengths


def _with_columns(df: DataFrame, make, outputs: str) -> DataFrame:
    """`df` with columns that `make()` makes from the arrays of each batch."""
    ship(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(outputs).fields])
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in released(batches):
            if batch.num_rows:
                old = [batch.column(i).cast(arrow.field(i).type) for i in range(batch.num_columns)]
                new = [pa.array(values) for values in work(batch)]
                yield pa.RecordBatch.from_arrays([*old, *new], schema=arrow)

    return df.mapInArrow(run, schema)


def _integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def pack(
    pieces: DataFrame, capacity: int, length: str = "length", numbered: bool = False
) -> DataFrame:
    """All columns of `pieces`, with sequence_id and offset (long).

    Sequences are numbered from 0 and filled from offset 0 without gaps, with `capacity`
    tokens at most. Lengths must be 1 to `capacity`; others, and null, are an error. Which of
    the pieces of one length gets which place is arbitrary. An empty table gives no rows.
    With `numbered`, the columns length_task and length_number are those that
    `tokenized_pieces` made for exactly these rows; the result does not have them. Other columns
    with names of results give way to them.
    """
    pieces = without_results(pieces, ["sequence_id", "offset"], [length])
    given = ["length_task", "length_number"] if numbered else []
    wrapped = pieces.select(
        F.struct(*[F.col(quoted(c)) for c in pieces.columns if c not in given]).alias("row"),
        F.coalesce(F.col(quoted(length)).cast("bigint"), F.lit(0)).alias("length"),
        *[F.col(old).alias(new) for old, new in zip(given, ("part", "number"))],
    )

    def number():
        count = Numbering(capacity)
        return lambda batch: count(np.clip(_integers(batch, "length"), 0, capacity + 1))

    if not numbered:
        wrapped = _with_columns(wrapped, number, "part bigint, number bigint")
    # Written once, so that numbers of a task and counts of the tasks before it agree.
    numbers = stage(wrapped, "pieces")
    with Staging(pieces.sparkSession) as staging:
        by_task = numbers.groupBy("length", "part").agg(F.count("*").alias("n"))
        by_task = staging.write(by_task, "piece-counts")
        # At most a row per possible length reaches the driver.
        histogram = by_task.groupBy("length").agg(F.sum("n").alias("n"))
        counts = {r.length: r.n for r in histogram.collect()}
        if wrong := [x for x in counts if not 1 <= x <= capacity]:
            raise ValueError(f"lengths must be 1 to {capacity}, not {sorted(wrong)[:5]}")
        before = stage(_earlier(by_task), "pieces-before")
    outputs = "sequence_id bigint, offset bigint"
    if not counts:
        nothing = F.lit(0).cast("bigint")
        none = numbers.select("row.*").limit(0)
        return none.select("*", nothing.alias("sequence_id"), nothing.alias("offset"))
    places = pieces.sparkSession.sparkContext.broadcast(_Places(best_two_fit(counts, capacity)))

    def place():
        find = places.value

        def work(batch):
            numbers = _integers(batch, "number") + _integers(batch, "before")
            return find(_integers(batch, "length"), numbers)

        return work

    # Both sides grow with the table, so neither is broadcast, at any size.
    found = numbers.join(before.hint("shuffle_hash"), ["length", "part"])
    return _with_columns(found, place, outputs).select("row.*", "sequence_id", "offset")


def _earlier(by_task: DataFrame) -> DataFrame:
    """(length, part, before): the pieces of a length in the tasks before a task.

    A length has a row per task. Tasks are taken in groups, so that no window holds more than
    a group's rows, and the groups of a length are few.
    """
    group = F.floor(F.col("part") / TASKS_TOGETHER).alias("tasks")
    grouped = by_task.select("length", group, "part", "n")
    to_here = (Window.unboundedPreceding, -1)
    of_groups = Window.partitionBy("length").orderBy("tasks").rowsBetween(*to_here)
    within = Window.partitionBy("length", "tasks").orderBy("part").rowsBetween(*to_here)
    sums = grouped.groupBy("length", "tasks").agg(F.sum("n").alias("n"))
    none = F.lit(0).cast("bigint")
    sums = sums.select("length", "tasks", F.coalesce(F.sum("n").over(of_groups), none).alias("all"))
    return (
        grouped.withColumn("here", F.coalesce(F.sum("n").over(within), none))
        .join(sums.hint("shuffle_hash"), ["length", "tasks"])
        .select("length", "part", (F.col("all") + F.col("here")).alias("before"))
    )
