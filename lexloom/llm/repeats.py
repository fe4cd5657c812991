"""Runs of periodic words, by online dyadic square catching.

A text is appended to a catcher in stretches of any size. For every power of two m the catcher
watches blocks of m words that start at multiples of m / 2, each from the moment it is
complete. A block is compared with the last m words as words are appended, while these end
m / 2 to m words behind it: equality says that the words from the block's start to here have
that distance as a period, a square at least. The windows of the blocks of one size follow one
another, so exactly one block of each size is watching at any time, and an appended word costs
one comparison of hashes per size: n log n in all, whatever the text.

A square grows into the longest stretch with its period, which stays open while appended words
continue it. Sizes are gone through from the smallest. A square inside a stretch of a smaller
period is a multiple of that one and says nothing new; every other one has the smallest period
of its stretch, and of a block there is one such square at most. Equality of hashes is
confirmed on the words as the square grows, so results do not depend on them.

A stretch of at least four periods is always caught: a block with m / 2 <= period < m starts
within its first m / 2 words, and the block's end and its copy's lie within the four periods.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import map_columns

# Periods that a run must have at least; fewer cannot be promised to be caught.
LEAST_PERIODS = 4
# Words appended at once; documents shorter than this are appended together.
WORDS_AT_ONCE = 1 << 17
# Words compared at first when a square grows, then twice as many each time.
FIRST_STRIDE = 16
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class _Stretch:
    """Words start .. end - 1, each equal to the one `period` later as far as that goes."""

    start: int
    end: int
    period: int


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of blocks from those of their halves."""
    mixed = left * _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    mixed += right
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    return mixed


class _Level:
    """Hashes of all blocks of one size that may still be compared, and where they start."""

    def __init__(self, size: int):
        self.size, self.first, self.hashes = size, 0, np.empty(0, np.uint64)
        self.seen = 0  # words that the comparisons have reached


class SquareCatcher:
    """Finds the stretches of at least `LEAST_PERIODS` periods in the words appended so far.

    Words are integers; negative ones stand between texts and must each occur only once.
    """

    def __init__(self):
        self._words = np.empty(0, np.int64)
        self._n = self._longest = self._last_border = 0
        self._levels: list[_Level] = []
        self._found: list[_Stretch] = []
        self._last: dict[int, _Stretch] = {}
        self._open: list[_Stretch] = []

    def append(self, words: Sequence[int] | np.ndarray) -> None:
        words = np.asarray(words, np.int64)
        if not words.size:
            return
        before, self._n = self._n, self._n + words.size
        self._keep(words, before)
        for stretch in self._open:
            stretch.end += self._agreeing(stretch.end - stretch.period, stretch.period)
        self._watch()
        self._open = [s for s in self._found if s.end == self._n]

    def runs(self, least: int = 1) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of runs of `least` words or more, by start."""
        found = {
            (s.start, s.end - s.start, s.period)
            for s in self._found
            if s.end - s.start >= max(least, LEAST_PERIODS * s.period)
        }
        return sorted(found, key=lambda run: (run[0], run[2]))

    def _keep(self, words: np.ndarray, before: int) -> None:
        if self._n > self._words.size:
            grown = np.empty(max(self._n, 2 * self._words.size if before else 0), np.int64)
            grown[:before] = self._words[:before]
            self._words = grown
        self._words[before : self._n] = words
        borders = [self._last_border, *(np.flatnonzero(words < 0) + before + 1).tolist(), self._n]
        self._longest = max(self._longest, *np.diff(borders).tolist())
        self._last_border = borders[-2]

    def _watch(self) -> None:
        """Compare what was appended with the watching blocks, from the smallest on."""
        size, finer = 2, self._words[: self._n].view(np.uint64)
        while LEAST_PERIODS * (size // 2) <= self._longest:
            number = size.bit_length() - 2
            if number == len(self._levels):
                self._levels.append(_Level(size))
            level = self._levels[number]
            self._hash(level, finer)
            self._compare(level)
            size, finer = size * 2, level
        for level in self._levels:
            # A block is compared with what ends up to 2 * size words behind its start; half of
            # the next size starts there too.
            kept = max(level.first, self._n - 5 * level.size)
            level.hashes = level.hashes[kept - level.first :].copy()
            level.first = kept

    def _hash(self, level: _Level, finer: np.ndarray | _Level) -> None:
        half, done = level.size // 2, level.first + level.hashes.size
        stop = self._n - level.size + 1
        if stop <= done:
            return
        if isinstance(finer, _Level):
            # A size used for the first time begins where its halves are still known.
            if done < finer.first:
                done = level.first = finer.first
                level.hashes = level.hashes[:0]
            finer, shift = finer.hashes, finer.first
        else:
            shift = 0
        left = finer[done - shift : stop - shift]
        right = finer[done + half - shift : stop + half - shift]
        level.hashes = np.concatenate((level.hashes, _joined(left, right)))

    def _compare(self, level: _Level) -> None:
        size, half = level.size, level.size // 2
        # The start of the last `size` words, after each word appended.
        first = max(level.seen - size + 1, level.first)
        level.seen = self._n
        if first > self._n - size:
            return
        copies = np.arange(first, self._n - size + 1)
        # The only block that watches: it starts half to a whole size before.
        blocks = (copies - half) // half * half
        usable = blocks >= level.first
        copies, blocks = copies[usable], blocks[usable]
        equal = level.hashes[blocks - level.first] == level.hashes[copies - level.first]
        copies, blocks = copies[equal], blocks[equal]
        if not copies.size:
            return
        starts, reach = self._reach(half, first)
        if starts.size:
            at = np.searchsorted(starts, blocks, side="right") - 1
            new = (at < 0) | (reach[np.maximum(at, 0)] < copies + size)
            copies, blocks = copies[new], blocks[new]
        for start, copy in zip(blocks.tolist(), copies.tolist()):
            period = copy - start
            last = self._last.get(period)
            if last is None or copy + size > last.end or start < last.start:
                self._grow(start, period, size)

    def _grow(self, start: int, period: int, size: int) -> None:
        ahead = self._agreeing(start, period)
        if ahead < size:
            return  # equal hashes of different words
        begin = start - self._agreeing_before(start, period)
        stretch = _Stretch(begin, start + period + ahead, period)
        self._found.append(stretch)
        self._last[period] = stretch

    def _agreeing(self, start: int, period: int) -> int:
        """How many words from `start` on equal those `period` later."""
        words, n, at, stride = self._words, self._n, start, FIRST_STRIDE
        while at + period < n:
            stop = min(at + stride, n - period)
            differs = words[at:stop] != words[at + period : stop + period]
            if differs.any():
                return at + int(differs.argmax()) - start
            at, stride = stop, 2 * stride
        return at - start

    def _agreeing_before(self, start: int, period: int) -> int:
        words, at, stride = self._words, start, FIRST_STRIDE
        while at > 0:
            begin = max(at - stride, 0)
            differs = words[begin:at] != words[begin + period : at + period]
            if differs.any():
                return start - (at - int(differs[::-1].argmax()))
            at, stride = begin, 2 * stride
        return start

    def _reach(self, below: int, after: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the stretches of smaller periods: starts, and how far all up to there reach."""
        bounds = sorted((s.start, s.end) for s in self._found if s.period < below and s.end > after)
        both = np.array(bounds, np.int64).reshape(-1, 2)
        return both[:, 0], np.maximum.accumulate(both[:, 1])


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A number for each word of all texts, where the words of each text end, the words."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, ends = cut.flatten(), cut.offsets.to_numpy()[1:]
    real = pc.not_equal(words, "")  # what stands beside white space at an end
    counts = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    coded = words.filter(real).dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    return numbers, counts[ends], coded.dictionary.to_pylist()


def text_runs(texts: pa.Array, least: int) -> tuple[list[list[tuple[int, int, int]]], list]:
    """The runs of each text, and its words as (numbers, the words they stand for)."""
    numbers, ends, words = _numbered(texts)
    starts = np.append(0, ends[:-1]) if ends.size else ends
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    first = 0
    while first < len(texts):
        # Short texts go together, with borders between them; a long one goes alone.
        room = int(starts[first]) + WORDS_AT_ONCE
        last = max(bisect_right(ends, room, lo=first), first + 1)
        catcher = SquareCatcher()
        offsets = starts[first:last] - starts[first] + np.arange(last - first)
        borders = offsets[1:] - 1
        stream = np.insert(
            numbers[starts[first] : ends[last - 1]],
            borders - np.arange(borders.size),
            -1 - np.arange(borders.size),
        )
        for at in range(0, stream.size, WORDS_AT_ONCE):
            catcher.append(stream[at : at + WORDS_AT_ONCE])
        runs = catcher.runs(least)
        where = np.searchsorted(offsets, [r[0] for r in runs], side="right") - 1
        for text, (start, length, period) in zip(where.tolist(), runs):
            found[first + text].append((start - int(offsets[text]), length, period))
        first = last
    pieces = [(numbers[a:b], words) for a, b in zip(starts.tolist(), ends.tolist())]
    return found, pieces


def _collapsed(runs: list[tuple[int, int, int]], text: tuple[np.ndarray, list[str]]) -> str:
    numbers, words = text
    if runs:
        kept = np.ones(numbers.size, bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        numbers = numbers[kept]
    return " ".join([words[i] for i in numbers.tolist()])


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(
    docs: DataFrame, least: int = 6, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep`, n_words (long), runs (array of start, length, period) and collapsed per row.

    Words stand between ASCII white space and are numbered from 0. A run is a stretch of at
    least `least` words and four times its smallest period that no neighbouring word extends;
    runs are ordered by start, then period. `collapsed` has the words, joined by one blank,
    without those of a run after its first period. A null, empty or blank text has no words, no
    runs and is collapsed to an empty text. Very long texts are searched whole, repeated rows
    each by itself; an empty table gives no rows. Other columns are not read.
    """

    def make():
        def work(texts):
            found, pieces = text_runs(texts, least)
            names = ("start", "length", "period")
            listed = [[dict(zip(names, run)) for run in runs] for runs in found]
            sizes = [len(numbers) for numbers, _ in pieces]
            return sizes, listed, list(map(_collapsed, found, pieces))

        return work

    outputs = f"n_words bigint, runs array<{RUN}>, collapsed string"
    return map_columns(docs, make, [text], keep, outputs, arrow_inputs=True)


def run_digests(found: DataFrame, keep: tuple = ("doc_id",)) -> DataFrame:
    """`keep`, the number of runs, the longest one, and digests of runs and collapsed text.

    start, length, period and exponent_milli are those of the longest run (ties: least start,
    then least period), null where there is none.
    """
    best = F.array_sort(
        F.transform(
            "runs",
            lambda r: F.struct(
                (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    first = F.get(best, F.lit(0))
    length = -first["shorter"]
    return found.select(
        *keep,
        F.size("runs").cast("bigint").alias("n_runs"),
        first["start"].alias("start"),
        length.alias("length"),
        first["period"].alias("period"),
        F.floor(length * 1000 / first["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
