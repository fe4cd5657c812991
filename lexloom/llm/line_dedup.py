"""Deleting runs of lines that occurred before, found by winnowing over line hashes.

A window is a run of lines that just reaches `min_words` words, counted from its first line on
or back from its last. The line with the least hash is the window's fingerprint; equal windows
choose equal fingerprints, and every run of `min_words` words or more holds a window. So two
equal runs always share a fingerprint, and most lines need not be indexed.

Fingerprints that stand at more than one position are joined by their hash. Around each such
position the match is extended both ways to the windows that chose it, and windows are equal if
the digests of their lines are. The first of equal windows in the order of the documents stays;
the lines of the others go. What windows cover is exactly what longest equal runs cover: a line
of a repeated run is in the window that starts or ends at it, or in that of the run's start.
"""

from __future__ import annotations

from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import map_columns, quoted, unused, without_results
from lexloom.sources import Staging, stage

# A run of fewer words is no repeated passage.
MIN_WORDS = 50


def windows(counts: list[int], least: int) -> set[tuple[int, int]]:
    """(first, last) of the shortest runs with `least` words from each line on and back."""
    total = [0, *accumulate(counts)]
    found, last, n = set(), 0, len(counts)
    for first in range(n):
        while last < n and total[last + 1] - total[first] < least:
            last += 1
        if last == n:
            break
        found.add((first, last))
    first = 0
    for last in range(n):
        while first < last and total[last + 1] - total[first + 1] >= least:
            first += 1
        if total[last + 1] - total[first] >= least:
            found.add((first, last))
    return found


def _lines(text: str) -> tuple[list[int], list[str], list[int]]:
    """Number, content and words of the lines that are not blank."""
    numbers, contents, counts = [], [], []
    for number, line in enumerate(text.split("\n")):
        if words := len(line.split()):
            numbers.append(number)
            contents.append(line.strip())
            counts.append(words)
    return numbers, contents, counts


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _winnow(text: str, least: int) -> list[dict]:
    """The windows of a text with their fingerprints."""
    if len(text) < 2 * least - 1:  # too short for so many words
        return []
    numbers, contents, counts = _lines(text)
    if sum(counts) < least:
        return []
    digests = [xxhash.xxh3_128_digest(line.encode()) for line in contents]
    joined = b"".join(digests)
    rows = []
    for first, last in sorted(windows(counts, least)):
        chosen = min(range(first, last + 1), key=lambda i: (digests[i], -i))
        content = xxhash.xxh3_128_intdigest(joined[16 * first : 16 * last + 16])
        rows.append(
            {
                "fingerprint": int.from_bytes(digests[chosen][:8], "big", signed=True),
                "position": numbers[chosen],
                "high": _signed(content >> 64),
                "low": _signed(content & (1 << 64) - 1),
                "first": numbers[first],
                "last": numbers[last],
            }
        )
    return rows


def merged_runs(lines: list[str], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last numbers of the lines in `spans`, and of the blank lines between such."""
    runs: list[tuple[int, int]] = []
    reach, at, spans, joined = -1, 0, sorted(spans), False
    for number, line in enumerate(lines):
        if not line.strip():
            continue
        while at < len(spans) and spans[at][0] <= number:
            reach = max(reach, spans[at][1])
            at += 1
        if number > reach:
            joined = False
        elif joined:
            runs[-1] = (runs[-1][0], number)
        else:
            runs.append((number, number))
            joined = True
    return runs


def _without(lines: list[str], runs: list[tuple[int, int]]) -> str:
    kept, done = [], 0
    for first, last in runs:
        kept += lines[done:first]
        done = last + 1
    return "\n".join(kept + lines[done:])


def _later_windows(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(key, text_hash, spans): of each document the windows that occurred before."""

    def make():
        return lambda texts: ([_winnow(t, least) if t else [] for t in texts],)

    identity = docs.select(
        F.col(quoted(key)).alias("key"),
        F.xxhash64(F.col(quoted(text))).alias("text_hash"),
        F.col(quoted(text)).alias("text"),
    )
    window = (
        "windows array<struct<fingerprint: bigint, position: int, high: bigint, low: bigint, "
        "first: int, last: int>>"
    )
    found = map_columns(identity, make, ["text"], ["key", "text_hash"], window)
    with Staging(docs.sparkSession) as staging:
        rows = staging.write(found.select("key", "text_hash", F.inline("windows")), "windows")
        # As numbers, positions are compared without sorting; written out, so that Spark can
        # split the rows of a line that a third of the documents have.
        place = F.xxhash64("key", "text_hash", "position")
        shared = (
            rows.groupBy("fingerprint")
            .agg(F.min(place).alias("one"), F.max(place).alias("another"))
            .filter("one != another")
            .select("fingerprint")
        )
        shared = staging.write(shared, "shared")
        # The side named in a hint is the smaller one at any size, and needs no sorting.
        extended = rows.join(shared.hint("shuffle_hash"), "fingerprint", "left_semi").select(
            "high",
            "low",
            F.struct(F.col("key").isNull().alias("unnamed"), "key", "text_hash").alias("document"),
            "first",
            "last",
        )
        order = F.struct("document", "first", "last")
        firsts = extended.groupBy("high", "low").agg(
            F.min(order).alias("earliest"), F.max(order).alias("latest")
        )
        firsts = firsts.filter("earliest != latest").select("high", "low", "earliest")
        firsts = staging.write(firsts, "firsts")
        same = F.col("document") == F.col("earliest.document")
        later = (
            extended.join(firsts.hint("shuffle_hash"), ["high", "low"])
            .filter(~same | (F.col("first") > F.col("earliest.last")))
            .groupBy("document.key", "document.text_hash")
            .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
        )
        return stage(later, "repeats")


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of `docs`, `text` without repeated runs, and deleted_runs.

    A run is a number of lines in a row, equal but for white space at the ends of lines, with
    `min_words` words or more. Every run that occurred before, in a document with a smaller
    key or further up in the same one, is deleted, as are blank lines between deleted ones. Runs
    that overlap their first occurrence stay. deleted_runs has the numbers (from 0) of the first
    and last lines. Rows with equal key and text are one document and come out alike; rows
    with a null key come last, ordered by their texts' hashes. A null text stays null. Very
    long texts and lines are compared whole; an empty table gives no rows. Another column named
    deleted_runs gives way to the result.
    """
    docs = without_results(docs, ["deleted_runs"], [key, text])
    names = unused(docs.columns, "document_key", "text_hash", "text_spans")
    later = _later_windows(docs, key, text, min_words).toDF(*names)
    own = F.xxhash64(F.col(quoted(text))) == F.col(names[1])
    same = own & F.col(quoted(key)).eqNullSafe(F.col(names[0]))
    # The texts are the large side at any size: they are dealt by key, but not sorted.
    joined = docs.join(later.hint("shuffle_hash"), same, "left")

    def make():
        def work(texts, spans):
            kept, deleted = list(texts), []
            for i, (text, found) in enumerate(zip(texts, spans)):
                runs = []
                if found:
                    lines = text.split("\n")
                    runs = merged_runs(lines, [(s["first"], s["last"]) for s in found])
                    kept[i] = _without(lines, runs)
                deleted.append([{"first": a, "last": b} for a, b in runs])
            return kept, deleted

        return work

    others = [c for c in docs.columns if c != text]
    outputs = f"{quoted(text)} string, deleted_runs array<struct<first: int, last: int>>"
    made = map_columns(joined, make, [text, names[2]], others, outputs)
    return made.select(*[F.col(quoted(c)) for c in docs.columns], "deleted_runs")
