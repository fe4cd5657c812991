"""SimHash fingerprints, and groups of fingerprints that differ in few bits.

Pairs within the radius are found by covering locality-sensitive hashing. Every bit has a
non-zero code of radius + 1 binary digits, and there is a mask for every non-zero vector of so
many digits: the bits whose code has an odd product with it. Two fingerprints that differ in at
most `radius` bits set as many linear equations for a vector at most; one more unknown than
equations leaves a non-zero solution, whose mask has none of the differing bits. So each such
pair agrees under some mask, and none is missed.

Fingerprints that agree under a mask form a bucket. Only different fingerprints enter, so
copies add nothing to a bucket. A bucket gives the edges of a spanning forest of its links, not
its pairs. A large bucket is divided once more by masks over the bits that its own mask leaves
out; what those agree on leaves so few bits that a bucket is bounded by the number of their
values. Components are then those of the forests' edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import map_columns, quoted, released, ship, unused, without_results
from lexloom.llm.components import connected_components
from lexloom.sources import Staging, stage

BITS = 64
SEED = 42
# Hashes whose bits are counted at once.
HASHES_AT_ONCE = 50_000
# Fingerprints compared in one bucket; larger buckets are divided first.
BUCKET = 4096


def _fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()  # ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for word in words:
        starts.append(starts[-1] + len(word) + 1)
    last = max(len(words) - shingle, 0)
    stops = starts[min(shingle, len(words)) :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[: last + 1], stops)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.array(hashes[at : at + HASHES_AT_ONCE], ">u8")
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, shingle: int, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep` and fingerprint (long) of each row's whole text.

    ASCII letters are lower-cased, words stand between ASCII white space, and every run of
    `shingle` words is hashed by XXH64, repeats included; with fewer words all of them
    together. A bit is set if it is in over half of the hashes. A null, empty or blank text
    has fingerprint 0. Other columns are not read.
    """

    def make():
        return lambda texts: ([_fingerprint(t or "", shingle) for t in texts],)

    return map_columns(docs, make, [text], keep, "fingerprint bigint")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks of which one leaves out any `radius` of the given bits (numbers from 0)."""
    vectors = range(1, 2 ** (radius + 1))
    code = {bit: 1 + i % len(vectors) for i, bit in enumerate(bits)}
    return [
        sum(1 << bit for bit in bits if (code[bit] & vector).bit_count() % 2) for vector in vectors
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


class _Forest:
    """Spanning forests of the buckets in a stream of rows sorted by bucket."""

    def __init__(self, radius: int, limit: int | None):
        self.radius, self.limit = radius, limit

    def _tree(self, group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each component of a bucket its other members and its first one."""
        edges, waiting = [], group
        while waiting.size > 1:
            root, reached, waiting = waiting[0], [waiting[0]], waiting[1:]
            members = []
            while reached and waiting.size:
                near = np.bitwise_count(waiting ^ reached.pop()) <= self.radius
                if near.any():
                    members.append(waiting[near])
                    reached.extend(members[-1])
                    waiting = waiting[~near]
            if members:
                found = np.concatenate(members)
                edges.append((found, np.full(found.size, root)))
        return edges

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32))
        dividing = None  # the bucket that has turned out too large
        for batch in released(batches):
            new = (
                batch.column("bucket").to_numpy(),
                batch.column("fingerprint").to_numpy().view(np.uint64),
                batch.column("mask").to_numpy(),
            )
            rows = tuple(np.concatenate(pair) for pair in zip(held, new))
            edges, divided, held, dividing = self._step(rows, dividing, False)
            yield from self._out(edges, divided)
        edges, divided, _, _ = self._step(held, dividing, True)
        yield from self._out(edges, divided)

    def _step(self, rows, dividing, ended):
        buckets, prints, masks = rows
        edges, divided = [], []
        if not buckets.size:
            return edges, divided, rows, dividing
        starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
        stops = np.append(starts[1:], buckets.size)
        sizes = stops - starts
        # The last bucket may go on in the next batch.
        whole = sizes.size if ended else sizes.size - 1
        large = sizes > self.limit if self.limit else np.zeros(sizes.size, bool)
        large |= buckets[starts] == dividing if dividing is not None else False
        two = np.flatnonzero((sizes == 2) & ~large)
        two = starts[two[two < whole]]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= self.radius
        edges.append((prints[two + 1][near], prints[two][near]))
        for i in np.flatnonzero((sizes > 2) & ~large):
            if i < whole:
                edges += self._tree(prints[starts[i] : stops[i]])
        for i in np.flatnonzero(large):
            divided.append((prints[starts[i] : stops[i]], masks[starts[i] : stops[i]]))
        if ended:
            return edges, divided, None, None
        if large[-1]:  # handed on as it comes
            return edges, divided, tuple(x[:0] for x in rows), buckets[-1]
        # Without views, so that the batch can go.
        return edges, divided, tuple(x[starts[-1] :].copy() for x in rows), None

    @staticmethod
    def _out(edges, divided):
        for pairs, kind in ((edges, False), (divided, True)):
            pairs = [p for p in pairs if p[0].size]
            if not pairs:
                continue
            first = np.concatenate([a for a, _ in pairs]).view(np.int64)
            other = np.concatenate([b for _, b in pairs])
            linked = pa.nulls(first.size, pa.int64()) if kind else pa.array(other.view(np.int64))
            mask = pa.array(other) if kind else pa.nulls(first.size, pa.int32())
            names = ["fingerprint", "other", "mask"]
            yield pa.RecordBatch.from_arrays([pa.array(first), linked, mask], names)


def _forests(rows: DataFrame, radius: int, limit: int | None) -> DataFrame:
    """(fingerprint, other) for links, (fingerprint, mask) for buckets above the limit."""
    ship(rows.sparkSession)
    together = rows.repartition("bucket").sortWithinPartitions("bucket")
    run = _Forest(radius, limit).__call__
    return together.mapInArrow(run, "fingerprint bigint, other bigint, mask int")


def _bucket_rows(prints: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """A row for each fingerprint and (number, mask), with the hash of what is under it."""
    choices = F.array(
        *[
            F.struct(F.lit(n).alias("mask"), F.lit(_signed(m)).cast("bigint").alias("bits"))
            for n, m in masks
        ]
    )
    rows = prints.select("fingerprint", F.explode(choices).alias("choice"))
    return rows.select(
        F.xxhash64("choice.mask", F.col("fingerprint").bitwiseAND(F.col("choice.bits"))).alias(
            "bucket"
        ),
        "fingerprint",
        "choice.mask",
    )


def _links(prints: DataFrame, radius: int, staging: Staging) -> DataFrame:
    """(fingerprint, other): edges whose components are those of all pairs within `radius`."""
    first = covering_masks(list(range(BITS)), radius)
    numbered = list(enumerate(first))
    found = staging.write(_forests(_bucket_rows(prints, numbered), radius, BUCKET), "links")
    links = found.filter("other IS NOT NULL").select("fingerprint", "other")
    large = found.filter("mask IS NOT NULL")
    if large.isEmpty():
        return links
    parts = []
    for number, mask in numbered:
        outside = [bit for bit in range(BITS) if not mask >> bit & 1]
        again = [
            (number * len(first) + i, mask | finer)
            for i, finer in enumerate(covering_masks(outside, radius))
        ]
        of_mask = large.filter(F.col("mask") == number).select("fingerprint").distinct()
        parts.append(_bucket_rows(of_mask, again))
    divided = _forests(reduce(DataFrame.union, parts), radius, None)
    return links.union(staging.write(divided, "links").select("fingerprint", "other"))


def near_groups(
    docs: DataFrame, radius: int = 3, fingerprint: str = "fingerprint", key: str = "doc_id"
) -> DataFrame:
    """All columns of `docs`, component_id and component_root of each row.

    component_id is the least key among the rows it reaches, component_root the fingerprint
    that stands for them.

    Two rows are linked if their fingerprints differ in at most `radius` bits, and a row
    reaches what is linked to it directly or through others. `docs` is read twice, so it
    should be a staged table. Rows with a null key link others but never name a component;
    one without any key has a null component_id. Rows with a null fingerprint get nulls. Other
    columns of `docs` with names of results give way to them.
    """
    docs = without_results(docs, ["component_id", "component_root"], [fingerprint, key])
    (joined,) = unused(docs.columns, "joined_fingerprint")
    prints = docs.groupBy(F.col(quoted(fingerprint)).alias("fingerprint")).agg(
        F.min(F.col(quoted(key))).alias("first")
    )
    with Staging(docs.sparkSession) as staging:
        prints = staging.write(prints.filter("fingerprint IS NOT NULL"), "fingerprints")
        links = _links(prints, radius, staging)
        roots = connected_components(links, "fingerprint", "other", staging)
        named = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        )
        least = named.groupBy("root").agg(F.min("first").alias("component_id"))
        named = named.join(least, "root").select(
            F.col("fingerprint").alias(joined),
            "component_id",
            F.col("root").alias("component_root"),
        )
        named = stage(named, "components")
    same = F.col(quoted(fingerprint)) == F.col(joined)
    return docs.join(named, same, "left").drop(joined)
