"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by several functions floor((a·x + b) / w) with normal a, so that near
vectors tend to share a bucket. A query visits its own bucket and others next to it, in the
order in which they are likely to hold near vectors: the less the query's projections have to
move over the borders, the earlier. What is found in all tables is ranked by exact inner
products.

The hashes are for distances. Vectors are taken in bands, in which lengths differ by a factor of
two at most. Every vector gets one more coordinate that brings it to the length at the top of
its band, queries are stretched to that length with the coordinate zero: the order by distance
is then that by inner product. A query visits the buckets of every band.

A bucket is a cell of the search; one with many vectors or many queries is dealt over several
cells that together meet every vector with every query, so nothing is left out. A query that
has met too few candidates, whatever the reason, goes on to all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import ship
from lexloom.llm.vectors import (
    BLOCK,
    QUERY_BLOCK,
    SLACK,
    matrix,
    ranked,
    search_cells,
    usable,
)
from lexloom.sources import stage

# So many times the results asked for may reach a query's bound before those of a block are ranked.
FEW_TIMES = 4


@dataclass(frozen=True)
class Index:
    """Parameters of the hash tables.

    `width` is the width of a slot in units of the length at the top of a band, and `probes`
    the buckets a query visits per table and band. More tables, wider slots and more probes
    find more.
    """

    tables: int = 8
    functions: int = 4
    width: float = 1.2
    probes: int = 32
    seed: int = 1


class _Hashes:
    def __init__(self, index: Index, dims: int, bands: list[int]):
        random = np.random.default_rng(index.seed)
        self.index, self.bands = index, bands
        self.directions = random.standard_normal((index.tables, dims + 1, index.functions))
        self.offsets = random.random((index.tables, index.functions))
        # Different for each band, so that their buckets are apart.
        self.band_names = {band: int(x) for band, x in zip(bands, random.integers(1, 2**62, len(bands)))}
        # Every way to move each function's slot by one or not at all.
        self.moves = np.array([*product((0, -1, 1), repeat=index.functions)])
        self.names = random.integers(1, 2**62, (index.tables, index.functions + 1))

    def _buckets(self, table: int, slots: np.ndarray) -> np.ndarray:
        """A number for the bucket with these slots; equal ones for few others, if any."""
        weights = self.names[table]
        with np.errstate(over="ignore"):
            return (slots * weights[:-1]).sum(axis=-1) + weights[-1]

    def _positions(self, table: int, rows: np.ndarray) -> np.ndarray:
        return rows @ self.directions[table] / self.index.width + self.offsets[table]

    def of_vectors(self, rows: np.ndarray) -> np.ndarray:
        """A bucket per vector and table."""
        bands = np.frexp(_lengths(rows))[1]
        names = np.array([self.band_names[band] for band in bands.tolist()], np.int64)
        rows = np.ldexp(rows, -bands[:, None])
        rest = np.sqrt(np.maximum(1.0 - (rows * rows).sum(axis=1), 0.0))
        rows = np.column_stack((rows, rest))
        tables = range(self.index.tables)
        slots = [np.floor(self._positions(t, rows)).astype(np.int64) for t in tables]
        buckets = np.stack([self._buckets(t, s) for t, s in enumerate(slots)], axis=1)
        return buckets ^ names[:, None]

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        """The buckets that each query visits, over all tables and bands."""
        # First by a power of two, as the square of a very small or large number is none.
        rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
        lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        rows = np.column_stack((rows / lengths, np.zeros(len(rows))))
        visited = []
        for table in range(self.index.tables):
            positions = self._positions(table, rows)
            slots = np.floor(positions)
            below = positions - slots
            # The squared way to the slot moved to, summed over the functions.
            ways = np.stack((np.zeros_like(below), 1.0 - below, below), axis=2) ** 2
            chosen = np.arange(below.shape[1])[None, :], self.moves % 3
            effort = ways[:, chosen[0], chosen[1]].sum(axis=2)
            order = np.argsort(effort, axis=1, kind="stable")[:, : self.index.probes]
            moved = slots[:, None, :].astype(np.int64) + self.moves[order]
            buckets = self._buckets(table, moved)
            visited += [buckets ^ name for name in self.band_names.values()]
        return np.concatenate(visited, axis=1)


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Upper ends of the bands follow from these, so they are above what rounding loses."""
    largest = np.frexp(np.abs(rows).max(axis=1))[1]
    scaled = np.ldexp(rows, -largest[:, None])
    return np.ldexp(np.sqrt((scaled * scaled).sum(axis=1)), largest)


def _score(k: int):
    def block(vectors: np.ndarray, ids: np.ndarray):
        lengths = np.sqrt((vectors * vectors).sum(axis=1)).max()

        def find(queries: np.ndarray, bounds: np.ndarray):
            scores = queries @ vectors.T
            slack = SLACK * lengths * np.sqrt((queries * queries).sum(axis=1))
            # Where few reach the bound so far, the k-th best of this block need not be known.
            many = np.count_nonzero(scores >= bounds[:, None], axis=1) > FEW_TIMES * (k + 1)
            if ids.size > k + 1 and many.any():
                own = scores[many]
                least = np.partition(own, ids.size - k - 1, axis=1)[:, ids.size - k - 1]
                bounds = bounds.copy()
                bounds[many] = np.maximum(bounds[many], least)
            row, column = np.nonzero(scores >= (bounds - slack)[:, None])
            # Again, pair by pair: equal vectors then have equal scores, to the last bit.
            exact = np.einsum("ij,ij->i", queries[row], vectors[column])
            return row, ids[column], exact

        return find

    return block


def _cells(rows: DataFrame, counts: DataFrame, own: str, other: str) -> DataFrame:
    """Deals the rows of a bucket over its cells: into one part by key, to all of the other's."""
    hashed = F.xxhash64("id")
    mine = F.pmod(hashed, F.col(own))
    theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
    dealt = rows.join(counts, "bucket").select(
        "bucket", "id", "v", "bound", mine.alias(own), theirs.alias(other)
    )
    return dealt.select(
        F.xxhash64("bucket", "of_vectors", "of_queries").alias("cell"), "id", "v", "bound"
    )


def nearest_by_product(
    df: DataFrame,
    queries: Column,
    k: int,
    index: Index = Index(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score (double): nearest found by inner product.

    `queries` is a condition on `id`, the key; all rows are indexed, and candidates are all
    but the query's own. Ties go to the smaller key. Null, empty and zero vectors, and those
    with null or non-finite components, take no part; of rows that share a key the least
    vector counts; a short vector counts as filled with zeros. Scores are exact, which vectors
    are found is not, but every query gets `k` rows, or all candidates if these are fewer. An
    empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    zero = F.lit(0.0)
    vectors = usable(df, key, vector).filter(F.exists("v", lambda x: x.cast("double") != zero))
    vectors = stage(vectors, "vectors")
    n, dims = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    dims = dims or 1

    def band_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = np.frexp(_lengths(matrix(batch.column("v"), dims)))[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(bands), pa.int32())], ["band"])

    # As many as the exponents of a double at most.
    bands = vectors.select("v").mapInArrow(band_of, "band int").distinct().collect()
    hashes = _Hashes(index, dims, sorted(row["band"] for row in bands))
    hashes = spark.sparkContext.broadcast(hashes)
    element = dict(vectors.dtypes)["v"]

    def with_buckets(of):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                buckets = getattr(hashes.value, of)(matrix(batch.column("v"), dims))
                names = ["id", "v", "buckets"]
                listed = pa.array(buckets.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), listed], names
                )

        return run

    def rows_of(table: DataFrame, of: str) -> DataFrame:
        made = table.select("id", "v").mapInArrow(
            with_buckets(of), f"id bigint, v {element}, buckets array<bigint>"
        )
        distinct = F.explode(F.array_distinct("buckets"))
        bound = F.lit(None).cast("double").alias("bound")
        return made.select("id", "v", bound, distinct.alias("bucket"))

    indexed = rows_of(vectors, "of_vectors")
    visits = rows_of(vectors.filter(queries), "of_queries")

    def parts(rows: DataFrame, size: int, name: str) -> DataFrame:
        number = F.ceil(F.count("*") / size).cast("bigint")
        return rows.groupBy("bucket").agg(number.alias(name))

    # Buckets with vectors and queries; what is in no other needs no work.
    counts = stage(
        parts(indexed, BLOCK, "of_vectors").join(
            parts(visits, QUERY_BLOCK, "of_queries"), "bucket"
        ),
        "buckets",
    )
    offered = _cells(indexed, counts, "of_vectors", "of_queries")
    asking = _cells(visits, counts, "of_queries", "of_vectors")
    found = stage(ranked(_searched(offered, asking, k, dims), k), "neighbours")
    # Queries that met too few; by none of them a row may be missing.
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min(k, n - 1))
    asked = vectors.filter(queries)
    lacking = stage(
        asked.join(full, F.col("id") == F.col("query_id"), "left_anti").select("id", "v"), "lacking"
    )
    many = lacking.count()
    if not many:
        return found
    everywhere = _everywhere(vectors, lacking, -(-n // BLOCK), -(-many // QUERY_BLOCK))
    rest = ranked(_searched(*everywhere, k, dims), k)
    kept = found.join(lacking.select("id"), F.col("query_id") == F.col("id"), "left_anti")
    return kept.union(rest)


def _searched(offered: DataFrame, asking: DataFrame, k: int, dims: int) -> DataFrame:
    rows = offered.withColumn("is_query", F.lit(False)).union(
        asking.withColumn("is_query", F.lit(True))
    )
    rows = rows.repartition("cell").sortWithinPartitions("cell", "is_query")
    return search_cells(rows, k, dims, lambda: _score(k), "double")


def _everywhere(
    vectors: DataFrame, asked: DataFrame, blocks: int, parts: int
) -> tuple[DataFrame, DataFrame]:
    """Cells in which every vector meets every one of `asked`, block against block."""

    def side(rows: DataFrame, own: int, others: int, first: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(own))
        theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint")))
        dealt = rows.select("id", "v", mine.alias("mine"), theirs.alias("theirs"))
        cell = F.col("mine") * others + F.col("theirs")
        if not first:
            cell = F.col("theirs") * own + F.col("mine")
        return dealt.select(
            cell.alias("cell"), "id", "v", F.lit(None).cast("double").alias("bound")
        )

    return side(vectors, blocks, parts, True), side(asked, parts, blocks, False)
