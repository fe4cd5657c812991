"""Exact top-k inner products over integer vectors, by descending length.

Vectors are dealt into blocks by descending length. The longest ones give every query a first
bound for its k-th score, and as |q||x| bounds a score from above, a query is sent to the
leading blocks only. In a block the coordinates are rotated onto the singular vectors of the
whole table, so that leading coordinates hold most of a product. Partial sums over them plus
the product of the lengths of what is left (Cauchy-Schwarz) bound the score; pairs that cannot
reach the query's bound are dropped before their integer score is worked out.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

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
from lexloom.sources import Staging, stage

# Shares of the coordinates after which partial sums are compared with the bound.
STEPS = (0.25, 0.5)
# Integers up to these are exact as doubles, and as 64-bit integers.
EXACT, EXACT_LONG = 2.0**53, 2.0**62


def _scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vectors)


def _rotation(vectors: DataFrame, dims: int, scale: float, most: float) -> np.ndarray:
    """Right singular vectors of the table, the one with the largest singular value first.

    Only the dims × dims sums of products reach the driver. `most` bounds all components.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            rows = _scaled(matrix(batch.column("v"), dims), scale) / most
            total += rows.T @ rows
        at = np.arange(dims * dims, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "value"])

    parts = vectors.select("v").mapInArrow(products, "at int, value double")
    sums = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    gram = np.zeros(dims * dims)
    for row in sums:
        gram[row["at"]] = row["value"]
    _, rotation = np.linalg.eigh(gram.reshape(dims, dims))
    return rotation[:, ::-1]


class _Scorer:
    """Finds the results in one block that reach the bounds of a tile of queries."""

    def __init__(self, k: int, scale: float, rotation: np.ndarray, most: float):
        self.k, self.scale, self.rotation, self.most = k, scale, rotation, most
        dims = rotation.shape[0]
        self.cuts = [max(1, int(dims * step)) for step in STEPS]

    def _parts(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rotated rows, and the lengths of what is left after each cut."""
        turned = rows @ self.rotation
        return turned, [np.sqrt((turned[:, cut:] ** 2).sum(axis=1)) for cut in self.cuts]

    def __call__(self, vectors: np.ndarray, ids: np.ndarray):
        block = _scaled(vectors, self.scale)
        lengths = np.sqrt((block * block).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        block, ids, lengths = block[order], ids[order], lengths[order]
        turned, rests = self._parts(block)

        def find(queries: np.ndarray, bounds: np.ndarray):
            asked = _scaled(queries, self.scale)
            own = np.sqrt((asked * asked).sum(axis=1))
            slack = SLACK * own * (lengths[0] if lengths.size else 0.0) + SLACK
            bounds = bounds - slack
            # Vectors are in order of length, so those a query can need come first.
            needed = int(np.searchsorted(-(own.max() * lengths), -bounds.min(), side="right"))
            if not needed:
                return np.empty(0, np.int64), ids[:0], np.empty(0, np.int64)
            asked_turned, asked_rests = self._parts(asked)
            possible = np.ones((len(asked), needed), bool)
            partial, done = np.zeros((len(asked), needed)), 0
            for cut, rest, asked_rest in zip(self.cuts, rests, asked_rests):
                partial += asked_turned[:, done:cut] @ turned[:needed, done:cut].T
                possible &= partial + np.outer(asked_rest, rest[:needed]) >= bounds[:, None]
                done = cut
            scores = np.where(possible, asked @ block[:needed].T, -np.inf)
            # In this block only the k best of a query matter, one more as it may be its own.
            if needed > self.k + 1:
                least = np.partition(scores, needed - self.k - 1, axis=1)[:, needed - self.k - 1]
                bounds = np.maximum(bounds, least)
            # The k-th best is rounded as well where integers are not exact as doubles.
            least = (bounds - slack)[:, None]
            rows, columns = np.nonzero(possible & (scores >= least))
            return rows, ids[columns], self._exact(asked, block, rows, columns)

        return find

    def _exact(self, asked, block, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The integer scores of pairs."""
        largest = asked.shape[1] * self.most**2
        if largest < EXACT:
            return np.einsum("ij,ij->i", asked[rows], block[columns]).astype(np.int64)
        if largest < EXACT_LONG:
            whole = asked.astype(np.int64), block.astype(np.int64)
            return np.einsum("ij,ij->i", whole[0][rows], whole[1][columns])
        ints = [[int(x) for x in row] for row in asked], [[int(x) for x in row] for row in block]
        pairs = zip(rows.tolist(), columns.tolist())
        scores = [sum(map(mul, ints[0][i], ints[1][j])) for i, j in pairs]
        if any(abs(score) >= 2**63 for score in scores):
            raise ValueError("a score does not fit a long")
        return np.array(scores, np.int64)


def exact_top_k(
    df: DataFrame,
    queries: Column,
    k: int,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score (long): the k largest integer inner products.

    Each component x counts as floor(scale * x). `queries` is a condition on `id`, the key;
    candidates are all rows but the query's own; ties go to the smaller key. Null and empty
    vectors, and those with null or non-finite components, take no part; of rows that share a
    key the least vector counts; a short vector counts as filled with zeros. Scores of very
    large components are worked out in integers of any size; one among the largest of a query
    that does not fit a long is an error. An empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    with Staging(spark) as staging:
        vectors = staging.write(usable(df, key, vector), "vectors")
        largest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
        n, dims, most = vectors.agg(F.count("*"), F.max(F.size("v")), largest).first()
        dims, most = dims or 1, scale * (most or 0.0) + 1
        rotation = spark.sparkContext.broadcast(_rotation(vectors, dims, scale, most))
        # No integer is further from zero than this.
        reach = lambda x: F.abs(x.cast("double") * scale) + 1.0
        length = F.aggregate("v", F.lit(0.0), lambda total, x: total + F.pow(reach(x), 2.0))
        sorted_ = vectors.withColumn("length", F.sqrt(length)).repartitionByRange(
            max(1, -(-n // block)), F.desc("length"), "id"
        )
        blocks = stage(sorted_.withColumn("block", F.spark_partition_id().cast("bigint")), "blocks")
        # One number per block, and at most a block of vectors, reach the driver.
        tops = blocks.groupBy("block").agg(F.max("length").alias("top")).orderBy("block").collect()
        numbers = np.array([row["block"] for row in tops], np.int64)
        tops = np.array([row["top"] for row in tops])
        first = blocks.filter(F.col("block") == (int(numbers[0]) if numbers.size else 0))
        longest = first.limit(block).select("id", "v").toArrow()
    start = spark.sparkContext.broadcast(
        (longest["id"].to_numpy(), matrix(longest["v"], dims), tops, numbers)
    )
    groups = F.expr(f"pmod(xxhash64(id), {-(-n // QUERY_BLOCK) or 1})")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bounds from the longest vectors, and the blocks that can reach them."""
        ids, rows, tops, numbers = start.value
        rows = _scaled(rows, scale)
        for batch in batches:
            keys = batch.column("id").to_numpy()
            asked = _scaled(matrix(batch.column("v"), dims), scale)
            bounds, cells = [], []
            for key_, one in zip(keys, asked):
                scores = np.where(ids == key_, -np.inf, rows @ one)
                least = -np.inf
                if scores.size > k:
                    least = float(np.partition(scores, scores.size - k)[scores.size - k])
                reach = np.sqrt(one @ one) * tops * (1 + SLACK) + SLACK
                cells.append(numbers[reach >= least].tolist())
                bounds.append(least if np.isfinite(least) else None)
            kind = pa.list_(pa.int64())
            columns = [pa.array(keys), batch.column("v"), pa.array(bounds, pa.float64())]
            columns.append(pa.array(cells, kind))
            names = ["id", "v", "bound", "blocks"]
            yield pa.RecordBatch.from_arrays(columns, names)

    element = dict(blocks.dtypes)["v"]
    routed = (
        blocks.filter(queries)
        .select("id", "v")
        .mapInArrow(route, f"id bigint, v {element}, bound double, blocks array<bigint>")
        .select("id", "v", "bound", F.explode("blocks").alias("block"), groups.alias("part"))
    )
    parts = F.explode(F.sequence(F.lit(0), F.lit((-(-n // QUERY_BLOCK) or 1) - 1)))
    offered = blocks.select(
        "id", "v", F.lit(None).cast("double").alias("bound"), "block", parts.alias("part")
    )
    cells = [
        side.select(
            F.xxhash64("block", F.col("part").cast("bigint")).alias("cell"),
            F.lit(is_query).alias("is_query"),
            "id",
            "v",
            "bound",
        )
        for side, is_query in ((offered, False), (routed, True))
    ]
    rows = cells[0].union(cells[1])
    rows = rows.repartition("cell").sortWithinPartitions("cell", "is_query")
    found = search_cells(
        rows, k, dims, lambda: _Scorer(k, scale, rotation.value, most), "bigint"
    )
    return ranked(found, k)
