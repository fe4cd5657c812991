"""What searches over vectors have in common: usable rows, streams of cells, best results.

A search deals its work into cells. A cell is a bounded block of vectors together with the
queries sent to it. Rows of both kinds are sorted by cell, vectors first, and a task goes
through its cells one after another, so it holds one block and one batch of queries at a time.
Only the best results of each query leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.batches import quoted, released, ship

# Vectors of a cell.
BLOCK = 4096
# Queries of a cell, beyond which they are dealt over several cells.
QUERY_BLOCK = 65_536
# Queries whose scores against a block are held at once.
TILE = 128
# Results held before all but the best of each query are dropped, but twice what was kept at least.
HELD = 200_000
# Scores this much below a bound, relatively, still count as reaching it.
SLACK = 1e-9


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id long, v) of the vectors that take part, one per key.

    Null and empty vectors and those with a null or non-finite value do not take part, nor do
    rows without a key. Of rows that share a key the least vector counts.
    """
    v = F.col(quoted(vector))
    if df.schema[vector].dataType != T.ArrayType(T.FloatType()):
        v = v.cast("array<double>")
    infinite = float("inf")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)

    rows = df.select(F.col(quoted(key)).cast("bigint").alias("id"), v.alias("v"))
    whole = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)
    return rows.filter(whole).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a list column as rows of doubles; short ones are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if values.size == len(column) * dims:
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        if (lengths == dims).all():
            return values.reshape(-1, dims)
    out = np.zeros((len(column), dims))
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


class Best:
    """The k best results of each query so far: larger scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._held, self._most = 0, HELD
        self._bounded = np.empty(0, np.int64)  # queries that have k results, sorted
        self._bounds = np.empty(0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Scores that a new result of these queries must reach."""
        if not self._bounded.size:
            return np.full(queries.size, -np.inf)
        at = np.minimum(np.searchsorted(self._bounded, queries), self._bounded.size - 1)
        return np.where(self._bounded[at] == queries, self._bounds[at], -np.inf)

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self._parts.append((queries, ids, scores))
        self._held += queries.size
        if self._held > self._most:
            queries, ids, scores = self.results()
            # With many queries the best alone are more than that; dropping at every addition
            # would sort all of them again and again.
            self._most = max(HELD, 2 * queries.size)
            self._parts, self._held = [(queries, ids, scores)], queries.size
            last = np.flatnonzero(np.append(queries[1:] != queries[:-1], True))
            full = last[np.diff(np.append(-1, last)) >= self.k]
            self._bounded, self._bounds = queries[full], scores[full].astype(np.float64)

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, ids and scores, sorted; a result that was added twice counts once."""
        if not self._parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        queries, ids, scores = (np.concatenate(x) for x in zip(*self._parts))
        order = np.lexsort((ids, -scores, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        new = np.append(True, (queries[1:] != queries[:-1]) | (ids[1:] != ids[:-1]))
        queries, ids, scores = queries[new], ids[new], scores[new]
        rank = np.arange(queries.size) - np.searchsorted(queries, queries)
        kept = rank < self.k
        return queries[kept], ids[kept], scores[kept]


# Gets the vectors of a block and their ids and prepares them; the result gets a tile of
# queries with their ids and bounds and gives (row of the tile, id, score) of what reaches them.
Scorer = Callable[[np.ndarray, np.ndarray], Callable[..., tuple]]


def search_cells(rows: DataFrame, k: int, dims: int, scorer: Callable[[], Scorer], kind: str):
    """(query, id, score of type `kind`): the k best of each query and task, without itself.

    `rows` has cell (long), is_query (boolean), id, v and bound (double: a score that results
    of this query must reach; null for none).
    """
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, score = Best(k), scorer()
        cell, ids, vectors, ready = None, [], [], None
        for batch in released(batches):
            cells = batch.column("cell").to_numpy()
            asks = batch.column("is_query").to_numpy(zero_copy_only=False)
            keys = batch.column("id").to_numpy()
            given = batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
            given = np.where(np.isnan(given), -np.inf, given)
            values = matrix(batch.column("v"), dims)
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), cells.size]):
                if cells[a] != cell:
                    cell, ids, vectors, ready = cells[a], [], [], None
                if not asks[a]:
                    ids.append(keys[a:b].copy())
                    vectors.append(values[a:b].copy())
                    continue
                if not ids:
                    continue
                if ready is None:
                    block_ids = np.concatenate(ids)
                    ready = score(np.concatenate(vectors), block_ids)
                    vectors = []
                for start in range(a, b, TILE):
                    stop = min(start + TILE, b)
                    queries = keys[start:stop]
                    bounds = np.maximum(given[start:stop], best.bounds(queries))
                    row, found, scores = ready(values[start:stop], bounds)
                    other = queries[row] != found
                    best.add(queries[row[other]], found[other], scores[other])
        queries, found, scores = best.results()
        if queries.size:
            columns = [pa.array(queries), pa.array(found), pa.array(scores).cast(arrow_kind)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    arrow_kind = {"double": pa.float64(), "bigint": pa.int64()}[kind]
    return rows.mapInArrow(run, f"query bigint, id bigint, score {kind}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score: the k best over all tasks."""
    once = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return (
        once.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
    )
