"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import released, ship
from lexloom.sources import Staging

# Edges that a task joins by itself before the rounds begin: some ten megabytes.
EDGES_AT_ONCE = 500_000


def _own_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of the edges of one task, as stars around their least nodes."""
    ends = [
        (batch.column("node").to_numpy().copy(), batch.column("root").to_numpy().copy())
        for batch in released(batches)
    ]
    if not ends:
        return
    pairs = np.stack([np.concatenate(side) for side in zip(*ends)])
    nodes, numbers = np.unique(pairs, return_inverse=True)
    left, right = numbers.reshape(2, -1).tolist()
    root = list(range(nodes.size))

    def find(node: int) -> int:
        while root[node] != node:
            root[node] = node = root[root[node]]
        return node

    for a, b in zip(left, right):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = nodes[[find(node) for node in range(nodes.size)]]
    tied = nodes != least
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes[tied]), pa.array(least[tied])], ["node", "root"]
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one root, and no root to another."""
    ends = edges.select(F.col("node").alias("id"), F.lit(1).alias("tied"), F.lit(0).alias("root"))
    ends = ends.union(edges.select("root", F.lit(0), F.lit(1)))
    each = ends.groupBy("id").agg(F.sum("tied").alias("tied"), F.max("root").alias("root"))
    return each.agg(F.count_if(F.expr("tied > 1 OR (tied = 1 AND root = 1)"))).first()[0] == 0


def connected_components(edges: DataFrame, source: str, target: str, staging: Staging) -> DataFrame:
    """(node, root) for each node with an edge, but for the roots: the least node it reaches.

    First every task joins its share of the edges, a bounded number. What these shares leave
    apart is joined by rounds of large-star and small-star steps in turn, until only stars are
    left; the number of rounds grows with the logarithm of the nodes. Each round is written to
    the shared folder, so that a lost executor costs one round, and the round before is
    removed. Node names are long integers. Loops and repeated edges do no harm; edges with a
    null end are left out. `edges` is read twice. The result belongs to `staging`.
    """
    ship(edges.sparkSession)
    ends = edges.select(F.col(source).alias("node"), F.col(target).alias("root"))
    ends = ends.filter("node != root")
    shares = max(1, -(-ends.count() // EDGES_AT_ONCE))
    joined = ends.repartition(shares).mapInArrow(_own_stars, "node bigint, root bigint")
    now = staging.write(joined.distinct(), "edges")
    while not _are_stars(now):
        # Large star: each larger neighbour is tied to the least of all neighbours.
        both = now.union(now.select("root", "node"))
        least = both.groupBy("node").agg(F.min("root").alias("other"))
        least = least.select("node", F.least("node", "other").alias("least"))
        large = (
            both.join(least, "node")
            .filter("root > node")
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
        )
        # Small star: each node and its smaller neighbours are tied to the least of these.
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        tied = large.join(least, "node").filter("root != least")
        tied = tied.select(F.col("root").alias("node"), F.col("least").alias("root"))
        after = staging.write(tied.union(least).distinct(), "edges")
        staging.drop(now)
        now = after
    return now
