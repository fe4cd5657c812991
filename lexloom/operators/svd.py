"""Truncated singular value decompositions of many sparse matrices in one job.

A matrix is a part of a table of entries (part, row, term, weight). Its rows are dealt into
blocks. A block is packed into one row of arrays, and is all that a task holds of a matrix.

A matrix of one block is decomposed where it is: all of them in one pass, however many there
are. Larger ones are iterated together. In a round every block multiplies the present vectors,
of the terms that it has, by itself and by its transpose; the products are added up per term,
and their products with one another give the matrices, of a few dozen rows, that make them
orthonormal again (Gram-Schmidt, blocked over the terms: vectors are never brought together,
in a task or on the driver, so neither vocabulary nor rows have to fit anywhere). The driver
only learns how many matrices have yet to settle.

Both ways are block subspace iterations with more vectors than asked for, started from random
numbers by term, and with a Rayleigh-Ritz step that takes singular values and vectors out of
the subspace. Singular values below a share of the largest are left out: `LEAST`, and where
they come from squares, `LEAST_OF_SQUARES`.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexloom.sources.staging import Staging, stage

# Rows of a block.
BLOCK_ROWS = 16_384
# Vectors iterated beyond those asked for.
EXTRA = 20
# Matrices with so few rows or columns are decomposed densely.
DENSE = 256
# Squared singular values that move less than this in a round, relatively, have settled.
TOLERANCE = 1e-10
ROUNDS = 100
# Singular values below these shares of the largest are zero but for rounding.
LEAST, LEAST_OF_SQUARES = 1e-9, 1e-4

# Rows and weights of the entries are the bytes of ints and doubles, as Spark hands over arrays
# number by number, and a block goes through a task in every round.
_PACKED = (
    "part bigint, blocks int, block int, terms array<bigint>, ends array<int>,"
    " rows binary, weights binary"
)
_FOUND = "part bigint, concept int, singular_value double, term_hash bigint, weight double"
_MOVED = "part bigint, term_hash bigint, line int, v array<double>"
_TURNED = "part bigint, first array<double>, last array<double>, values array<double>, settled boolean"


def truncated_svd(
    entries: DataFrame,
    k: int,
    part: str = "part",
    row: str = "row",
    term: str = "term",
    weight: str = "weight",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(part, concept int, singular_value, term, weight): right singular vectors of each part.

    `entries` has a row per part, row and term; it is read several times, so it should be
    staged. Concepts count from 1 by falling singular value; a part has as many as its rank
    if that is below `k`. Each vector is turned so that its largest weight in magnitude is
    positive. Null parts are a part, and so are parts with the same value of any type.
    """
    if {part, term, weight} & {"concept", "singular_value"}:
        raise ValueError("columns have names of results: concept, singular_value")
    of, in_row, of_term = (F.col(f"`{name}`") for name in (part, row, term))
    rows = entries.select(
        F.xxhash64(of).alias("part"),
        F.xxhash64(in_row).alias("row"),
        F.xxhash64(of_term).alias("term_hash"),
        F.col(f"`{weight}`").cast("double").alias("weight"),
    )
    names = entries.select(F.xxhash64(of_term).alias("_term_hash"), of_term).distinct()
    values = entries.select(F.xxhash64(of).alias("_part_hash"), of).distinct()
    with Staging(entries.sparkSession) as staging:
        sizes = rows.select("part", "row").distinct().groupBy("part").agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") / block_rows).cast("int")
        several = sizes.filter(F.col("n") > block_rows).select("part", blocks.alias("several"))
        several = staging.write(several, "svd-sizes")
        dealt = _dealt(rows, several)
        apart = _apart(several.agg(F.sum("several")).first()[0] or 0, entries.sparkSession)
        packed = staging.write(_packed(dealt, apart), "svd-blocks")
        found = packed.filter("blocks = 1").mapInArrow(_tools().solver(k), _FOUND)
        large = packed.filter("blocks > 1")
        if not large.isEmpty():
            found = found.union(_iterated(large, k, staging, apart))
        columns = ["_part_hash", "concept", "singular_value", "_term_hash", "_weight"]
        named = found.toDF(*columns).join(names, "_term_hash").join(values, "_part_hash")
        result = named.select(of, "concept", "singular_value", of_term, F.col("_weight").alias(weight))
        return stage(result, "svd")


def _dealt(rows: DataFrame, several: DataFrame) -> DataFrame:
    """Each row's block. Rows are never shuffled by part, as there may be one part only.

    There are fewer parts of several blocks than blocks, so that they can be sent to all tasks.
    """
    dealt = rows.join(F.broadcast(several), "part", "left")
    dealt = dealt.withColumn("blocks", F.coalesce("several", F.lit(1))).drop("several")
    return dealt.withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))


def _apart(blocks: int, spark: SparkSession) -> int:
    """Partitions enough for some blocks."""
    return max(2 * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _together(rows: DataFrame, partitions: int) -> DataFrame:
    """The rows of a block in one task, the blocks of a part in tasks of their own."""
    first = F.pmod("part", F.lit(partitions))
    number = F.pmod(first + F.col("block"), F.lit(partitions)).cast("int")
    return rows.repartitionById(partitions, number)


def _packed(dealt: DataFrame, partitions: int) -> DataFrame:
    """A row per block: its terms in order, where the entries of each end, rows and weights."""
    kind = T.StructType.fromDDL(_PACKED)
    arrow = to_arrow_schema(kind, prefers_large_types=False)
    columns = dealt.select("part", "blocks", "block", "term_hash", "row", "weight")
    together = _together(columns, partitions)
    ordered = together.sortWithinPartitions("part", "block", "term_hash", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> pa.RecordBatch:
            part, blocks, block = key
            terms, rows, weights = (np.concatenate(x) for x in zip(*held))
            _, rows = np.unique(rows, return_inverse=True)
            last = np.append(terms[1:] != terms[:-1], True)
            values = terms[last], np.flatnonzero(last) + 1, rows, weights
            listed = [part, blocks, block, *values[:2]]
            listed += [values[2].astype(np.int32).tobytes(), values[3].tobytes()]
            made = [pa.array([x], f.type) for x, f in zip(listed, arrow)]
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        for batch in batches:
            parts, blocks, numbers, *values = (x.to_numpy() for x in batch.columns)
            edges = np.flatnonzero((parts[1:] != parts[:-1]) | (numbers[1:] != numbers[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), parts.size]):
                if a == b:
                    continue
                own = int(parts[a]), int(blocks[a]), int(numbers[a])
                if own != key:
                    if held:
                        yield close()
                    key, held = own, []
                held.append([x[a:b].copy() for x in values])
        if held:
            yield close()

    return ordered.mapInArrow(run, kind)


def _tools() -> SimpleNamespace:
    """What tasks work with: functions of their own, which need only NumPy and Arrow there."""
    extra, dense, tolerance, most = EXTRA, DENSE, TOLERANCE, ROUNDS
    least, least_of_squares = LEAST, LEAST_OF_SQUARES
    found_kind = to_arrow_schema(T.StructType.fromDDL(_FOUND), prefers_large_types=False)
    moved_kind = to_arrow_schema(T.StructType.fromDDL(_MOVED), prefers_large_types=False)
    turned_kind = to_arrow_schema(T.StructType.fromDDL(_TURNED), prefers_large_types=False)

    class Block:
        def __init__(self, ends, rows, weights):
            self.shape = int(rows.max()) + 1, len(ends)
            self.terms = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            self.rows, self.weights = rows.astype(np.int64), weights
            self.starts = np.append(0, ends[:-1])
            # The entries in order of rows, too: small numbers are sorted by their digits.
            small = rows.astype(np.uint16) if self.shape[0] <= 2**16 else rows
            order = np.argsort(small, kind="stable")
            self.row_terms, self.row_weights = self.terms[order], weights[order]
            first = np.append(True, rows[order][1:] != rows[order][:-1])
            self.row_starts = np.flatnonzero(first)

        def times(self, v: np.ndarray) -> np.ndarray:
            """The block times some vectors; column by column, so that no copy per entry is made."""
            return added(v, self.row_terms, self.row_weights, self.row_starts)

        def back(self, y: np.ndarray) -> np.ndarray:
            return added(y, self.rows, self.weights, self.starts)

        def full(self) -> np.ndarray:
            at = self.rows * self.shape[1] + self.terms
            return np.bincount(at, self.weights, self.shape[0] * self.shape[1]).reshape(self.shape)

    def added(vectors, places, weights, starts) -> np.ndarray:
        """Sums over runs of entries; every row and every term of a block has one."""
        out, met = np.empty((vectors.shape[1], starts.size)), np.empty(places.size)
        for i, column in enumerate(np.ascontiguousarray(vectors.T)):
            np.take(column, places, out=met, mode="clip")
            np.multiply(met, weights, out=met)
            np.add.reduceat(met, starts, out=out[i])
        return np.ascontiguousarray(out.T)

    def unpacked(batch: pa.RecordBatch, i: int) -> tuple:
        lists = (batch.column(x)[i].values.to_numpy(zero_copy_only=False) for x in ("terms", "ends"))
        rows, weights = (batch.column(x)[i].as_buffer() for x in ("rows", "weights"))
        return *lists, np.frombuffer(rows, np.int32), np.frombuffer(weights, np.float64)

    def subspace(products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared singular values, falling, and their vectors in terms of the present ones."""
        values, turn = np.linalg.eigh((products + products.T) / 2)
        return values[::-1], turn[:, ::-1]

    def settled(now: np.ndarray, before: np.ndarray) -> bool:
        return bool((np.abs(now - before) <= tolerance * max(float(now[0]), 0.0)).all())

    def decomposed(block: Block, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Singular values that are not zero, and their right vectors as columns."""
        if min(block.shape) <= dense:
            _, values, vectors = np.linalg.svd(block.full(), full_matrices=False)
            kept = above(values[:k], least)
            return values[:k][kept], vectors[:k][kept].T
        draw = np.random.default_rng(seed & (2**63 - 1))
        v, _ = np.linalg.qr(draw.standard_normal((block.shape[1], k + extra)))
        before = np.zeros(k)
        for _ in range(most):
            y = block.times(v)
            values, turn = subspace(y.T @ y)
            if settled(values[:k], before):
                break
            before = values[:k]
            v, _ = np.linalg.qr(block.back(y))
        values = np.sqrt(np.maximum(values[:k], 0.0))
        kept = above(values, least_of_squares)
        return values[kept], (v @ turn)[:, :k][:, kept]

    def above(values: np.ndarray, share: float) -> np.ndarray:
        return values > share * max(float(values[0]), 1e-300)

    def table(parts, terms, values, vectors) -> pa.RecordBatch:
        n, k = vectors.shape
        columns = [
            np.full(n * k, parts),
            np.tile(np.arange(1, k + 1, dtype=np.int32), n),
            np.tile(values, n),
            np.repeat(terms, k),
            vectors.ravel(),
        ]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=found_kind)

    def solver(k: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    part = batch.column("part")[i].as_py()
                    terms, *packed = unpacked(batch, i)
                    values, vectors = decomposed(Block(*packed), k, part)
                    if values.size:
                        top = vectors[np.abs(vectors).argmax(axis=0), np.arange(values.size)]
                        yield table(part, terms, values, vectors * np.where(top < 0, -1.0, 1.0))

        return run

    def moved(part: int, terms, lines, values: np.ndarray) -> pa.RecordBatch:
        ends = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
        listed = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
        columns = [pa.array(np.full(len(values), part)), terms, lines, listed]
        return pa.RecordBatch.from_arrays(
            [x.cast(f.type) for x, f in zip(columns, moved_kind)], schema=moved_kind
        )

    def multiplier(width: int):
        """Rows of a block: first its packed form, then the vectors of its terms, in order."""

        def products(part, packed, turn, vectors) -> Iterator[pa.RecordBatch]:
            terms, *rest = packed
            block, v = Block(*rest), np.concatenate(vectors)
            if turn is not None:
                v = v @ turn
            y = block.times(v)
            none = pa.nulls(len(terms), pa.int32())
            yield moved(part, pa.array(terms), none, block.back(y))
            numbers = pa.array(np.arange(v.shape[1], dtype=np.int32))
            yield moved(part, pa.nulls(v.shape[1], pa.int64()), numbers, y.T @ y)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, packed, turn, vectors = None, None, None, []
            for batch in batches:
                kinds = batch.column("kind").to_numpy()
                edges = [0, *np.flatnonzero(kinds == 0).tolist(), batch.num_rows]
                edges = sorted({e for x in edges for e in (x, x + 1) if e <= batch.num_rows})
                for a, b in zip(edges, edges[1:]):
                    if kinds[a] == 0:
                        if packed is not None:
                            yield from products(part, packed, turn, vectors)
                        part, packed = batch.column("part")[a].as_py(), unpacked(batch, a)
                        packed = tuple(x.copy() for x in packed)
                        given, vectors = batch.column("turn")[a].as_py(), []
                        turn = None if given is None else np.array(given).reshape(width, -1)
                    else:
                        flat = batch.column("v").slice(a, b - a).flatten()
                        vectors.append(flat.to_numpy(zero_copy_only=False).reshape(b - a, -1).copy())
            if packed is not None:
                yield from products(part, packed, turn, vectors)

        return run

    def grams():
        """Products of the vectors with one another, per part and task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, total = None, None
            for batch in batches:
                parts = batch.column("part").to_numpy()
                edges = np.flatnonzero(parts[1:] != parts[:-1]) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), parts.size]):
                    if a == b:
                        continue
                    flat = batch.column("v").slice(a, b - a).flatten()
                    z = flat.to_numpy(zero_copy_only=False).reshape(b - a, -1)
                    if parts[a] != part:
                        if total is not None:
                            yield out(part, total)
                        part, total = int(parts[a]), 0.0
                    total = total + z.T @ z
            if total is not None:
                yield out(part, total)

        def out(part, total) -> pa.RecordBatch:
            # Numbered from -1 down, apart from the products with the matrix.
            numbers = pa.array(-1 - np.arange(len(total), dtype=np.int32))
            return moved(part, pa.nulls(len(total), pa.int64()), numbers, total)

        return run

    def turner(k: int, width: int):
        """From the summed products of a part: how its vectors are turned next, and at last."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    lines = {x["line"]: x["v"] for x in r["lines"]}
                    inner = np.array([lines[i] for i in range(width)])
                    outer = np.array([lines[-1 - i] for i in range(width)])
                    values, turn = subspace(inner)
                    known = r["values"] is not None
                    given = np.array(r["first"]).reshape(width, width) if known else np.eye(width)
                    before = np.array(r["values"]) if known else np.zeros(k)
                    # Turned and scaled by what they have become, the new vectors are nearly
                    # orthonormal already, however far apart the singular values are. What has
                    # died out stays zero.
                    floor = max(float(values[0]), 1e-300) * least_of_squares**2
                    graded = turn * np.where(values > floor, 1.0 / np.maximum(values, floor), 0.0)
                    spread, axes = subspace(graded.T @ outer @ graded)
                    alive = spread > 1e-12 * max(float(spread[0]), 1e-300)
                    scale = np.where(alive, 1.0 / np.sqrt(np.where(alive, spread, 1.0)), 0.0)
                    # The first vectors are only turned: random ones are not graded yet.
                    first = graded @ ((axes * scale) @ axes.T) if known else turn
                    last = (given @ turn)[:, :k]
                    done = values[0] <= 0.0 or known and settled(values[:k], before)
                    # Those of the first vectors, which are not orthonormal, are no values yet.
                    told = values[:k] if known else np.zeros(k)
                    numbers = [x.ravel().tolist() for x in (first, last, told)]
                    rows.append((r["part"], *numbers, bool(done)))
                if rows:
                    columns = [pa.array(list(x), f.type) for x, f in zip(zip(*rows), turned_kind)]
                    yield pa.RecordBatch.from_arrays(columns, schema=turned_kind)

        return run

    def finisher(k: int):
        """Rows of vectors, each with how its part is turned at last."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    values = np.sqrt(np.maximum(batch.column("values")[i].values.to_numpy(), 0.0))
                    v = batch.column("v")[i].values.to_numpy()
                    last = batch.column("last")[i].values.to_numpy().reshape(v.size, -1)
                    kept = above(values, least_of_squares)
                    own = batch.column("part")[i].as_py(), batch.column("term_hash")[i].as_py()
                    yield table(own[0], np.array([own[1]]), values[kept], (v @ last)[None, kept])

        return run

    return SimpleNamespace(
        solver=solver, multiplier=multiplier, grams=grams, turner=turner, finisher=finisher
    )


def _iterated(packed: DataFrame, k: int, staging: Staging, partitions: int) -> DataFrame:
    """The decompositions of matrices of several blocks; all of them together, round by round."""
    tools, width = _tools(), k + EXTRA
    meeting = staging.write(
        packed.select("part", "block", F.explode("terms").alias("term_hash")), "svd-terms"
    )
    numbers = F.sequence(F.lit(1), F.lit(width))
    random = F.transform(numbers, lambda j: F.xxhash64("term_hash", j) / F.lit(2.0**63))
    vectors = meeting.select("part", "term_hash").distinct().withColumn("v", random)
    payload = packed.select("part", "block", "terms", "ends", "rows", "weights")
    no_numbers = F.lit(None).cast("array<double>")
    packing = ("array<bigint>", "array<int>", "binary", "binary")
    turns, before = None, []
    for number in range(ROUNDS):
        used = vectors
        if turns is None:
            first = payload.withColumn("turn", no_numbers)
        else:
            first = payload.join(turns.select("part", F.col("first").alias("turn")), "part")
        head = first.select(
            "part",
            "block",
            F.lit(0).alias("kind"),
            F.lit(None).cast("bigint").alias("term_hash"),
            *["terms", "ends", "rows", "weights", "turn"],
            no_numbers.alias("v"),
        )
        sent = meeting.join(used, ["part", "term_hash"]).select(
            "part",
            "block",
            F.lit(1),
            "term_hash",
            *[F.lit(None).cast(kind) for kind in packing],
            no_numbers,
            "v",
        )
        order = ["part", "block", "kind", "term_hash"]
        rows = _together(head.union(sent), partitions)
        rows = rows.sortWithinPartitions(*order)
        made = rows.mapInArrow(tools.multiplier(width), _MOVED)
        sums = F.expr(f"array({', '.join(f'sum(v[{i}])' for i in range(width))})").alias("v")
        summed = staging.write(made.groupBy("part", "term_hash", "line").agg(sums), "svd-round")
        vectors = summed.filter("line IS NULL").select("part", "term_hash", "v")
        products = vectors.sortWithinPartitions("part").mapInArrow(tools.grams(), _MOVED)
        products = products.groupBy("part", "line").agg(sums)
        lines = summed.filter("line IS NOT NULL").select("part", "line", "v").union(products)
        # A few dozen rows per part, of a few dozen numbers each.
        small = lines.groupBy("part").agg(F.collect_list(F.struct("line", "v")).alias("lines"))
        if turns is None:
            small = small.select("*", no_numbers.alias("values"), no_numbers.alias("first"))
        else:
            small = small.join(turns.select("part", "values", "first"), "part")
        turned = staging.write(small.mapInArrow(tools.turner(k, width), _TURNED), "svd-turns")
        if number == ROUNDS - 1 or turned.filter("NOT settled").isEmpty():
            break
        for table in before:
            staging.drop(table)
        if turns is None:
            vectors = used
        turns, before = turned, [summed, turned]
    final = used.join(turned.select("part", "last", "values"), "part")
    columns = final.select("part", "term_hash", "v", "last", "values")
    return _positive(columns.mapInArrow(tools.finisher(k), _FOUND))


def _positive(found: DataFrame) -> DataFrame:
    """Each vector turned so that its largest weight in magnitude is positive."""
    largest = F.max_by("weight", F.struct(F.abs("weight"), "term_hash"))
    signs = found.groupBy("part", "concept").agg(F.signum(largest).alias("sign"))
    made = found.join(signs, ["part", "concept"])
    weight = (F.col("weight") * F.col("sign")).alias("weight")
    return made.select("part", "concept", "singular_value", "term_hash", weight)
