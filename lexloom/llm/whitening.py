"""Whitening of embeddings, with covariances by polarisation.

Vectors are taken as integers. Aggregated are squares only, of centred values: for every
dimension, and for the sum of every pair of dimensions. As
var(x + y) = var(x) + var(y) + 2 cov(x, y), differences of these variances are the
covariances. All sums are exact: integers inside the tasks, decimals between them, and Python's
integers on the driver, which gets a number per pair of dimensions however many vectors there
are. The covariances are rounded once, when the matrix for the eigenvectors is assembled.

Values are centred before they are multiplied, by the integer next to the mean m / n. That
leaves the same residue r in every row: with d = x - centre, n * d - r is n * x - S, so that
sum((n * x - S)^2) = n^2 * sum(d^2) - n * r^2, without rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexloom.llm.batches import quoted, released, ship
from lexloom.sources import stage

# Dimensions that the driver's matrices, and the sums of a task, may have.
MOST_DIMS = 4096
# Rows whose pairs of dimensions are added up at once.
ROWS_AT_ONCE = 512
# Values that 64-bit integers hold.
EXACT = 2**63
# Eigenvalues below this share of the largest one, per dimension, are zero but for rounding.
LEAST_SHARE = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What a vector is centred and projected with, from `fit_whitening`."""

    n: int
    sums: tuple[int, ...]  # of each dimension
    components: np.ndarray  # unit vectors, a row each, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray  # share of each in the sum of all eigenvalues
    bound: int  # no |n * x - S| is larger

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of integer rows, as Python's integers where 64 bits may not do."""
        kind = np.int64 if self.n * int(np.abs(x).max(initial=0)) < EXACT // 2 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over the root of their eigenvalues."""
        rows = (centred / self.n).astype(np.float64)
        return rows @ self.components.T / np.sqrt(self.eigenvalues)

    def deviations(self, centred: np.ndarray) -> np.ndarray:
        """The sum of the squares of each row, which must fit a long."""
        if centred.shape[1] * self.bound**2 >= EXACT:
            centred = centred.astype(object)
        sums = (centred * centred).sum(axis=1)
        if int(sums.max(initial=0)) >= EXACT:
            raise ValueError("deviations do not fit a long")
        return sums


def integer_vectors(df: DataFrame, vector: str, scale: float, shift: int) -> DataFrame:
    """`row` (struct of all columns of `df`) and x (array of long): floor(scale * c) + shift.

    Null and empty vectors and those with a null or non-finite entry are left out. An entry
    whose integer does not fit a long is an error.
    """
    v, infinite = F.col(quoted(vector)), float("inf")

    def finite(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite)

    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("bigint") + shift)
    whole = df.filter((F.size(v) > 0) & F.forall(v, finite))
    return whole.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), x.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    if values.size == len(column) * dims and (np.diff(column.offsets) == dims).all():
        return values.reshape(-1, dims)
    lengths = {len(row) for row in column.to_pylist()}
    raise ValueError(f"vectors have different lengths: {sorted(lengths | {dims})}")


def _sums(
    vectors: DataFrame, dims: int, add: Callable[[], Callable[[np.ndarray], None]], of: str
) -> DataFrame:
    """(at, value): what the tasks have added up, a row for each number, summed over all tasks.

    `add()` gives a function that takes the rows of a batch and one that tells the totals.
    """
    kind = T.StructType.fromDDL(f"at int, value {of}")
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, totals = add()
        for batch in released(batches):
            rows = _matrix(batch.column("x"), dims)
            for at in range(0, len(rows), ROWS_AT_ONCE):
                take(rows[at : at + ROWS_AT_ONCE])
        values = pa.array(totals(), arrow.field("value").type)
        numbers = pa.array(np.arange(len(values), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([numbers, values], schema=arrow)

    parts = vectors.select("x").mapInArrow(run, kind)
    return parts.groupBy("at").agg(F.sum("value").alias("value"))


def _collected(sums: DataFrame, size: int, none) -> list:
    """The numbers in order; there are as many as pairs of dimensions at most."""
    out = [none] * size
    for row in sums.collect():
        out[row["at"]] = row["value"]
    return out


def _pairs(dims: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(dims) for j in range(i, dims)]


def polarised_squares(vectors: DataFrame, centre: tuple[int, ...], spread: int) -> list[int]:
    """For every pair i <= j the exact sum of (d_i + d_j)^2, d = x - centre; of d_i^2 for i = j.

    `spread` bounds |d|. Sums are held in 64 bits as long as they fit, and else as Python's
    integers.
    """
    dims = len(centre)

    def add():
        small = ROWS_AT_ONCE * 4 * spread**2 < EXACT
        kind = np.int64 if small else object
        total = [0] * (dims * (dims + 1) // 2)
        middle = np.array(centre, np.int64 if max(map(abs, centre)) < EXACT // 2 else object)

        def take(x: np.ndarray) -> None:
            d = (x - middle).astype(kind)
            at = 0
            for i in range(dims):
                sums = d[:, i:] + d[:, i : i + 1]
                sums[:, 0] = d[:, i]
                for j, value in enumerate((sums * sums).sum(axis=0).tolist()):
                    total[at + j] += int(value)
                at += dims - i

        return take, lambda: total

    sums = _collected(_sums(vectors, dims, add, "decimal(38,0)"), dims * (dims + 1) // 2, 0)
    return [int(x or 0) for x in sums]


def covariances(n: int, residues: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n), each entry rounded once.

    `squares` is what `polarised_squares` gives, `residues` the sums of d per dimension.
    """
    dims = len(residues)
    exact = {}
    for (i, j), square in zip(_pairs(dims), squares):
        # sum((n * x - S)^2) / n of the dimension, or of the sum of both.
        residue = residues[i] + (residues[j] if i != j else 0)
        exact[i, j] = n * square - residue**2
    out = np.empty((dims, dims))
    for i, j in exact:
        both = exact[i, j] if i == j else (exact[i, j] - exact[i, i] - exact[j, j])
        # Division of Python's integers rounds once, whatever their size.
        out[i, j] = out[j, i] = both / (n**2 if i == j else 2 * n**2)
    return out


def fit_whitening(vectors: DataFrame, components: int) -> Whitening | None:
    """The whitening of the x of all rows; None of an empty table.

    `vectors` is read twice. Components without variance are left out.
    """
    ship(vectors.sparkSession)
    n, dims, least, most = vectors.agg(
        F.count("*"), F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))
    ).first()
    if not n:
        return None
    if dims > MOST_DIMS:
        raise ValueError(f"vectors have {dims} dimensions, more than {MOST_DIMS}")

    def add():
        total = [0] * dims

        def take(x: np.ndarray) -> None:
            # In halves, as a sum of 64-bit integers may not fit 64 bits.
            high = (x >> 32).sum(axis=0).tolist()
            low = (x & 0xFFFFFFFF).sum(axis=0).tolist()
            for i in range(dims):
                total[i] += (int(high[i]) << 32) + int(low[i])

        return take, lambda: total

    sums = [int(x) for x in _collected(_sums(vectors, dims, add, "decimal(38,0)"), dims, 0)]
    centre = tuple((2 * s + n) // (2 * n) for s in sums)
    residues = [s - n * c for s, c in zip(sums, centre)]
    spread = max(abs(x - c) for c in centre for x in (least, most))
    matrix = covariances(n, residues, polarised_squares(vectors, centre, spread))
    values, turned = np.linalg.eigh(matrix)
    values, turned = values[::-1], turned[:, ::-1]
    kept = int((values > LEAST_SHARE * dims * max(values[0], 0.0)).sum())
    kept = min(kept, components)
    return Whitening(
        n,
        tuple(sums),
        turned.T[:kept].copy(),
        values[:kept].copy(),
        values[:kept] / np.trace(matrix),
        n * (spread + 1),
    )


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Measured on the whitened rows themselves, centred by their own mean.
    """
    k, n, dims = len(whitening.eigenvalues), whitening.n, len(whitening.sums)
    if not k:
        return 0.0

    def means():
        total = np.zeros(k)

        def take(x: np.ndarray) -> None:
            total[:] += whitening.whitened(whitening.centred(x)).sum(axis=0)

        return take, lambda: total

    mean = np.array(_collected(_sums(vectors, dims, means, "double"), k, 0.0)) / n

    def products():
        total = np.zeros((k, k))

        def take(x: np.ndarray) -> None:
            rows = whitening.whitened(whitening.centred(x)) - mean
            total[:] += rows.T @ rows

        return take, lambda: total.ravel()

    sums = _collected(_sums(vectors, dims, products, "double"), k * k, 0.0)
    return float(np.abs(np.array(sums).reshape(k, k) / n - np.eye(k)).max())


def whitened(
    df: DataFrame,
    components: int = 32,
    scale: float = 64.0,
    shift: int = 1_000_000,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """vec_id, component (int, from 1), n, deviation (long), whitened, explained, identity_error.

    A row for each usable row of `df` and each component; all usable rows are fitted. Entries c
    count as the integers floor(scale * c) + shift. `n` is the number of usable rows, deviation
    the exact sum over the dimensions of (n * x - S)^2, whitened the centred vector projected
    on the component over the root of its eigenvalue, explained the component's share of the
    variance, identity_error what `identity_error` says of all rows. Components are unit
    eigenvectors of the covariance by falling eigenvalue, of either sign; those without
    variance are left out, so equal vectors, or one vector alone, give no rows.

    Null and empty vectors and those with a null or non-finite entry take no part. Repeated
    rows, also of one key, and rows with a null key count each. Vectors of different lengths,
    and integers or deviations that do not fit a long, are an error. An empty table gives no
    rows. Other columns are not read.
    """
    spark = df.sparkSession
    columns = df.select(F.col(quoted(key)).alias("vec_id"), F.col(quoted(vector)).alias("v"))
    usable = integer_vectors(columns, "v", scale, shift).select("row.vec_id", "x")
    kind = T.StructType(
        [
            T.StructField("vec_id", df.schema[key].dataType),
            *T.StructType.fromDDL(
                "component int, n bigint, deviation bigint, whitened double, explained double,"
                " identity_error double"
            ).fields,
        ]
    )
    # Read by four passes: as long as the vectors themselves, and without their other columns.
    vectors = stage(usable, "integers")
    fitted = fit_whitening(vectors, components)
    if fitted is None or not fitted.eigenvalues.size:
        return spark.createDataFrame([], kind)
    error = identity_error(vectors, fitted)
    shared = spark.sparkContext.broadcast(fitted)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k, dims = len(w.eigenvalues), len(w.sums)
        for whole in released(batches):
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                m = batch.num_rows
                centred = w.centred(_matrix(batch.column("x"), dims))
                rows = pa.array(np.repeat(np.arange(m), k))
                made = [
                    np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    np.full(m * k, w.n),
                    pa.array(w.deviations(centred).tolist(), pa.int64()).take(rows),
                    w.whitened(centred).ravel(),
                    np.tile(w.explained, m),
                    np.full(m * k, error),
                ]
                keys = batch.column("vec_id").take(rows)
                columns = [keys, *[x if isinstance(x, pa.Array) else pa.array(x) for x in made]]
                columns = [x.cast(f.type) for x, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return vectors.mapInArrow(run, kind)
