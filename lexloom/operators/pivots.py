"""Exact k nearest neighbours by cosine similarity that leave out what bounds rule out.

Vectors are dealt to cells, each to the pivot at the smallest angle, and cells to blocks of a
bounded number of rows. A row first meets its own block, and its k-th best there is a bound:
angles obey the triangle inequality, so a cell whose pivot is further away than the cell's radius
and the angle of that bound cannot hold a better one. Rows go on only to the cells that remain,
and only what reaches their bound is shuffled for the final ranking. On vectors without any
structure no cell can be left out, and all blocks meet as they do in `nearest`.

The driver holds the pivots, a radius and a count per cell, and which cells meet: at most
MOST_PIVOTS vectors and as many pairs of cells as that number squared, whatever the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.operators.nearest import BLOCK_ROWS, TILE_ROWS, WAVES
from lexloom.sources.staging import Staging, stage

MOST_PIVOTS = 256
# Pivots are chosen among this many times their number of vectors, as far apart as possible.
CANDIDATES = 8
# Angles are worked out to about 2e-8 where they are small; bounds give way by more.
ANGLE_SLACK = 1e-6


def pivot_count(n: int) -> int:
    """An eighth of the root of the number of vectors: cells are few beside what they hold."""
    return min(max(math.isqrt(n) // 8, 1), MOST_PIVOTS)


def spread(candidates: np.ndarray, count: int) -> np.ndarray:
    """At most `count` of these unit vectors, each the furthest from those before it."""
    if not len(candidates):
        return candidates
    chosen, closest = [0], candidates @ candidates[0]
    while len(chosen) < count and closest.min() < 1.0 - 1e-9:
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, candidates @ candidates[chosen[-1]])
    return candidates[chosen]


def _unit_maker() -> Callable[[pd.Series], tuple[np.ndarray, np.ndarray]]:
    def unit_rows(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Rows of length one, and which rows have a direction at all; others become zeros."""
        m = np.stack(vectors.to_numpy()).astype(np.float64)
        largest = np.abs(m).max(axis=1, keepdims=True)
        directed = (np.isfinite(largest) & (largest > 0)).ravel()
        m = np.where(directed[:, None], m, 0.0)
        length = np.sqrt((m * m).sum(axis=1, keepdims=True))
        directed &= (np.isfinite(length) & (length > 0)).ravel()
        return np.divide(m, length, out=np.zeros_like(m), where=directed[:, None]), directed

    return unit_rows


def _dealer(pivots: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(a, v) to (a, v, cell, angle); rows without a direction have a cell of their own."""
    unit_rows = _unit_maker()

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            unit, directed = unit_rows(frame["v"])
            cell = np.full(len(frame), len(pivots), dtype=np.int32)
            angle = np.zeros(len(frame))
            if len(pivots):
                away = np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))
                cell[directed] = away.argmin(axis=1)[directed]
                angle[directed] = away.min(axis=1)[directed]
            yield frame.assign(cell=cell, angle=angle)

    return deal


def _finders(
    pivots: np.ndarray, members: np.ndarray, radius: np.ndarray, parts: np.ndarray, k: int, scale: int
) -> tuple[Callable, Callable]:
    """The work on a block by itself and on a block's rows with another block."""
    unit_rows = _unit_maker()
    tile_rows, slack = TILE_ROWS, ANGLE_SLACK
    none = len(pivots)

    def best(
        unit: np.ndarray, keys: np.ndarray, floor: np.ndarray, theirs: np.ndarray, names: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, column, scaled similarity) of the k best per row; columns are in key order."""
        kept = min(k + 1, len(names))
        for start in range(0, len(unit), tile_rows):
            stop = start + tile_rows
            similarity = np.rint(unit[start:stop] @ theirs.T * scale).astype(np.int64)
            # One more than k, as a row may meet itself.
            least = -np.partition(-similarity, kept - 1, axis=1)[:, kept - 1]
            least = np.maximum(least, floor[start:stop])
            i, j = np.nonzero(similarity >= least[:, None])
            others = keys[start + i] != names[j]
            i, j = i[others], j[others]
            scaled = similarity[i, j]
            order = np.lexsort((j, -scaled, i))
            i, j, scaled = i[order], j[order], scaled[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            yield start + i[first], j[first], scaled[first]

    def visits(unit: np.ndarray, directed: np.ndarray, floor: np.ndarray, cell: int) -> np.ndarray:
        """Per row, which cells may hold something that reaches its bound."""
        upper = np.zeros((len(unit), none + 1))
        if none:
            away = np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))
            gap = np.clip(away - radius[None, :none] - slack, 0.0, np.pi)
            upper[:, :none] = np.where(directed[:, None], np.cos(gap), 0.0)
        needed = upper * scale >= (floor - 2)[:, None]
        needed &= (members > 0)[None, :]
        if parts[cell] == 1:
            needed[:, cell] = False
        return needed

    def at_home(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("a", kind="stable").reset_index(drop=True)
        unit, directed = unit_rows(frame["v"])
        keys, n = frame["a"].to_numpy(), len(frame)
        floor = np.full(n, -2 * scale, dtype=np.int64)
        others: list = [keys[:0]] * n
        scores: list = [floor[:0]] * n
        for i, j, scaled in best(unit, keys, floor.copy(), unit, keys):
            rows, starts = np.unique(i, return_index=True)
            for row, start, stop in zip(rows, starts, [*starts[1:], len(i)]):
                others[row], scores[row] = keys[j[start:stop]], scaled[start:stop]
                if stop - start == k:
                    floor[row] = scaled[stop - 1]
        needed = visits(unit, directed, floor, int(frame["cell"].iloc[0]))
        return pd.DataFrame(
            {
                "a": frame["a"],
                "v": frame["v"],
                "cell": frame["cell"],
                "block": frame["block"],
                "others": others,
                "scores": scores,
                "floor": floor,
                "visits": [np.flatnonzero(row).astype(np.int32) for row in needed],
            }
        )

    def abroad(these: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        if these.empty or those.empty:
            return pd.DataFrame({"a": [], "other": [], "scaled": []})
        those = those.sort_values("b", kind="stable")
        unit, theirs = unit_rows(these["v"])[0], unit_rows(those["w"])[0]
        keys, names = these["a"].to_numpy(), those["b"].to_numpy()
        found = [
            pd.DataFrame({"a": keys[i], "other": names[j], "scaled": scaled})
            for i, j, scaled in best(unit, keys, these["floor"].to_numpy(), theirs, names)
        ]
        return pd.concat(found, ignore_index=True)

    return at_home, abroad


@dataclass(frozen=True)
class PivotSearch:
    """The neighbours, and what was compared to find them.

    `homes` has a row per entity with the cells it visited beside its own block.
    """

    found: DataFrame
    homes: DataFrame
    cells: int

    def visits(self) -> DataFrame:
        """(rows, visits, all_visits): visits of other cells made, and without any bounds."""
        rows = F.count(F.lit(1))
        return self.homes.agg(
            rows.alias("rows"),
            F.coalesce(F.sum(F.size("visits")), F.lit(0)).cast("long").alias("visits"),
            (rows * F.lit(self.cells - 1)).alias("all_visits"),
        )


def pivot_search(
    df: DataFrame,
    entity: str,
    vector: str,
    k: int = 10,
    digits: int = 9,
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
) -> PivotSearch:
    """The k most similar others of each entity, with counts of the cells that rows visited.

    `found` is (entity, other, similarity, rank) as `nearest` gives it: `df` has one row per
    entity and is read twice, entities without a vector, or with one shorter than the longest,
    are left out, similarities are rounded to `digits` before ranking, ties go by the key of the
    other entity. Zero vectors and vectors with non-finite components are 0 similar to all, and
    so are those whose squares leave the range of doubles. An empty table gives no rows.
    """
    if k < 1:
        raise ValueError(f"k must be 1 or more, not {k}")
    if pivots is not None and not 1 <= pivots <= MOST_PIVOTS:
        raise ValueError(f"pivots must be 1 to {MOST_PIVOTS}, not {pivots}")
    spark = df.sparkSession
    scale = 10**digits
    key_type = df.schema[entity].dataType
    entity_column, vector_column = (F.col(f"`{name}`") for name in (entity, vector))
    # Vectors are sent to several tasks: floats go as they are and become doubles there.
    sent_type = df.schema[vector].dataType
    if sent_type != T.ArrayType(T.FloatType()):
        sent_type = T.ArrayType(T.DoubleType())
    sent = df.select(entity_column.alias("a"), vector_column.cast(sent_type).alias("v"))
    n, dims = sent.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    sent = sent.filter(F.col("a").isNotNull() & (F.size("v") == F.lit(dims)))

    wanted = pivot_count(n) if pivots is None else pivots
    drawn = sent.orderBy(F.xxhash64("a"), "a").limit(CANDIDATES * wanted).select("v").collect()
    chosen = np.zeros((0, max(dims or 0, 0)))
    if drawn:
        unit, directed = _unit_maker()(pd.Series([r.v for r in drawn]))
        chosen = spread(unit[directed], wanted)

    def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in fields])

    integers, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    row = [("a", key_type), ("v", sent_type), ("cell", T.IntegerType())]
    with Staging(spark) as staging:
        dealt = staging.write(
            sent.mapInPandas(_dealer(chosen), struct(*row, ("angle", T.DoubleType()))), "pivot-cells"
        )
        members = np.zeros(len(chosen) + 1, dtype=np.int64)
        radius = np.zeros(len(chosen) + 1)
        # One row per pivot at most.
        sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r"))
        for size in sizes.collect():
            members[size.cell], radius[size.cell] = size.n, size.r
        parts = np.maximum(-(-members // block_rows), 1)
        first = np.concatenate([[0], np.cumsum(parts)[:-1]])
        cells = spark.createDataFrame(
            [(i, int(first[i]), int(parts[i])) for i in range(len(parts))],
            "cell int, first long, parts long",
        )
        tasks = WAVES * spark.sparkContext.defaultParallelism
        at_home, abroad = _finders(chosen, members, radius, parts, k, scale)
        blocked = dealt.join(F.broadcast(cells), "cell").select(
            "a", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("a"), "parts")).alias("block")
        )
        home_type = struct(
            *row,
            ("block", T.LongType()),
            ("others", T.ArrayType(key_type)),
            ("scores", longs),
            ("floor", T.LongType()),
            ("visits", integers),
        )
        partitions = int(min(parts.sum(), tasks))
        homes = stage(
            blocked.repartition(partitions, "block")
            .groupBy("block")
            .applyInPandas(at_home, home_type),
            "pivot-homes",
        )

    visit = homes.select("cell", F.explode("visits").alias("visited"))
    # At most a row per pair of pivots.
    meetings = [(r.cell, r.visited) for r in visit.distinct().collect()]
    own = homes.select(
        "a", F.explode(F.arrays_zip("others", "scores")).alias("o")
    ).select("a", F.col("o.others").alias("other"), F.col("o.scores").alias("scaled"))
    found = own
    if meetings:
        pairs = int(sum(parts[c] * parts[d] for c, d in meetings))
        partitions = min(pairs, tasks)
        blocks = F.explode(F.expr("sequence(first, first + parts - 1)"))
        other_blocks = F.col("home") != F.col("target")
        queries = (
            homes.select(
                "a", "v", "floor", F.col("block").alias("home"), F.explode("visits").alias("cell")
            )
            .join(F.broadcast(cells), "cell")
            .select("a", "v", "floor", "home", blocks.alias("target"))
            .filter(other_blocks)
            .repartition(partitions, "home", "target")
        )
        met = spark.createDataFrame(
            [(int(d), int(first[c]), int(parts[c])) for c, d in meetings],
            "cell int, first long, parts long",
        )
        those = (
            homes.select("a", "v", "cell", F.col("block").alias("target"))
            .join(F.broadcast(met), "cell")
            .select(F.col("a").alias("b"), F.col("v").alias("w"), blocks.alias("home"), "target")
            .filter(other_blocks)
            .repartition(partitions, "home", "target")
        )
        elsewhere = (
            queries.groupBy("home", "target")
            .cogroup(those.groupBy("home", "target"))
            .applyInPandas(
                abroad, struct(("a", key_type), ("other", key_type), ("scaled", T.LongType()))
            )
        )
        found = own.unionByName(elsewhere)
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("scaled"), "other"))
    found = (
        found.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select(
            F.col("a").alias(entity),
            "other",
            (F.col("scaled") / F.lit(float(scale))).alias("similarity"),
            "rank",
        )
    )
    return PivotSearch(found, homes, int((members > 0).sum()))


def nearest_by_pivots(df: DataFrame, entity: str, vector: str, k: int = 10, **named) -> DataFrame:
    """(entity, other, similarity, rank): the rows of `pivot_search`."""
    return pivot_search(df, entity, vector, k, **named).found
