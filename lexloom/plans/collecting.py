"""All tokens of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.randomness import bucket
from lexloom.sources.staging import Staging, stage


def token_bag(df: DataFrame, keys: Sequence[str], tokens: str) -> DataFrame:
    """(keys…, token, n): the tokens of each group with their number.

    The same tokens as a collected array, but counted on each task before the shuffle, and
    a group is spread over its tokens.
    """
    exploded = df.select(*keys, F.explode(tokens).alias("token"))
    return exploded.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))


def collect_by(
    df: DataFrame,
    keys: Sequence[str],
    tokens: str,
    row_key: Sequence[str],
    chunks: int,
    seed: int = 0,
) -> DataFrame:
    """(keys…, chunk, tokens): the tokens of each group in `chunks` arrays at most.

    The input rows of a group are dealt to its arrays by their `row_key`, evenly whatever the
    group's size; with 1 every group is one array. A row cannot grow without end, so name as
    many as the largest group needs. Within an array, tokens follow `row_key`.
    """
    rows = df.select(*keys, F.struct(*row_key).alias("_row"), F.col(tokens).alias("_tokens"))
    u = bucket(*[f"_row.{k}" for k in row_key], purpose="chunk", seed=seed)
    dealt = rows.withColumn("chunk", F.floor(u * chunks).cast("int"))
    parts = F.sort_array(F.collect_list(F.struct("_row", "_tokens")))
    return dealt.groupBy(*keys, "chunk").agg(
        F.flatten(F.transform(parts, lambda p: p["_tokens"])).alias("tokens")
    )


def collect_chunks(
    df: DataFrame, keys: Sequence[str], tokens: str, row_key: Sequence[str], max_tokens: int
) -> DataFrame:
    """(keys…, chunk long, tokens): the tokens of each group in arrays of `max_tokens`.

    The rows of a group follow `row_key`, and equal keys a hash of their tokens; its tokens,
    one after another, are cut into arrays from chunk 0 on, of which only the last may be
    shorter. A row may be cut too, so no array is longer, whatever rows and groups there are.
    Rows without tokens count for nothing. Null keys are a group.

    Where a row's tokens begin is a sum over all rows before it. These sums are taken in two
    steps, over ranges of rows that bear no relation to the groups: within a range, and over
    the totals of the ranges before. So a group with a third of all rows is summed up by a
    third of the tasks.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be 1 or more")
    size = F.size(tokens).cast("bigint")
    own = [F.col(f"`{name}`") for name in keys]
    # The number at the end lets even equal rows lie in several ranges.
    order = [F.xxhash64(tokens).alias("_hash"), F.monotonically_increasing_id().alias("_number")]
    rows = df.filter(size > 0).select(
        F.struct(*own).alias("_group"),
        F.struct(*[F.col(f"`{name}`") for name in row_key], *order).alias("_row"),
        F.col(tokens).alias("_tokens"),
        size.alias("_n"),
    )
    with Staging(df.sparkSession) as staging:
        ranged = rows.repartitionByRange("_group", "_row")
        ranged = staging.write(ranged.withColumn("_range", F.spark_partition_id()), "token-ranges")
        sums = ranged.groupBy("_group", "_range").agg(F.sum("_n").alias("_all"))
        zero = F.lit(0).cast("bigint")
        earlier = (Window.unboundedPreceding, -1)
        # A group has a row per range that it lies in.
        of_ranges = Window.partitionBy("_group").orderBy("_range").rowsBetween(*earlier)
        before = sums.select(
            F.col("_group").alias("_of"),
            F.col("_range").alias("_in"),
            F.coalesce(F.sum("_all").over(of_ranges), zero).alias("_before"),
        )
        within = Window.partitionBy("_group", "_range").orderBy("_row").rowsBetween(*earlier)
        summed = ranged.withColumn("_here", F.coalesce(F.sum("_n").over(within), zero))
        same = F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in"))
        placed = summed.join(before, same).withColumn("_at", F.col("_before") + F.col("_here"))
        first, last = F.col("_at"), F.col("_at") + F.col("_n") - 1
        chunk = F.sequence(F.floor(first / max_tokens), F.floor(last / max_tokens))
        cut = placed.select("_group", "_at", "_n", "_tokens", F.explode(chunk).alias("chunk"))
        start = F.greatest(F.col("chunk") * max_tokens - F.col("_at"), zero)
        stop = F.least((F.col("chunk") + 1) * max_tokens - F.col("_at"), F.col("_n"))
        part = F.slice("_tokens", (start + 1).cast("int"), (stop - start).cast("int"))
        parts = cut.select("_group", "chunk", F.struct("_at", part.alias("part")).alias("_part"))
        joined = F.transform(F.sort_array(F.collect_list("_part")), lambda p: p["part"])
        made = parts.groupBy("_group", "chunk").agg(F.flatten(joined).alias("tokens"))
        groups = [F.col("_group")[name].alias(name) for name in keys]
        return stage(made.select(*groups, "chunk", "tokens"), "token-chunks")
