"""Document embeddings: the mean of the word vectors of a document.

Fit once on the whole corpus, save, and transform any table with the saved model.

Words are trained as skip-grams with negative sampling: the vector of a word is moved to tell
the words around it from words drawn at random. The corpus is dealt to parts of a bounded
number of tokens. A task holds one part's words and lets its documents pass; what the parts
make of a word is averaged, in proportion to how often they used it, before the next
iteration. Vectors are rows of a table from first to last, so the vocabulary has to fit
neither on the driver nor in a task. Parts are gone through in waves of a bounded number, and
each wave's words join the mean so far, so the disk never holds more than the words of a wave.

Words are known by a 64-bit hash while they are trained.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexloom.operators.blocks import (
    apart,
    averaged,
    of_wave,
    to_bytes,
    to_lists,
    tools,
    union,
    used_words,
    wave_of,
    wave_size,
)
from lexloom.sources import read_parquet
from lexloom.sources.staging import Staging, stage

# Fixed value: the length of a document vector.
DIMS = 100
# Parts of the corpus that train side by side at least; the vectors depend on their number.
PARTITIONS = 8
# Tokens of a part on average.
PART_TOKENS = 4_000_000
# Words on each side of a word that it may meet, words drawn at random for each that it meets.
WINDOW, NEGATIVES = 5, 5
# Tokens whose vectors move together, words drawn at random for them.
TOGETHER, DRAWN = 1024, 64
# Power of the frequency by which words are drawn.
DRAW_POWER = 0.75
# Step per pair of words, which falls in a straight line to its last share, and the longest
# step of a vector in one go.
STEP, LAST_STEP, LONGEST_STEP = 0.025, 1e-4, 1.0

# What passes the tasks: a word's own vector and its outer one behind it, as bytes.
_DOCUMENTS = "block int, number bigint, words binary"
_TRAINED = "block int, word bigint, n bigint, vector binary, weight double"
_WORDS = "word bigint, vector binary"
_MODEL = "word string, hash bigint, vector array<float>"
_ADDED = "number bigint, vector binary"


@dataclass(frozen=True)
class EmbeddingModel:
    """The vectors of the words: (word string, hash long, vector array<float>)."""

    words: DataFrame
    dims: int

    def getVectors(self) -> DataFrame:
        """(word, vector), a row per word."""
        vector = array_to_vector(F.col("vector").cast("array<double>"))
        return self.words.select("word", vector.alias("vector"))

    def save(self, path: str) -> None:
        """Write the vectors as Parquet; their length is a column, so one path is all."""
        self.words.withColumn("dims", F.lit(self.dims)).write.parquet(path)


def fit_embedding(
    df: DataFrame,
    tokens: str,
    seed: int,
    dims: int = DIMS,
    min_count: int = 5,
    iterations: int = 1,
    partitions: int = PARTITIONS,
    part_tokens: int = PART_TOKENS,
) -> EmbeddingModel:
    """Train vectors for all words that occur `min_count` times.

    At least `partitions` parts train side by side and are averaged, more if they would have
    more than `part_tokens` tokens: more are faster on more cores, and give other vectors. The
    result depends on the seed and on how the rows are laid out in their partitions.
    """
    spark = df.sparkSession
    with Staging(spark) as staging:
        docs = staging.write(_numbered(df, tokens), "embedding-tokens")
        found = df.select(F.explode(F.col(f"`{tokens}`")).alias("word"))
        counted = found.filter("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n"))
        counted = counted.filter(F.col("n") >= min_count)
        counts = staging.write(counted.withColumn("hash", F.xxhash64("word")), "word-counts")
        if counts.isEmpty():
            raise ValueError(f"no word occurs {min_count} times")
        parts, mean = _parts(docs, partitions, part_tokens)
        given, wave = _dealt(docs, parts, staging)
        hashed = counts.select(F.col("hash").alias("word"), "n")
        used = staging.write(used_words(given).join(hashed, "word"), "embedding-words", ["wave"])
        words = None
        for number in range(iterations):
            means, work = None, _trainer(seed, dims, number, iterations, mean)
            for turn in range(-(-parts // wave)):
                known = of_wave(used, turn)
                if words is None:
                    known = known.withColumn("vector", F.lit(None).cast("binary"))
                else:
                    known = known.join(words.select("word", "vector"), "word")
                rows = _meeting(of_wave(given, turn), known, wave)
                made = rows.mapInArrow(work, _TRAINED)
                made = made if means is None else made.union(means)
                learnt = staging.write(averaged(made), "embedding-round")
                if means is not None:
                    staging.drop(means)
                means = learnt
            if words is not None:
                staging.drop(words)
            words = means
        own = F.expr(f"substring(vector, 1, {4 * dims})").alias("vector")
        named = counts.select("word", "hash").join(
            words.select(F.col("word").alias("hash"), own), "hash"
        )
        listed = named.select("word", "hash", "vector").mapInArrow(to_lists(_MODEL), _MODEL)
        return EmbeddingModel(stage(listed, "word-vectors"), dims)


def load_embedding(path: str) -> EmbeddingModel:
    """The model that `save` wrote."""
    table = read_parquet(SparkSession.active(), path)
    return EmbeddingModel(table.select("word", "hash", "vector"), table.select("dims").first()[0])


def embed(
    df: DataFrame,
    model: EmbeddingModel,
    tokens: str,
    output: str = "embedding",
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """Add the document vector as array<double>: the sum of its words' by its number of tokens.

    Null and empty arrays, and those without a known word, get zeros.
    """
    columns = [c for c in df.columns if c != output]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    numbered = df.select(F.monotonically_increasing_id().alias("number"), row)
    docs = stage(numbered, "embedding-rows")
    with Staging(df.sparkSession) as staging:
        hashes = docs.select("number", _hashes(F.col("row")[tokens]))
        parts, _ = _parts(hashes, PARTITIONS, part_tokens)
        given, wave = _dealt(hashes, parts, staging)
        words = model.words.select(F.col("hash").alias("word"), "vector")
        words = staging.write(words.mapInArrow(to_bytes(_WORDS), _WORDS), "embedding-vectors")
        used = staging.write(used_words(given), "embedding-words", ["wave"])
        made = []
        # Rows stay where they are: only their words and vectors pass a task.
        for turn in range(-(-parts // wave)):
            known = of_wave(used, turn).join(words, "word")
            known = known.withColumn("n", F.lit(None).cast("bigint"))
            meeting = _meeting(of_wave(given, turn), known, wave)
            added = meeting.mapInArrow(_adder(model.dims), _ADDED)
            made.append(stage(added, "document-vectors"))
    kept = [F.col("row")[c].alias(c) for c in columns]
    kind = "number bigint, vector array<double>"
    joined = docs.join(union(made).mapInArrow(to_lists(kind), kind), "number")
    return joined.select(*kept, F.col("vector").alias(output))


def _hashes(tokens: Column) -> Column:
    found = F.coalesce(tokens, F.array().cast("array<string>"))
    return F.transform(found, lambda t: F.xxhash64(t)).alias("words")


def _numbered(df: DataFrame, tokens: str) -> DataFrame:
    """(number, words): a number per row, so that no key is too frequent."""
    return df.select(F.monotonically_increasing_id().alias("number"), _hashes(F.col(f"`{tokens}`")))


def _parts(docs: DataFrame, least: int, part_tokens: int) -> tuple[int, int]:
    """How many parts there are, and their tokens on average."""
    total = docs.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(least, -(-total // part_tokens))
    return parts, max(1, total // parts)


def _dealt(docs: DataFrame, parts: int, staging: Staging) -> tuple[DataFrame, int]:
    """(block, number, words, wave), a part being a block, and how many parts are a wave."""
    wave = wave_size(parts, docs.sparkSession)
    block = F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int").alias("block")
    rows = docs.select(block, "number", "words").mapInArrow(to_bytes(_DOCUMENTS), _DOCUMENTS)
    return staging.write(rows.select("*", wave_of(wave)), "embedding-parts", ["wave"]), wave


def _meeting(docs: DataFrame, known: DataFrame, wave: int) -> DataFrame:
    """Part by part its known words (kind 0) in order of their hashes, then its documents."""
    none = F.lit(None)
    sent = known.select(
        "block",
        F.lit(0).alias("kind"),
        F.col("word").alias("number"),
        "n",
        none.cast("binary").alias("words"),
        "vector",
    )
    passing = docs.select(
        "block",
        F.lit(1).alias("kind"),
        "number",
        none.cast("bigint").alias("n"),
        "words",
        none.cast("binary").alias("vector"),
    )
    return apart(sent.union(passing), wave, "kind", "number")


def _tools() -> SimpleNamespace:
    """What tasks work with: functions of their own, which need only NumPy and Arrow there."""
    opened = tools().opened

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
        """(part, kind, rows): runs of rows of one part and kind; arrays are never sliced further."""
        for batch in batches:
            parts, kinds = (batch.column(x).to_numpy() for x in ("block", "kind"))
            edges = np.flatnonzero((parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a < b:
                    yield int(parts[a]), int(kinds[a]), batch.slice(a, b - a)

    def find(hashes: np.ndarray, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the known words of the lists are in `hashes`, their lists, and all lengths."""
        flat, ends = opened(lists, np.int64)
        lengths = np.diff(ends)
        owner = np.repeat(np.arange(lengths.size), lengths)
        if not hashes.size:
            return np.empty(0, np.int64), np.empty(0, np.int64), lengths
        at = np.minimum(np.searchsorted(hashes, flat), hashes.size - 1)
        known = hashes[at] == flat
        return at[known], owner[known], lengths

    return SimpleNamespace(opened=opened, closed=tools().closed, ranges=ranges, find=find)


def _trainer(
    seed: int, dims: int, number: int, iterations: int, mean: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work of a task; it needs nothing but NumPy and Arrow on a worker."""
    own = _tools()
    opened, closed, ranges, find = own.opened, own.closed, own.ranges, own.find
    window, negatives, together, drawn = WINDOW, NEGATIVES, TOGETHER, DRAWN
    power, step, last_step, longest = DRAW_POWER, STEP, LAST_STEP, LONGEST_STEP
    schema = to_arrow_schema(T.StructType.fromDDL(_TRAINED), prefers_large_types=False)

    def started(hashes: np.ndarray) -> np.ndarray:
        """Small vectors drawn for the words' hashes, the same in every part."""
        with np.errstate(over="ignore"):
            x = hashes.astype(np.uint64)[:, None] + np.arange(1, dims + 1, dtype=np.uint64) * (
                np.uint64(0x9E3779B97F4A7C15)
            )
            x = x + np.uint64(seed & (2**63 - 1)) * np.uint64(0xD1342543DE82EF95)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
        return ((x / 2.0**64 - 0.5) / dims).astype(np.float32)

    class Part:
        def __init__(self, part: int, held: list[tuple]):
            self.part = part
            numbers, n, vectors = zip(*held) if held else ([], [], [])
            self.hashes = np.concatenate([*numbers, np.empty(0, np.int64)])
            self.n = np.concatenate([*n, np.empty(0, np.int64)])
            if number == 0:
                self.vectors = started(self.hashes)
                self.out = np.zeros_like(self.vectors)
            else:
                both = np.concatenate([*vectors, np.empty(0, np.float32)]).reshape(-1, 2 * dims)
                self.vectors, self.out = both[:, :dims].copy(), both[:, dims:].copy()
            self.weights = np.zeros(self.hashes.size)
            frequency = self.n.astype(np.float64) ** power
            self.bounds = np.cumsum(frequency) / max(frequency.sum(), 1e-300)
            self.draw = np.random.default_rng([seed & (2**63 - 1), number, part])
            self.passed = 0

        def train(self, lists: pa.Array) -> None:
            ids, owner, lengths = find(self.hashes, lists)
            total = int(lengths.sum())
            reach = self.draw.integers(1, window + 1, ids.size)
            for a in range(0, ids.size, together):
                b = min(a + together, ids.size)
                gone = (number + min(1.0, (self.passed + total * a / ids.size) / mean)) / iterations
                low, high = max(0, a - window), min(ids.size, b + window)
                own = np.zeros(high - low, bool)
                own[a - low : b - low] = True
                rate = step * max(1.0 - gone, last_step)
                self.move(ids[low:high], owner[low:high], reach[low:high], own, rate)
            self.passed += total

        def move(self, ids, owner, reach, own, rate) -> None:
            """Move the vectors of some words in a row; `own` are those in the middle."""
            x, y = self.vectors[ids], self.out[ids]
            noise = np.searchsorted(self.bounds, self.draw.random(drawn), side="right")
            noise = np.minimum(noise, self.hashes.size - 1)
            drawn_out = self.out[noise]
            pull, push = np.zeros_like(x), np.zeros_like(y)
            met, seen = np.zeros(ids.size, np.float32), np.zeros(ids.size, np.float32)
            for d in range(1, min(window, ids.size - 1) + 1):
                same = owner[:-d] == owner[d:]
                one, two = slice(None, -d), slice(d, None)
                for i, j in ((one, two), (two, one)):
                    pairs = (same & own[i] & (reach[i] >= d)).astype(np.float32)
                    odds = np.einsum("ij,ij->i", x[i], y[j])
                    missing = (pairs / (1.0 + np.exp(np.clip(odds, -30, 30))))[:, None]
                    pull[i] += missing * y[j]
                    push[j] += missing * x[i]
                    met[i] += pairs
                    seen[j] += pairs
            against = 1.0 / (1.0 + np.exp(-np.clip(x @ drawn_out.T, -30, 30)))
            against *= (met * (negatives / drawn))[:, None]
            pull -= against @ drawn_out
            self.add(self.vectors, ids, pull, met * (1.0 + negatives), rate)
            used = np.full(drawn, met.sum() * (negatives / drawn), np.float32)
            both = np.concatenate((ids, noise)), np.concatenate((seen, used))
            change = np.concatenate((push, -(against.T @ x)))
            self.add(self.out, both[0], change, both[1], rate)
            np.add.at(self.weights, ids, met)
            np.add.at(self.weights, ids, seen)

        def add(self, to, ids, change, pairs, rate) -> None:
            """Add up the changes of a word's places, as a step no longer than the longest."""
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            pairs = np.add.reduceat(pairs[order], starts)
            scale = np.minimum(rate * pairs, longest) / np.maximum(pairs, 1.0)
            to[ids[starts]] += np.add.reduceat(change[order], starts) * scale[:, None]

        def rows(self) -> Iterator[pa.RecordBatch]:
            for a in range(0, self.hashes.size, 4096):
                some = slice(a, a + 4096)
                n = len(self.hashes[some])
                both = np.concatenate((self.vectors[some], self.out[some]), axis=1)
                columns = [
                    pa.array(np.full(n, self.part, np.int32)),
                    pa.array(self.hashes[some]),
                    pa.array(self.n[some]),
                    closed(both.ravel(), np.arange(0, both.size + 1, 2 * dims)),
                    # A word that met nobody keeps its vector, at next to no weight.
                    pa.array(self.weights[some] + 1e-9),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, now = None, [], None
        for own, kind, rows in ranges(batches):
            if own != part:
                if now is not None:
                    yield from now.rows()
                part, held, now = own, [], None
            if kind == 0:
                columns = [rows.column(x).to_numpy().copy() for x in ("number", "n")]
                held.append((*columns, opened(rows.column("vector"), np.float32)[0].copy()))
                continue
            if now is None:
                now, held = Part(part, held), []
            if now.hashes.size:
                now.train(rows.column("words"))
        if now is not None:
            yield from now.rows()

    return run


def _adder(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of word vectors by the number of tokens, in the order of the tokens."""
    schema = to_arrow_schema(T.StructType.fromDDL(_ADDED), prefers_large_types=False)
    own = _tools()
    opened, closed, ranges, find = own.opened, own.closed, own.ranges, own.find

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, hashes, vectors = None, [], None, None
        for own, kind, rows in ranges(batches):
            if own != part:
                part, held, hashes = own, [], None
            if kind == 0:
                numbers = rows.column("number").to_numpy().copy()
                held.append((numbers, opened(rows.column("vector"), np.float32)[0].copy()))
                continue
            if hashes is None:
                numbers, values = zip(*held) if held else ([], [])
                hashes = np.concatenate([*numbers, np.empty(0, np.int64)])
                vectors = np.concatenate([*values, np.empty(0, np.float32)]).reshape(-1, dims)
                held = []
            for a in range(0, rows.num_rows, 256):
                some = rows.slice(a, 256)
                ids, owner, lengths = find(hashes, some.column("words"))
                made = np.zeros((lengths.size, dims))
                if ids.size:
                    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    sums = np.add.reduceat(vectors[ids].astype(np.float64), starts)
                    made[owner[starts]] = sums / lengths[owner[starts], None]
                listing = closed(made.ravel(), np.arange(0, made.size + 1, dims))
                yield pa.RecordBatch.from_arrays([some.column("number"), listing], schema=schema)

    return run
