"""Running a Python function over the Arrow batches of a table."""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Iterator, Sequence
from itertools import filterfalse
from pathlib import Path
from tempfile import mkdtemp
from typing import Any
from zipfile import ZipFile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import lexloom

# Chunks longer than this are worked out each time; shorter ones are remembered.
REMEMBERED_LENGTH = 64
# Chunks of a generation; a worker remembers the last two. Bounds memory only.
REMEMBERED = 150_000
# Rows handed to a function at once, if it does not ask for more, and bytes of their texts. A
# longer text comes alone.
ROWS_AT_ONCE = 1024
BYTES_AT_ONCE = 8_000_000


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Texts are large rows: of Spark's 10,000 in a batch, a few batches fill a small executor.
BATCH_ROWS, USUAL_BATCH_ROWS = "4096", "10000"
BATCH_BYTES = str(16 << 20)

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers, as --py-files does.

    Also have the session send them smaller batches, unless it names a size of its own.
    """
    if spark.conf.get(ARROW_ROWS) == USUAL_BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(lexloom.__file__).parent
        archive = Path(mkdtemp(prefix="lexloom-code-")) / "lexloom.zip"  # the driver serves it
        with ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def quoted(name: str) -> str:
    """A column name that may hold dots or blanks, for use in `F.col`."""
    return f"`{name.replace('`', '``')}`"


def unused(taken: Sequence[str], *names: str) -> list[str]:
    """The names, lengthened until no column of `taken` has them in any case."""
    lower = {column.lower() for column in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name += "_"
        out.append(name)
    return out


def without_results(df: DataFrame, results: Sequence[str], inputs: Sequence[str]) -> DataFrame:
    """`df` without the columns that have, in any case, names of results.

    An input cannot give way, so one with such a name is an error.
    """
    lower = {name.lower() for name in results}
    if clash := [name for name in inputs if name.lower() in lower]:
        raise ValueError(f"inputs have names of results: {sorted(clash)}")
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in lower])


_held: tuple[Hashable, Any] | None = None


def held(key: Hashable, build: Callable[[], Any]) -> Any:
    """What `build` makes, kept by the worker for its next tasks until another key comes.

    Workers serve task after task, of every operator, so what an earlier stage kept would
    otherwise stay beside what the present one keeps.
    """
    global _held
    if _held is None or _held[0] != key:
        _held = None
        pa.default_memory_pool().release_unused()
        _held = (key, build())
    return _held[1]


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[..., Sequence]],
    inputs: Sequence[str],
    keep: Sequence[str],
    outputs: str,
    rows: int = ROWS_AT_ONCE,
    repeated: bool = False,
    arrow_inputs: bool = False,
) -> DataFrame:
    """`keep` as it is, then the columns `outputs` made from the columns `inputs`.

    `make` runs once per task and returns the function from lists of input values to one
    list (or Arrow array) per output column. No other column of `df` is read, so clashing
    names do not matter, unless a kept column has the name of an output. The function gets
    `rows` rows at once at most, and `BYTES_AT_ONCE` bytes of texts, but one row at least. With
    `repeated` its first list says how many rows of the result each row has, with
    `arrow_inputs` it gets Arrow arrays in place of lists.
    """
    ship(df.sparkSession)
    made = T.StructType.fromDDL(outputs)
    if clash := set(keep) & set(made.names):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    fields = [df.schema[name] for name in keep]
    schema = T.StructType([*fields, *made.fields])
    arrow = to_arrow_schema(schema, prefers_large_types=False)
    n, kinds = len(keep), [arrow.field(name).type for name in made.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in _cut(batches, rows, n):
            columns = batch.columns[n:]
            made = work(*columns if arrow_inputs else [x.to_pylist() for x in columns])
            old = [batch.column(i).cast(arrow.field(i).type) for i in range(n)]
            if repeated:
                at = pa.array(np.repeat(np.arange(batch.num_rows), made[0]))
                old, made = [x.take(at) for x in old], made[1:]
            new = [
                x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, type=kind)
                for x, kind in zip(made, kinds)
            ]
            yield pa.RecordBatch.from_arrays([*old, *new], schema=arrow)

    read = [F.col(quoted(c)) for c in keep]
    read += [F.col(quoted(c)).alias(f"__input{i}") for i, c in enumerate(inputs)]
    return df.select(*read).mapInArrow(run, schema)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory of one that is done with goes back to the system.

    Workers live on between tasks, and what they keep is missing beside the executor's heap.
    """
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def _cut(batches: Iterator[pa.RecordBatch], rows: int, first: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with few enough rows and bytes in the columns from `first` on."""
    for batch in released(batches):
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns[first:]:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fitting = int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right"))
            stop = min(max(fitting, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


class Memory:
    """Values of strings met lately: those of two generations, of `size` or a few more each.

    A generation grows beyond `size` by what one call of `ready` adds, not more.
    """

    def __init__(self, size: int):
        self._size, self._young, self._old = size, {}, {}

    def ready(self, lacking: set, solve: Callable[[list], list]) -> dict:
        """A dictionary with these strings and all others of the young generation.

        Strings that neither generation has are solved in one call.
        """
        young, old = self._young, self._old
        new = list(filterfalse(old.__contains__, lacking))
        if len(new) < len(lacking):
            young.update((x, old[x]) for x in lacking if x in old)
        young.update(zip(new, solve(new)))
        return young

    @property
    def young(self) -> dict:
        return self._young

    def close(self, strings: set) -> None:
        """Call after use, with what `ready` was asked for: long strings are not kept."""
        for x in strings:
            if len(x) > REMEMBERED_LENGTH:
                del self._young[x]
        if len(self._young) > self._size:
            self._young, self._old = {}, self._young


class Chunks:
    """Values of texts put together from the values of their chunks, most of which recur.

    `parts` cuts a text into chunks; `solve` gives the values of a list of different chunks.
    What a batch of texts lacks is solved in one call. Chunks of usual length are remembered
    for later batches, within a bound.
    """

    def __init__(
        self,
        parts: Callable[[str], list[str]],
        solve: Callable[[list[str]], list],
        remembered: int = REMEMBERED,
    ):
        self._parts, self._solve, self._memory = parts, solve, Memory(remembered)

    def __call__(self, texts: Sequence[str | None], combine: Callable) -> list:
        known, parts = self._memory.young.__contains__, self._parts
        lacking: set[str] = set()
        for text in texts:
            if text:
                lacking.update(filterfalse(known, parts(text)))
        look_up = self._memory.ready(lacking, self._solve).__getitem__
        out = [combine(map(look_up, parts(text)) if text else ()) for text in texts]
        self._memory.close(lacking)
        return out


# Any two white space characters in a row; broader than the white space of the patterns.
_ADJACENT_SPACE = re.compile(r"\s\s").search


def blank_chunks(findall: Callable[[str], list[str]]) -> Callable[[str], list[str]]:
    """Cuts a text before each blank, for patterns whose pre-tokens hold a blank in front only.

    Where no two white space characters are adjacent, no pre-token reaches across such a cut,
    and what stands before it does not change the pre-tokens after it. Other texts are cut
    into their pre-tokens. A chunk is named by what follows its blank; one that does not
    start with a cut blank has one put in front of its name.
    """

    def parts(text: str) -> list[str]:
        if _ADJACENT_SPACE(text):
            return [f" {token}" for token in findall(text)]
        cut = text.split(" ")
        cut[0] = f" {cut[0]}"
        return cut

    return parts


def chunk_text(name: str) -> str:
    """The text of a chunk named by `blank_chunks`."""
    return name[1:] if name.startswith(" ") else f" {name}"
