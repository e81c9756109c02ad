"""Shared pieces of the operators: Arrow row mapping, stored tables, words.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D.
``bytes.split()`` cuts UTF-8 at exactly those six characters.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

BLANKS = " \t\n\v\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Broadcasts chosen by a counted size stay below this many rows; beyond it the
#: same step is a shuffled join.
BROADCAST_ROWS = 200_000

#: Whether Spark drops the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet (with the writer's ``options``) under the shared checkpoint folder and
    read it back: a durable cut of the lineage that outlives lost executors. Nothing reads the shuffle files
    of the write again, so Spark drops them when it ends; else they stay while later steps write theirs."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_turn(parts: list[DataFrame], label: str) -> DataFrame:
    """The union of ``parts`` (of one schema), each ``stored`` before the next one begins: a step that shuffles much
    more than it keeps, cut by its key, holds the shuffle files of one part at a time."""
    done = [stored(df, label) for df in parts]
    return reduce(DataFrame.union, done)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast when its counted size allows it, else as it is."""
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it."""
    out = []
    for n in names:
        while n in df.columns:
            n = f"_{n}"
        out.append(n)
    return out


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names (so that any other
    column of the input can have any name)."""
    return df.select(*[df[c].alias(to) for to, c in columns.items()])


#: Text that a task holds as Python objects at a time: batches of rows are cut at so many bytes.
SLICE_BYTES = 2_000_000


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``limit`` bytes of text and binary values each (a row is never cut)."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if any(kind(column.type) for kind in (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary)):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from stage to stage, and what their C
    library keeps of one stage would add to the next one's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


#: Bytes after which Spark closes a batch on its way to Python, unless the session has a limit of its own.
BATCH_BYTES = 4_000_000
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of about ``BATCH_BYTES``. Spark's own limits (10,000 rows, 64 MB) let
    each task hold tens of MB of text three times: in a buffer outside the heap that doubles as it grows, and in Python."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of all batches; what a batch (or an earlier task) took is given back before the next one comes."""
    give_back()
    for batch in batches:
        yield from slices(batch)
        del batch
        give_back()


def arrow_rows(df: DataFrame, keep: list[str], inputs: list[str], out: str,
               make: Callable[[], Callable[..., list]]) -> DataFrame:
    """Map rows in Arrow batches (cut by ``slices``): ``make()`` runs once per task and returns a function
    from the input columns (Arrow arrays) to the output arrays of schema ``out``.
    Only ``keep`` and ``inputs`` go to Python; the result has ``keep`` and ``out``."""
    added = T.StructType.fromDDL(out)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    wanted = list(dict.fromkeys([*keep, *inputs]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for b in pieces(batches):
            f = f or make()
            made = f(*[b.column(wanted.index(c)) for c in inputs])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(wanted.index(c)) for c in keep], *made], names=schema.names)

    return mapped(df.select(*wanted), run, schema)


def utf8(column: pa.Array) -> list:
    """The values of a string column as UTF-8 bytes (None stays None)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
