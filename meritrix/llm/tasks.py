"""Python work inside Spark tasks: Arrow batches in, Arrow batches out."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_STATE: dict[str, object] = {}
#: Rows of an Arrow batch that are worked on at once.
ROWS = 500
#: Bytes of an Arrow batch, and the setting for it. Spark's default is large for texts:
#: a task holds batches on both sides of the pipe, and buffers of twice their size.
BATCH_BYTES, DEFAULT_BYTES = 8 << 20, 64 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def share_code(spark: SparkSession) -> None:
    """Let Python workers of a source checkout import this package. A cluster
    that has it installed does not need the path; a missing path is harmless.
    Arrow batches become smaller where the session has the default size."""
    if spark.conf.get(BATCH_SETTING) in (f"{DEFAULT_BYTES}b", str(DEFAULT_BYTES)):
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def give_back() -> None:
    """Return freed memory to the system. Workers are used again and again, and what a
    task held at its peak would otherwise stay with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def task(run: Callable) -> Callable:
    """A task over Arrow batches that gives its memory back when it ends."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, at most ROWS at a time, without copying."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def map_batches(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` turns one Arrow batch into one batch of ``schema``. Spark bounds
    a batch by rows and by bytes; it is worked on in pieces, so that what a row
    takes in Python is held for ROWS rows at a time."""
    share_code(frame.sparkSession)

    def run(batches):
        for piece in pieces(batches):
            yield work(piece)

    return frame.mapInArrow(task(run), schema)


def worker_state(key: str, build: Callable[[], object]) -> object:
    """State that a Python worker keeps between batches and tasks. Workers serve
    one operator after the other, so only the latest one's state is kept; it is
    rebuilt at need, and a lost worker costs time only."""
    if key not in _STATE:
        forget_state()
        _STATE[key] = build()
    return _STATE[key]


def forget_state() -> None:
    """Called by tasks without such state, so that a worker does not hold that of
    the operator it served before."""
    if _STATE:
        _STATE.clear()
        gc.collect()
        give_back()


def carried(docs: DataFrame, text: str, keep: tuple[str, ...], name: str) -> tuple[str, list[Column]]:
    """The column that a task reads texts from, and what to select for it: a kept text
    column goes to Python once."""
    if text in keep and docs.schema[text].dataType.simpleString() == "string":
        return text, []
    return name, [F.col(text).cast("string").alias(name)]


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; null gives the empty text."""
    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]


def fold(id_col: str, n: int) -> Column:
    """The fold of a row: crc32 of the id's decimal text modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))
