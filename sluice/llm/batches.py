"""How much text a Python worker holds at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import SparkSession

# Two Python workers share an executor with the JVM, so a batch is kept small.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by bytes; a longer row still ends the batch of the rows before it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def return_memory() -> None:
    """Gives freed memory back to the system: workers are used again, and what one step freed would stay theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def portions(texts: Sequence, size: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` characters each."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
