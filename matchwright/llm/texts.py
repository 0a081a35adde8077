"""Small helpers on whole texts, shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

#: A-Z to a-z on UTF-8 bytes; other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: White space of the word rule [^\x20\x09-\x0D]+, as bytes.split() takes it.
SPACE = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_runs(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in runs of about `size` bytes, so that a very long text stays bounded."""
    start, n = 0, len(data)
    while start < n:
        end = min(n, start + size)
        while end < n and data[end] not in SPACE:
            end += 1
        words = data[start:end].split()
        if words:
            yield words
        start = end


def tidy() -> None:
    """Give freed memory back, as Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into parts whose texts hold about `size` bytes; a longer text is a part of its own."""
    if batch.num_rows == 0:
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)
