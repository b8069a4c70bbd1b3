"""Shared helpers: tables in the shared folder, Arrow text buffers, hashing kernels.

The numpy kernels work on one Arrow batch at a time, in chunks of about a
megabyte of text, so a task's memory follows the batch, never the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

CHUNK_BYTES = 1 << 20

_RNG = np.random.default_rng(20240229)
#: one random odd 64-bit value per byte value, and the base of the running hash
BYTE_CODE = _RNG.integers(1, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared folder and read it back:
    it is computed once, and what follows survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What is run here leaves no shuffle files, so that the rounds of a long
    job need disk for those of one of them at a time."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def released_table(df: DataFrame, name: str) -> DataFrame:
    """``scratch_table`` whose shuffle files go as soon as the table is written."""
    with released(df.sparkSession):
        return scratch_table(df, name)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as ``doc_id``) and the text (as ``text``, null as empty) of a
    table, so that no other column of it can clash with an operator's own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def total_bytes(texts: DataFrame) -> int:
    """UTF-8 bytes of all texts: one pass, one number."""
    return int(texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into parts of at most so many rows, for kernels that
    hold several numbers per byte."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def row_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer row is a chunk of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: powers kept in a worker between calls; those of a longer text go with it
_KEPT_POWERS = 1 << 21
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, key: str = "up") -> np.ndarray:
    """BASE ** i (or its inverse) modulo 2 ** 64 for i < n (at least; short ones kept between calls)."""
    if len(_POWERS[key]) >= n:
        return _POWERS[key]
    size = min(1 << int(n - 1).bit_length(), max(n, _KEPT_POWERS))
    step = np.full(size, BASE if key == "up" else BASE_INVERSE, np.uint64)
    step[0] = 1
    np.cumprod(step, dtype=np.uint64, out=step)
    if size <= _KEPT_POWERS:
        _POWERS[key] = step
    return step


def running_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_CODE[data] * powers(len(data) + 1)[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in [start, end), the same wherever they stand."""
    inverse = powers(len(prefix), "down")
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of all spans, one after another."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - before, lengths) + np.arange(total)


def spread(spark: SparkSession, total: int, per_part: int, least: int = 1) -> int:
    """How many parts hold ``total`` bytes at ``per_part`` bytes each."""
    return max(least, -(-total // per_part))
