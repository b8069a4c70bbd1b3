"""Measured size of a DataFrame, used to decide whether a side may be broadcast.

Broadcasting is only safe when the side's size is known to be bounded. The
bound here is measured, not estimated: one pass over the frame (several frames
at once) collects the row count and the payload bytes (string octets + fixed
widths + a per-row overhead) as observed metrics into a no-op sink, so the
measurement is one job without a shuffle and only two numbers reach the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SIDE_BYTES = 16 << 20  # a hash table of this size fits any task beside its rows
ROW_OVERHEAD_BYTES = 48  # hash-table entry + UnsafeRow header, per row

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (``-1`` disables broadcast)."""
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def _width(field: T.StructField):
    c = F.col(f"`{field.name}`")
    dtype = field.dataType
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    for kind, size in _FIXED.items():
        if isinstance(dtype, kind):
            return F.lit(size)
    # nested / other: its text form is an upper-ish bound
    return F.coalesce(F.octet_length(c.cast("string")), F.lit(0))


def row_bytes(df: DataFrame):
    row_bytes = F.lit(ROW_OVERHEAD_BYTES)
    for field in df.schema.fields:
        row_bytes = row_bytes + _width(field)
    return row_bytes.cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one pass."""
    return measure_many([df])[0]


def measure_many(frames: list[DataFrame]) -> list[tuple[int, int]]:
    """(rows, bytes) of several frames in a single job without a shuffle: the
    counts are observed metrics of one pass over all frames into a no-op sink."""
    from pyspark.sql import Observation
    tagged = None
    for i, df in enumerate(frames):
        one = df.select(F.lit(i).alias("tag"), row_bytes(df).alias("b"))
        tagged = one if tagged is None else tagged.unionByName(one)
    metrics = []
    for i in range(len(frames)):
        hit = F.col("tag") == i
        metrics += [F.count(F.when(hit, 1)).alias(f"r{i}"),
                    F.coalesce(F.sum(F.when(hit, F.col("b"))), F.lit(0)).alias(f"b{i}")]
    obs = Observation("cdcmart_size")
    tagged.observe(obs, *metrics).write.format("noop").mode("overwrite").save()
    got = obs.get
    return [(int(got[f"r{i}"]), int(got[f"b{i}"])) for i in range(len(frames))]


def build_side(df: DataFrame, limit_bytes: int | None = None, size: int | None = None) -> DataFrame:
    """``df`` (one row a key) as the side of a join that is looked up in, with
    the hint that its measured ``size`` in bytes allows: broadcast within the
    limit; a hash table per shuffle partition where these are small (the other
    side is then neither sorted nor held); else none, so that both sides are
    sorted and may spill."""
    spark = df.sparkSession
    limit = broadcast_limit(spark) if limit_bytes is None else limit_bytes
    size = measure(df)[1] if size is None else size
    if 0 <= limit and size <= limit:
        return F.broadcast(df)
    return df.hint("shuffle_hash") if size <= HASH_SIDE_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """True when the measured size of ``df`` is within ``limit_bytes``
    (default: the session's broadcast threshold)."""
    spark = df.sparkSession
    limit = broadcast_limit(spark) if limit_bytes is None else limit_bytes
    if limit is None or limit < 0:
        return False
    _, size = measure(df)
    return size <= limit
