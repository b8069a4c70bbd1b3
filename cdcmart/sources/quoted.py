"""CSV records with line breaks inside quotes, read by as many tasks as a file has splits.

Whether a line break ends a record depends on the quotes before it in the
file, which is why Spark reads such files whole. But only their parity counts,
and parities add up: one pass counts the quotes of every split (an aggregate
of one row a split), a running sum over these rows says which splits begin
inside a field, and then every task cuts its own splits at the true record
ends, in the order of the scan and without a shuffle. What a split's last
record lacks lies at the beginning of the next ones; these pieces, at most two
a split, are put together by file and record.

Quotes inside a field are doubled, so they do not change the parity. Line
breaks are LF or CRLF outside quotes; inside they stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import fits_broadcast
from ..session import scratch_path, ship_package

_FILE, _START, _LINE, _INSIDE, _SEQ = "__file", "__start", "__line", "__inside", "__seq"
#: a whole record; of one that runs over splits its last part, a split without a record end, its first part
WHOLE, LAST, MIDDLE, FIRST = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Physical lines with the file and split they begin in, and the partition columns."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_START),
                       F.col("value").alias(_LINE), *[c for c in text.columns if c != "value"])


def split_states(lines: DataFrame) -> DataFrame:
    """The splits that begin or end inside a quoted field: __file, __start, begins, ends."""
    quotes = F.length(_LINE) - F.length(F.replace(F.col(_LINE), F.lit('"')))
    per_split = lines.groupBy(_FILE, _START).agg((F.sum(quotes) % 2).alias("odd"))
    upto = F.sum("odd").over(Window.partitionBy(_FILE).orderBy(_START)) % 2
    return (per_split.select(_FILE, _START, ((upto + F.col("odd")) % 2 == 1).alias("begins"), (upto == 1).alias("ends"))
            .where("begins OR ends"))


class _Split:
    """The lines of one split since its last record end."""

    def __init__(self, name: str, start: int, inside: bool):
        self.name, self.start, self.inside = name, start, inside
        self.begun = not inside  # what is held began in this split
        self.held: pa.Table | None = None
        self.records = 0

    def add(self, lines: pa.Table) -> Iterator[pa.Table]:
        """The records that end within these lines."""
        quotes = pc.count_substring(lines.column(_LINE), '"').to_numpy()
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        self.inside = bool(inside[-1])
        ends = np.flatnonzero(~inside) + 1
        if self.held is not None:
            ends += self.held.num_rows
            lines = pa.concat_tables([self.held, lines])
        if len(ends):
            yield self._records(lines.slice(0, int(ends[-1])), ends, WHOLE if self.begun else LAST)
            self.begun = True
            lines = lines.slice(int(ends[-1]))
        self.held = lines

    def rest(self) -> Iterator[pa.Table]:
        """What the split leaves unfinished."""
        if self.held is not None and self.held.num_rows:
            yield self._records(self.held, np.array([self.held.num_rows]), FIRST if self.begun else MIDDLE)

    def _records(self, lines: pa.Table, ends: np.ndarray, first_kind: int) -> pa.Table:
        offsets = np.concatenate([[0], ends])
        flat = lines.column(_LINE).combine_chunks()
        record = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), "\n")
        head = np.zeros(len(ends), bool)
        head[0] = self.start == 0 and self.records == 0
        self.records += len(ends)
        kinds = pa.array([first_kind] + [WHOLE] * (len(ends) - 1), pa.int32())
        return (lines.take(pa.array(offsets[:-1], pa.int64())).drop_columns([_LINE, _INSIDE])
                .append_column("record", record).append_column("kind", kinds).append_column("first", pa.array(head)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of a task's splits, whose lines come in order."""
    split = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        names, starts = batch.column(_FILE), batch.column(_START)
        new = pc.or_(pc.not_equal(names[1:], names[:-1]), pc.not_equal(starts[1:], starts[:-1])).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            here = names[lo].as_py(), starts[lo].as_py()
            if split is None or here != (split.name, split.start):
                for out in split.rest() if split is not None else ():
                    yield from out.combine_chunks().to_batches()
                split = _Split(*here, batch.column(_INSIDE)[lo].as_py())
            for out in split.add(table.slice(lo, hi - lo)):
                yield from out.combine_chunks().to_batches()
    for out in split.rest() if split is not None else ():
        yield from out.combine_chunks().to_batches()


def read_records(spark: SparkSession, path: str | Sequence[str],
                 keep: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """One row per CSV record: ``record`` (its text, without its line end),
    ``first`` (the first of its file: the header, if it has one) and the
    partition columns. Empty lines between records are left out, as Spark's
    reader does; a quote never closed makes the rest of its file one record.
    ``keep`` is a condition on partition columns: other folders are not read."""
    ship_package(spark)
    lines = _lines(spark, path)
    if keep is not None:
        lines = lines.where(keep(lines))
    kept = scratch_path(spark, "split-states")
    split_states(lines).write.parquet(kept)
    states = spark.read.parquet(kept)
    parts = [f for f in lines.schema.fields if f.name not in (_FILE, _START, _LINE)]
    names = [f.name for f in parts]
    fields = T.StructType([lines.schema[_FILE], lines.schema[_START], *parts, T.StructField("record", T.StringType()),
                           T.StructField("kind", T.IntegerType()), T.StructField("first", T.BooleanType())])

    def placed(rows: DataFrame, begins: DataFrame) -> DataFrame:
        columns = [_FILE, _START, _LINE, *names, F.coalesce(_INSIDE, F.lit(False)).alias(_INSIDE)]
        if fits_broadcast(begins):
            return rows.join(F.broadcast(begins), [_FILE, _START], "left").select(*columns)
        # more than fit a broadcast: in order again after a shuffle by split
        return (rows.withColumn(_SEQ, F.monotonically_increasing_id()).join(begins, [_FILE, _START], "left")
                .repartition(_FILE, _START).sortWithinPartitions(_FILE, _START, _SEQ).select(*columns))

    if states.isEmpty():  # no field runs over a split's end
        whole = lines.withColumn(_INSIDE, F.lit(False)).mapInArrow(_cut, fields)
        return _trimmed(whole, names)
    begins = states.where("begins").select(_FILE, _START, F.lit(True).alias(_INSIDE))
    whole = placed(lines, begins).mapInArrow(_cut, fields).where(F.col("kind") == WHOLE)
    concerned = lines.join(states.select(_FILE, _START), [_FILE, _START], "left_semi").select(*lines.columns)
    pieces = placed(concerned, begins).mapInArrow(_cut, fields).where(F.col("kind") != WHOLE)
    number = F.sum((F.col("kind") == FIRST).cast("int")).over(Window.partitionBy(_FILE).orderBy(_START, "kind"))
    joined = (pieces.withColumn("number", number).groupBy(_FILE, "number")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(_START, "kind", "record"))),
                                            lambda p: p["record"]), "\n").alias("record"),
                   F.max("first").alias("first"), *[F.first(n).alias(n) for n in names]))
    return _trimmed(whole.select("record", "first", *names).unionByName(joined.select("record", "first", *names)), names)


def _trimmed(records: DataFrame, names: list[str]) -> DataFrame:
    """Without the CR of a CRLF line end, and without empty lines."""
    text = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.select(text.alias("record"), "first", *names).where("record != ''")
