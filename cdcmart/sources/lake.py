"""Date-partitioned files in a lake folder: ``root/dataset/year=YYYY/month=MM/ds=YYYY-MM-DD/``.

The year/month folders follow the lake layout; the day folder is the unit a
daily run replaces. Writes never go through the driver or a machine-local
folder: Spark writes the partitions directly, and reads prune partitions by
the ``ds`` filter.

``write_partitioned`` asks AQE to *rebalance* on the partition columns before
writing: small days are coalesced into one file each, and a day that holds a
large share of the rows is split into several tasks instead of one.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.interval import Interval, in_interval, interval_predicate
from .delimited import csv_writer, read_delimited

PARTITION_COLUMNS = ("year", "month", "ds")
_DAY = "__cdcmart_day"


def interval_path(interval: Interval) -> str:
    """``yyyy/MM`` of the interval start (the lake's month folder)."""
    return interval.start.strftime("%Y/%m")


def partition_path(root: str, dataset: str, day) -> str:
    return (f"{root.rstrip('/')}/{dataset}/year={day.strftime('%Y')}/month={day.strftime('%m')}"
            f"/ds={day.isoformat()}")


def _with_partitions(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.select("*", F.date_format(c, "yyyy").alias("year"), F.date_format(c, "MM").alias("month"),
                     F.date_format(c, "yyyy-MM-dd").alias("ds"))


def _writer(df: DataFrame, fmt: str, header: bool):
    if fmt == "csv":
        return csv_writer(df, header=header)
    return df.write.format(fmt)


def write_partitioned(df: DataFrame, root: str, dataset: str, column: str = "date",
                      fmt: str = "csv", header: bool = True, rebalance: bool = True) -> None:
    """Write ``df`` under ``root/dataset`` partitioned by the day of ``column``;
    partitions present in ``df`` are replaced, all others are left as they are.

    ``rebalance`` shuffles rows by day first (AQE: few files per day, hot days
    split). Input already clustered by date (e.g. read from date-ordered files)
    can skip that shuffle with ``rebalance=False``: rows are then only sorted
    by day inside each task, which writes its few days one after another."""
    if rebalance:  # by the date itself: the folders' texts are made after the shuffle
        dated = df.withColumn(_DAY, F.to_date(F.col(column))).hint("rebalance", _DAY)
        out = _with_partitions(dated, _DAY).drop(_DAY)
    else:
        out = _with_partitions(df, column).sortWithinPartitions(*PARTITION_COLUMNS)
    (_writer(out, fmt, header).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .save(f"{root.rstrip('/')}/{dataset}"))


def write_interval(df: DataFrame, root: str, dataset: str, interval: Interval,
                   column: str = "date", fmt: str = "csv", header: bool = True) -> None:
    """Write the rows of ``df`` inside ``interval`` and replace those days.

    Every day of the interval is replaced, also one that now has no rows: after
    the write, day folders that hold rows of days without any are overwritten
    empty. They are told by their files' names, as a folder that was written
    holds none of its old files, so ``df`` is computed once.
    """
    sliced = in_interval(df, interval, column)
    if interval.end.toordinal() - interval.start.toordinal() == 1:
        # AQE rebalance: a wide scan's few rows per task become files of the
        # advisory size instead of one small file per task; a large day is split.
        (_writer(sliced.hint("rebalance"), fmt, header).mode("overwrite")
            .save(partition_path(root, dataset, interval.start)))
    else:
        before = _day_files(df, root, dataset, interval, fmt)
        write_partitioned(sliced, root, dataset, column, fmt, header)
        after = _day_files(df, root, dataset, interval, fmt) if before else {}
        left = [day for day, files in before.items() if files & after.get(day, set())]
        for day in _days_held(df, root, dataset, left, fmt):
            (_writer(sliced.limit(0), fmt, header).mode("overwrite")
                .save(partition_path(root, dataset, day)))


def _held(df: DataFrame, root: str, dataset: str, fmt: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).format(fmt).load(f"{root.rstrip('/')}/{dataset}")


def _day_files(df: DataFrame, root: str, dataset: str, interval: Interval, fmt: str) -> dict[dt.date, set[str]]:
    """The names of the files in the interval's day folders; no file is read."""
    try:
        names = _held(df, root, dataset, fmt).inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[dt.date, set[str]] = {}
    for name in names:
        day = re.search(r"/ds=(\d{4}-\d\d-\d\d)/", name)
        if day and interval.start <= (d := dt.date.fromisoformat(day[1])) < interval.end:
            out.setdefault(d, set()).add(name)
    return out


def _days_held(df: DataFrame, root: str, dataset: str, days: list[dt.date], fmt: str) -> list[dt.date]:
    """Those of the days whose folders hold rows; only their files are read."""
    if not days:
        return []
    day = F.col("ds").cast("date")
    return [r["d"] for r in _held(df, root, dataset, fmt).where(day.isin(sorted(days))).select(day.alias("d")).distinct().collect()]


def read_partitioned(spark: SparkSession, root: str, dataset: str, schema: T.StructType,
                     fmt: str = "csv", header: bool = True, interval: Interval | None = None,
                     multiline: bool | str = True) -> DataFrame:
    """Read a partitioned dataset back into ``schema`` (partition folders
    pruned by ``interval`` on ``ds``); ``multiline`` as of ``read_delimited``."""
    base = f"{root.rstrip('/')}/{dataset}"
    keep = None if interval is None else lambda df: interval_predicate(df, "ds", interval)
    if fmt == "csv":
        df = read_delimited(spark, base, schema, header=header, multiline=multiline, keep_partition_columns=True, keep=keep)
    else:
        df = spark.read.schema(schema).format(fmt).load(base)
        df = df if keep is None else df.where(keep(df))
    return df.select(*schema.fieldNames())


def read_interval(spark: SparkSession, root: str, dataset: str, schema: T.StructType,
                  interval: Interval, fmt: str = "csv", header: bool = True, multiline: bool | str = True) -> DataFrame:
    """One interval of a lake dataset (no download: the folder is read in place)."""
    return read_partitioned(spark, root, dataset, schema, fmt, header, interval, multiline)
