"""Catalog tables and database sources.

* ``read_table``  : ``SELECT *`` from a catalog table, optionally under an
  interval (the filter reaches the scan).
* ``read_jdbc``   : a database table read in parallel, one partition per day
  of the interval (each day is a pushed-down predicate).
* ``ensure_table``: ``CREATE [DATABASE|TABLE] IF NOT EXISTS`` (or drop and
  recreate), with column defaults.
* ``append``, ``clear``, ``full_refresh``: load, empty and reload tables.
* ``apply_defaults``: fill columns a load omits with their default
  expression (a default applies only to omitted columns, not to NULLs).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.interval import Interval, today_midnight
from .delimited import read_delimited


_OUTSIDE = "rows of days outside"


def read_table(spark: SparkSession, name: str, interval: Interval | None = None,
               column: str = "date") -> DataFrame:
    """``SELECT * FROM name [WHERE start <= column < end]``, as SQL with bound
    parameters (the table and column through ``IDENTIFIER``, the bounds as
    values): nothing is pasted into the text, and the filter still reaches
    the scan."""
    if interval is None:
        return spark.sql("SELECT * FROM IDENTIFIER(:table)", args={"table": name})
    dtype = spark.table(name).schema[column].dataType
    kind = "DATE" if isinstance(dtype, T.DateType) else (
        "TIMESTAMP" if isinstance(dtype, T.TimestampType) else "TIMESTAMP_NTZ")
    return spark.sql(
        f"SELECT * FROM IDENTIFIER(:table) WHERE IDENTIFIER(:col) >= CAST(:lo AS {kind}) "
        f"AND IDENTIFIER(:col) < CAST(:hi AS {kind})",
        args={"table": name, "col": column, "lo": interval.start.isoformat(), "hi": interval.end.isoformat()})


def read_jdbc(spark: SparkSession, url: str, table: str, interval: Interval | None = None,
              column: str = "date", properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read ``table`` over JDBC in parallel: with an interval, one partition
    per day (each a pushed-down predicate); otherwise, when a numeric
    ``partition_column`` and its bounds are given, ``num_partitions`` ranges."""
    props = dict(properties or {})
    if interval is not None:
        predicates = [f"{column} >= '{d.start.isoformat()}' AND {column} < '{d.end.isoformat()}'"
                      for d in interval.days()]
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def _ddl(schema: T.StructType, defaults: Mapping[str, str] | None) -> str:
    defaults = defaults or {}
    parts = []
    for f in schema.fields:
        col = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in defaults:
            col += f" DEFAULT {defaults[f.name]}"
        parts.append(col)
    return ", ".join(parts)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, replace: bool = False,
                 defaults: Mapping[str, str] | None = None,
                 partition_by: Sequence[str] = (), fmt: str = "parquet",
                 namespace_location: str | None = None) -> None:
    """Create the namespace and the table if absent (``replace`` drops first);
    a new namespace may keep its tables under ``namespace_location``."""
    if "." in name:
        place = f" LOCATION '{namespace_location}'" if namespace_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`{place}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, defaults)}) USING {fmt}{parts}")


def apply_defaults(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Column | str]) -> DataFrame:
    """Columns of ``schema`` missing from ``df`` get their default (else NULL),
    in schema order."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            d = defaults[f.name]
            expr = F.expr(d) if isinstance(d, str) else d
            out.append(expr.cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def retail_defaults() -> dict[str, Column]:
    return {"invoicedate": today_midnight(), "last_updated": today_midnight()}


def append(df: DataFrame, name: str) -> None:
    """Append rows to a table (columns matched by name; no dedupe)."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.insertInto(name, overwrite=False)


def clear(spark: SparkSession, name: str) -> None:
    """Delete all rows of a (landing) table."""
    spark.sql(f"TRUNCATE TABLE {name}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that are written: ``insertInto`` takes this
    from the session, not from the writer's options, so it is put back after."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_days(df: DataFrame, name: str, interval: Interval, column: str = "date", rebalance: bool = True) -> None:
    """Make ``df`` the interval's rows of a table partitioned by the day
    ``column``; ``df`` must hold no other days.

    Only the interval's partitions are written (dynamic partition overwrite),
    and a row of another day ends the write before anything is changed;
    days that have no rows any more are dropped afterwards, by the names in the
    catalog. Other days are neither read nor written, and a reader finds every
    day's old or new rows but while that day's folder is swapped. Apart from
    days that the table holds already, ``df`` is computed once. ``rebalance``
    shuffles the rows by day; a ``df`` that comes day after day, as from day
    files, is written without (each task sorts its own few days)."""
    spark = df.sparkSession
    parts = [f.name for f in spark.catalog.listColumns(name) if f.isPartition]
    if parts != [column]:
        raise ValueError(f"table {name} is partitioned by {parts}, not by {column}")
    held = {dt.date.fromisoformat(v) for v in (r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
            if v != "__HIVE_DEFAULT_PARTITION__"}
    held = {d for d in held if interval.start <= d < interval.end}
    day = F.col(column)
    written = {r[0] for r in df.where(day.isin(sorted(held))).select(column).distinct().collect()} if held else set()
    inside = (day >= F.lit(interval.start)) & (day < F.lit(interval.end))
    refused = F.raise_error(F.concat(F.lit(f"{_OUTSIDE} {interval.start} to {interval.end}: "),
                                     F.coalesce(day.cast("string"), F.lit("none"))))
    checked = df.withColumn(column, F.when(inside, day).otherwise(refused.cast(df.schema[column].dataType)))
    checked = checked.select(*spark.table(name).columns)
    try:
        with _dynamic_overwrite(spark):
            (checked.hint("rebalance", column) if rebalance else checked).write.insertInto(name, overwrite=True)
    except Exception as e:
        found = re.search(rf"{_OUTSIDE} [^\n\"']*", str(e))
        if found is None:
            raise
        raise ValueError(found[0]) from e
    stale = sorted(held - written)
    if stale:
        spec = ", ".join(f"PARTITION (`{column}` = DATE '{d}')" for d in stale)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")


def full_refresh(spark: SparkSession, path: str, name: str, schema: T.StructType,
                 header: bool = True, columns: Sequence[str] | None = None,
                 defaults: Mapping[str, str] | None = None) -> None:
    """Drop, recreate and load ``name`` from delimited files at ``path``."""
    ensure_table(spark, name, schema, replace=True, defaults=defaults)
    df = read_delimited(spark, path, schema, header=header, columns=columns,
                        defaults={k: F.expr(v) for k, v in (defaults or {}).items()})
    df.write.insertInto(name, overwrite=True)
