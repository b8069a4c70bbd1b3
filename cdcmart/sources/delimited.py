"""Delimited text with the rules of a database's ``COPY ... CSV``.

* comma separated, ``"`` quotes, quotes doubled inside a quoted field;
* an unquoted empty field is NULL, a quoted empty field ``""`` is the empty
  string (Spark reads both as NULL by default: the quoted form is read as a
  marker via ``emptyValue`` and mapped back to ``''``);
* columns bind by position to an explicit schema; a header line is skipped,
  not matched; never ``inferSchema``;
* ``columns=`` names the columns the file holds (in file order); schema
  columns absent from the file become NULL (or a default expression);
* ``multiline`` (fields with embedded newlines): ``True`` (default) reads
  each file whole in one task, ``False`` has one record per line, and
  ``"split"`` reads every split of a file in its own task and finds the true
  record ends by the quotes before them (``quoted.py``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted import read_records

EMPTY_MARK = "\u0001"
WRITE_TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _file_schema(schema: T.StructType, columns: Sequence[str] | None) -> T.StructType:
    if columns is None:
        return schema
    by_name = {f.name: f for f in schema.fields}
    unknown = [c for c in columns if c not in by_name]
    if unknown:
        raise ValueError(f"columns not in schema: {unknown}")
    return T.StructType([by_name[c] for c in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   header: bool = True, columns: Sequence[str] | None = None,
                   mode: str = "FAILFAST", multiline: bool | str = True, sep: str = ",",
                   defaults: Mapping[str, Column] | None = None,
                   keep_partition_columns: bool = False,
                   keep: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Read CSV into ``schema`` (see module doc). Returns the schema's columns
    in schema order (plus partition columns if ``keep_partition_columns``).
    ``keep`` is a condition on partition columns, which prunes their folders."""
    file_schema = _file_schema(schema, columns)
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": mode, "nullValue": "", "emptyValue": EMPTY_MARK}
    if multiline == "split":
        records = read_records(spark, path, keep)
        kept = records.where("NOT first") if header else records
        parsed = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in file_schema.fields),
                            options | {"multiLine": "true"})
        df = kept.select(parsed.alias("record"), *[c for c in kept.columns if c not in ("record", "first")]).select(
            "record.*", *[c for c in kept.columns if c not in ("record", "first")])
    else:
        df = (spark.read.schema(file_schema).options(**options).option("header", header).option("multiLine", multiline)
              .option("enforceSchema", True).csv(path))
        if keep is not None:
            df = df.where(keep(df))
    out = []
    defaults = dict(defaults or {})
    for field in schema.fields:
        if field.name in file_schema.fieldNames():
            c = F.col(field.name)
            if isinstance(field.dataType, T.StringType):
                c = F.when(c == EMPTY_MARK, F.lit("")).otherwise(c)
            out.append(c.alias(field.name))
        elif field.name in defaults:
            out.append(defaults[field.name].cast(field.dataType).alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [c for c in df.columns if c not in file_schema.fieldNames()] if keep_partition_columns else []
    return df.select(*out, *extra)


def csv_writer(df: DataFrame, header: bool = True, sep: str = ","):
    """A ``DataFrameWriter`` producing text the reader above reads back
    exactly (NULL unquoted empty, empty string as ``""``)."""
    return (df.write.format("csv")
            .option("header", header)
            .option("sep", sep)
            .option("quote", '"')
            .option("escape", '"')
            .option("nullValue", "")
            .option("emptyValue", '""')
            .option("ignoreLeadingWhiteSpace", False)  # the writer trims by default
            .option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", WRITE_TIMESTAMP_TEXT))
