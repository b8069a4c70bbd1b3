"""A target kept as one of Spark's own bucketed tables, so that a daily merge
moves the changes to the target's buckets and never the target.

``create_bucketed`` writes the table with ``bucketBy`` on the key. The catalog
holds the number of buckets and the key, and Spark's scan reports the table as
already dealt out by them: in ``merge_bucketed`` both joins of
``apply_changes`` and the distinct target keys run bucket by bucket, without an
exchange above the target's scan. The result is written as a new table with the
same buckets, which the caller takes as the next day's target; a run cut short
leaves the old one as it was.

A bucket is read by one task, so a table is measured when it is created (rows
by bucket, from the key column alone) and the largest bucket's share stands in
its properties. Where that is more than ``HOT`` times the mean, as with one id
that holds a third of all rows, ``bucketed_target`` reads the files as a plain
table instead, whose joins adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import _as_list
from ..operators.merge import apply_changes

#: a largest bucket of more than so many times the mean is read in splits
HOT = 4.0
_LARGEST = "cdcmart.largest_bucket_over_mean"


def create_bucketed(df: DataFrame, table: str, keys: str | Sequence[str] = "id", buckets: int = 64) -> None:
    """Write ``df`` as the catalog table ``table`` in ``buckets`` buckets of the
    key (a few hundred MB each). A table of that name is an error."""
    spark, keys = df.sparkSession, _as_list(keys)
    df.write.bucketBy(buckets, *keys).saveAsTable(table, format="parquet", mode="errorifexists")
    sizes = (spark.table(table).groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket"))
             .agg(F.count(F.lit(1)).alias("n")))
    most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    share = most * buckets / rows if rows else 1.0
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_LARGEST}' = '{share:.3f}')")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def bucket_spec(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """The key and the number of buckets of ``table``, as the catalog holds them."""
    told = _described(spark, table)
    if "Num Buckets" not in told:
        raise ValueError(f"not a bucketed table: {table}")
    return [c.strip(" `") for c in told["Bucket Columns"].strip("[]").split(",")], int(told["Num Buckets"])


def bucketed_target(spark: SparkSession, table: str) -> DataFrame:
    """The table as a merge target: by bucket, or in splits if a bucket is hot."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if float(properties.get(_LARGEST, 1)) <= HOT:
        return spark.table(table)
    return spark.read.schema(spark.table(table).schema).parquet(_described(spark, table)["Location"])


def merge_bucketed(spark: SparkSession, table: str, changes: DataFrame, result: str, **kwargs) -> DataFrame:
    """Merge ``changes`` (one row per key) into ``table`` and write ``result``
    with the same key and buckets; returns it. ``table`` stays as it is."""
    keys, buckets = bucket_spec(spark, table)
    create_bucketed(merged_frame(spark, table, changes, **kwargs), result, keys, buckets)
    return spark.table(result)


def merged_frame(spark: SparkSession, table: str, changes: DataFrame, **kwargs) -> DataFrame:
    """The merge of ``changes`` into ``table``, not yet written."""
    return apply_changes(bucketed_target(spark, table), changes, bucket_spec(spark, table)[0], strategy="shuffle", **kwargs)
