"""The state of a mart (``operators.deltas``) as Parquet folders by month, of
which a load reads and rewrites those that its delta touches.

Every row carries the batch that its month took in last. A load first writes
the new rows of the touched months to the shared folder and then swaps these
months in (dynamic partition overwrite). If it is cut short and repeated with
its batch, the months that were swapped already are told by the batch and left
out, so no row counts twice. Batches are applied one after another. Groups
without a date are in a folder of their own (Spark's folder for NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.recipes import GRAMS_DECIMAL, MATERIALS
from ..operators.deltas import KNOWN, ROWS, STATE_COLUMNS, add_delta
from ..schemas import DEMAND_SCHEMA
from ..session import scratch_path

MONTH, BATCH = "month", "batch"
STATE_SCHEMA = T.StructType(
    [T.StructField(c, DEMAND_SCHEMA[c].dataType) for c in ("date", "shop_id")]
    + [T.StructField(c, T.LongType()) for c in (ROWS, *KNOWN.values())]
    + [T.StructField(m, GRAMS_DECIMAL) for m in MATERIALS]
    + [T.StructField(BATCH, T.StringType()), T.StructField(MONTH, T.DateType())])


def _month() -> Column:
    return F.trunc(F.col("date").cast("date"), "month")


def start_state(spark: SparkSession, path: str) -> None:
    """An empty state; a folder that is there already is an error."""
    spark.createDataFrame([], STATE_SCHEMA).write.mode("errorifexists").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state at ``path``."""
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def load_delta(spark: SparkSession, path: str, delta: DataFrame, batch: str) -> list:
    """Take ``delta`` into the state at ``path`` as ``batch``; returns the
    touched months. These (one value a month of the calendar) are known to the
    driver, so the scan prunes all other folders; they are neither read nor
    written."""
    staged = scratch_path(spark, "delta")
    dated = delta.select(*STATE_COLUMNS, _month().alias(MONTH))
    dated.write.parquet(f"{staged}/delta")  # computed once: its months first, then its rows
    dated = spark.read.schema(dated.schema).parquet(f"{staged}/delta")
    months = [r[MONTH] for r in dated.select(MONTH).distinct().collect()]
    if not months:
        return []
    touched = F.col(MONTH).isin([m for m in months if m is not None])
    held = read_state(spark, path).where(touched | F.col(MONTH).isNull() if None in months else touched)
    done = [r[MONTH] for r in held.where(F.col(BATCH) == batch).select(MONTH).distinct().collect()]
    taken = F.coalesce(F.col(MONTH).isin([m for m in done if m is not None]), F.lit(None in done))
    new = add_delta(held.where(F.col(BATCH) != batch), dated.where(~taken))
    new.select(*STATE_COLUMNS, F.lit(batch).alias(BATCH), _month().alias(MONTH)).write.parquet(f"{staged}/new")
    swapped = spark.read.schema(STATE_SCHEMA).parquet(f"{staged}/new")
    (swapped.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH).parquet(path))
    return months
