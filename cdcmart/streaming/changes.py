"""The change merge driven by a stream of change files.

``readStream`` picks up new change files as they land. Every micro-batch is
first added to the feed kept beside the snapshots, by day; then the state goes
back to the newest snapshot before the batch's earliest day and is folded
forward, day by day, from the whole feed of the days since. So a day that comes
late, comes in parts, or comes in the same batch as others gives the state of
the days in order, each with all its changes, however files and batches are
cut. The checks and constraints are observed during the snapshot write, and the
snapshot is published, and the older ones from that day on retracted, only when
they hold.

Re-running a micro-batch after a failure is safe: it replaces its own part of
the feed and folds again, and the stream's own checkpoint keeps the source
offsets in the shared folder.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catchup import catch_up
from ..operators.keys import ConstraintViolation
from ..plans.jobs import stage_checked
from ..schemas import RETAIL_CHECKS, RETAIL_SCHEMA
from ..sources.snapshots import SnapshotStore

_DAY, _BATCH = "feed_day", "feed_batch"


def merge_batch(store: SnapshotStore, batch: DataFrame, schema: T.StructType = RETAIL_SCHEMA,
                column: str = "invoicedate", checks: Mapping | None = RETAIL_CHECKS,
                keys: Sequence[str] | None = ("id", "last_updated"), batch_id: int | str | None = None) -> str | None:
    """Fold the changes of a batch into the state and publish it under the
    feed's last day. Returns the snapshot folder (None if no change has a day).

    A batch whose earliest day is not after the first snapshot, where one
    exists, is refused: the state before that day is not known.
    """
    spark = store.spark
    feed = f"{store.root}/_feed"
    name = uuid.uuid4().hex if batch_id is None else str(batch_id)
    dated = batch.select(*schema.fieldNames(), F.to_date(F.col(column)).alias(_DAY), F.lit(name).alias(_BATCH)).where(F.col(_DAY).isNotNull())
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_DAY, _BATCH).parquet(feed))
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField(_DAY, T.DateType()), T.StructField(_BATCH, T.StringType())])).parquet(feed)
    first = whole.where(F.col(_BATCH) == name).agg(F.min(_DAY)).first()[0]
    if first is None:
        return None
    since = whole.where(F.col(_DAY) >= F.lit(first))
    last = since.agg(F.max(_DAY)).first()[0]
    base = store.latest_before(first)
    if base is None and store.newest() is not None:
        raise ConstraintViolation(f"changes of {first} are older than the first snapshot")
    state = spark.read.schema(schema).parquet(base[1]) if base else spark.createDataFrame([], schema)
    merged = catch_up(state.where("false"), since.select(*schema.fieldNames()), first, last + dt.timedelta(days=1), column, initial=state)
    path = stage_checked(store, merged, last, checks, keys)
    store.publish(last, path, since=first)
    return path


def merge_stream(spark: SparkSession, changes_path: str, store: SnapshotStore,
                 schema: T.StructType = RETAIL_SCHEMA, fmt: str = "parquet",
                 files_per_batch: int | None = None, checkpoint: str | None = None,
                 checks: Mapping | None = RETAIL_CHECKS, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the streaming merge of the
    change files under ``changes_path``. Returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(changes_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_batch(store, batch, schema, checks=checks, batch_id=batch_id)

    writer = (stream.writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint or f"{store.root}/_stream_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
