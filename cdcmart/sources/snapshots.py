"""Snapshot per ``ds``: the state after day ``ds`` is written once per run and
published only when complete.

Layout under ``root`` (a folder in the cluster's shared storage)::

    root/ds=2009-12-01/run=<stamp>-<id>/part-*.parquet   one folder per run
    root/_published/part-*.json                          (ds, path, run, parent, digest, since) records

A run writes a *new* folder (never the folder it reads, never a folder in
place), then appends one record to ``_published``. Readers take the newest
record for a ``ds``. A rerun of a day therefore replaces its snapshot
atomically, a failed run publishes nothing, and earlier days stay readable.

The records form a ledger. Each names its ``parent`` (the run of the day it was
built on) and a ``digest`` of the input it was built from, and says from which
day on it folded its input (``since``, its own day for a daily run). A record
retracts the older ones from that day on: they were built without what it
folded in. What is left is the chain of days that hold.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.interval import DateLike, parse_date

_RECORD = T.StructType([
    T.StructField("ds", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("parent", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("since", T.StringType()),
])


def _stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def published_path(self) -> str:
        return f"{self.root}/_published"

    def _records(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_RECORD).json(self.published_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # an unreadable store is not an empty one
            return None  # nothing published yet

    def stage(self, df: DataFrame, ds: DateLike) -> str:
        """Write the snapshot of ``ds`` into a new run folder (not yet visible)."""
        day = parse_date(ds).isoformat()
        run = _stamp()
        path = f"{self.root}/ds={day}/run={run}"
        df.write.mode("errorifexists").parquet(path)
        return path

    def publish(self, ds: DateLike, path: str, parent: str | None = None, digest: str | None = None,
                since: DateLike | None = None) -> str:
        """Make a staged folder the snapshot of ``ds`` (one small record);
        returns the record's run."""
        day = parse_date(ds).isoformat()
        run = _stamp()  # of this publication: a folder published again becomes the newest
        values = {"ds": day, "path": path, "run": run, "parent": parent, "digest": digest,
                  "since": day if since is None else parse_date(since).isoformat()}
        record = self.spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
        record.write.mode("append").json(self.published_path)
        return run

    def chain(self) -> dict[str, Row]:
        """The record of every day that holds (a few values a day)."""
        records, held = self._records(), {}
        for r in [] if records is None else records.orderBy("run").collect():
            since = r["since"] or r["ds"]
            held = {ds: kept for ds, kept in held.items() if ds < since}
            held[r["ds"]] = r
        return held

    def write(self, df: DataFrame, ds: DateLike) -> str:
        """Stage and publish the snapshot of ``ds``; returns its folder."""
        path = self.stage(df, ds)
        self.publish(ds, path)
        return path

    def path(self, ds: DateLike) -> str | None:
        """Folder of the snapshot of ``ds`` (None if none is published that holds)."""
        record = self.chain().get(parse_date(ds).isoformat())
        return record["path"] if record else None

    def latest_before(self, ds: DateLike) -> tuple[str, str] | None:
        """(ds, folder) of the newest snapshot strictly before ``ds`` that holds."""
        held, day = self.chain(), parse_date(ds).isoformat()
        before = max((d for d in held if d < day), default=None)
        return None if before is None else (before, held[before]["path"])

    def newest(self) -> tuple[str, str] | None:
        """(ds, folder) of the most recently published snapshot, whatever its
        day (run names start with a UTC time stamp)."""
        recs = self._records()
        if recs is None:
            return None
        row = recs.orderBy(F.col("run").desc()).select("ds", "path").first()
        return (row["ds"], row["path"]) if row else None

    def read(self, ds: DateLike) -> DataFrame:
        path = self.path(ds)
        if path is None:
            raise FileNotFoundError(f"no snapshot published for {parse_date(ds).isoformat()} in {self.root}")
        return self.spark.read.parquet(path)
