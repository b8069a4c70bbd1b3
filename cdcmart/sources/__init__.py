"""Readers and writers: delimited text, the date-partitioned lake, catalog tables,
snapshots and the bucketed target."""

from .bucketed import bucketed_target, create_bucketed, merge_bucketed
from .delimited import csv_writer, read_delimited
from .lake import interval_path, read_interval, read_partitioned, write_interval, write_partitioned
from .snapshots import SnapshotStore
from .tables import append, apply_defaults, clear, ensure_table, full_refresh, read_jdbc, read_table

__all__ = [
    "bucketed_target", "create_bucketed", "merge_bucketed", "csv_writer", "read_delimited", "interval_path",
    "read_interval", "read_partitioned", "write_interval", "write_partitioned", "SnapshotStore", "append",
    "apply_defaults", "clear", "ensure_table", "full_refresh", "read_jdbc", "read_table",
]
