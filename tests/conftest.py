import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cdcmart.schemas import RETAIL_SCHEMA  # noqa: E402
from cdcmart.session import LOCAL_CONF, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cdcmart-tests-")
    builder = (SparkSession.builder.master("local[*]").appName("cdcmart-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .config("spark.driver.memory", "4g"))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)  # sets a scratch checkpoint folder only if none is configured
    yield session


def ts(text):
    """'2024-01-01 10:00' -> datetime."""
    return dt.datetime.fromisoformat(text)


def retail(spark, rows, schema=RETAIL_SCHEMA):
    """Rows given as (id, invoice, quantity, invoicedate, last_updated, operation) -> retail frame."""
    full = []
    for r in rows:
        rid, invoice, qty, inv_date, updated, op = r
        full.append((rid, invoice, "SC", "desc", qty, inv_date, 1.5, "C1", "NL", updated, op))
    return spark.createDataFrame(full, schema)


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def srt(rows):
    """Rows sorted naturally, NULLs last in each position."""
    return sorted(rows, key=_key)


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return srt(tuple(r[c] for c in cols) for r in df.collect())


def plan_of(df):
    """The physical plan as ``df.explain()`` prints it."""
    from cdcmart.plans.explain import plan_text
    return plan_text(df)
