"""Driver queries of the table, file and daily-job operators (see ``catalog``)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.interval import Interval, in_interval
from ..functions.exact import from_limbs
from ..functions.recipes import MATERIALS, expand_materials, material_limbs, split_rejects
from ..operators.catchup import catch_up
from ..operators.check_states import advance_states, check_states, settle_states, state_report
from ..operators.checks import column_checks
from ..operators.keys import ConstraintViolation
from ..operators.latest import latest_per_key
from ..operators.materials import exact_material_demand, material_demand, with_position
from ..operators.merge import apply_changes
from ..schemas import DEMAND_SCHEMA, RETAIL_COLUMNS, RETAIL_COLUMNS_NO_OP, RETAIL_SCHEMA
from ..session import scratch_path
from ..sources.delimited import csv_writer, read_delimited
from ..sources.lake import read_interval, write_interval, write_partitioned
from ..sources.mart_state import start_state
from ..sources.snapshots import SnapshotStore
from ..sources.tables import append, clear, ensure_table, full_refresh, read_table
from . import fixtures as fx
from .catalog import (_COLS, _COLS_NO_OP, _MERGE_O_AS_M, KG_SQL, REPLAY_ORACLE_DAYS, REPLAY_ORACLE_START, SLICE_END, SLICE_START, _latest_sql, _mart_query_sql, _mart_sql,
                      _merge_sql, _replay_sql, register)
from .fixtures import with_fixtures
from .jobs import data_span, refresh, replay, rerun, run_day, run_extract, run_material_delta, run_material_g_landing, run_material_kg

_DAY = "TIMESTAMP '2024-01-03' AND invoicedate < TIMESTAMP '2024-01-04'"


def _names(spark: SparkSession, *tables: str) -> list[str]:
    """Names in a namespace of their own, kept in the shared folder."""
    space = f"run_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {space} LOCATION '{scratch_path(spark, space)}'")
    return [f"{space}.{t}" for t in tables]


# --------------------------------------------------------------------------- delimited files

@register("csv_retail_11", with_fixtures("stage_o") + f"\nSELECT {_COLS} FROM stage_o")
def csv_retail_11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed as CSV with a header, 11 columns, read by position."""
    path = scratch_path(spark, "csv11")
    csv_writer(fx.stage_o(spark, sf_dir)).save(path)
    return read_delimited(spark, path, RETAIL_SCHEMA, multiline=False)


@register("csv_retail_10", with_fixtures("origin_o")
          + f"\nSELECT {_COLS_NO_OP}, CAST(NULL AS VARCHAR) AS operation FROM origin_o")
def csv_retail_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The origin as CSV of 10 named columns; the absent operation is NULL."""
    path = scratch_path(spark, "csv10")
    csv_writer(fx.origin_o(spark, sf_dir).select(*RETAIL_COLUMNS_NO_OP)).save(path)
    return read_delimited(spark, path, RETAIL_SCHEMA, columns=RETAIL_COLUMNS_NO_OP, multiline=False)


_TEXT_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                             T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@register("csv_split_multiline", "SELECT doc_id, text, lang, source FROM documents")
def csv_split_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks as CSV, every split of a file read by its own
    task, records cut by the quotes before them (S1, S8)."""
    path = scratch_path(spark, "texts")
    csv_writer(fx.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).save(path)
    return read_delimited(spark, path, _TEXT_SCHEMA, multiline="split")


@register("lake_split_interval", with_fixtures("origin_e") + f"\nSELECT * FROM origin_e WHERE invoicedate >= {_DAY}")
def lake_split_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the lake's CSV folders, read in splits."""
    root = scratch_path(spark, "lake")
    write_partitioned(fx.origin_e(spark, sf_dir), root, "retail", "invoicedate")
    return read_interval(spark, root, "retail", RETAIL_SCHEMA, Interval.parse(SLICE_START, SLICE_END), multiline="split")


@register("csv_headerless", with_fixtures("demand") + "\nSELECT shop_id, date, product_name, demand FROM demand")
def csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand written and read without a header line."""
    path = scratch_path(spark, "headerless")
    csv_writer(fx.demand(spark, sf_dir), header=False).save(path)
    return read_delimited(spark, path, DEMAND_SCHEMA, header=False, multiline=False)


@register("lake_recipe_csv", with_fixtures("demand") + f""",
{_mart_sql("frame", "mart")}
SELECT date, shop_id, product_name, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MATERIALS)} FROM mart_amounts""")
def lake_recipe_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with its grams per material as transformed CSV, read back (K4)."""
    path = scratch_path(spark, "transformed")
    out = expand_materials(fx.demand(spark, sf_dir), "frame").select("date", "shop_id", "product_name", *MATERIALS)
    csv_writer(out).save(path)
    back = read_delimited(spark, path, out.schema, multiline=False)
    return back.select("date", "shop_id", "product_name", *[F.col(m).cast("double").alias(m) for m in MATERIALS])


@register("lake_read_interval", with_fixtures("origin_e") + f"\nSELECT * FROM origin_e WHERE invoicedate >= {_DAY}")
def lake_read_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day read from the lake's day folders."""
    root = scratch_path(spark, "lake")
    write_partitioned(fx.origin_e(spark, sf_dir), root, "retail", "invoicedate")
    return read_interval(spark, root, "retail", RETAIL_SCHEMA, Interval.parse(SLICE_START, SLICE_END))


@register("interval_overwrite_multi", with_fixtures("origin_e") + f"""
SELECT {_COLS} FROM origin_e
WHERE NOT (invoicedate >= TIMESTAMP '2024-01-04' AND invoicedate < TIMESTAMP '2024-01-05')""")
def interval_overwrite_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole lake, then three days written again of which the middle one
    has no rows any more: it is emptied, the other days stand (K5)."""
    origin, root = fx.origin_e(spark, sf_dir), scratch_path(spark, "lake")
    span = data_span((origin, "invoicedate"))
    write_interval(origin, root, "retail", span, "invoicedate")
    withdrawn = in_interval(origin, Interval.day("2024-01-04"), "invoicedate")
    again = origin.join(withdrawn.select("invoice"), "invoice", "left_anti").select(*RETAIL_COLUMNS)
    write_interval(again, root, "retail", Interval.parse("2024-01-03", "2024-01-06"), "invoicedate")
    return read_interval(spark, root, "retail", RETAIL_SCHEMA, span)


# --------------------------------------------------------------------------- tables

@register("table_read_interval", with_fixtures("origin_e") + f"\nSELECT * FROM origin_e WHERE invoicedate >= {_DAY}")
def table_read_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of a catalog table under bound parameters."""
    [name] = _names(spark, "retail")
    ensure_table(spark, name, RETAIL_SCHEMA)
    ensure_table(spark, name, RETAIL_SCHEMA)  # present already: nothing happens
    append(fx.origin_e(spark, sf_dir), name)
    return read_table(spark, name, Interval.parse(SLICE_START, SLICE_END), "invoicedate")


@register("table_append", with_fixtures("origin_o", "origin_e")
          + f"\nSELECT {_COLS} FROM origin_o UNION ALL SELECT {_COLS} FROM origin_e")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads appended to one table (K7)."""
    [name] = _names(spark, "retail")
    ensure_table(spark, name, RETAIL_SCHEMA)
    append(fx.origin_o(spark, sf_dir), name)
    append(fx.origin_e(spark, sf_dir), name)
    return read_table(spark, name)


@register("table_clear", with_fixtures("origin_e") + f"\nSELECT {_COLS} FROM origin_e")
def table_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table cleared between two loads holds the second one."""
    [name] = _names(spark, "landing")
    ensure_table(spark, name, RETAIL_SCHEMA)
    append(fx.origin_o(spark, sf_dir), name)
    clear(spark, name)
    append(fx.origin_e(spark, sf_dir), name)
    return read_table(spark, name)


@register("table_full_refresh", with_fixtures("stage_o") + f"\nSELECT {_COLS} FROM stage_o")
def table_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of older rows dropped, created again and loaded from CSV (M9, K9)."""
    [name] = _names(spark, "retail")
    path = scratch_path(spark, "refresh")
    csv_writer(fx.stage_o(spark, sf_dir)).save(path)
    ensure_table(spark, name, RETAIL_SCHEMA)
    append(fx.origin_o(spark, sf_dir), name)
    full_refresh(spark, path, name, RETAIL_SCHEMA)
    return read_table(spark, name)


# --------------------------------------------------------------------------- slices, exact demand, order

@register("interval_text_dates", with_fixtures("stage_e") + f"""
SELECT * REPLACE (strftime(invoicedate, '%Y-%m-%d') AS invoicedate) FROM stage_e WHERE invoicedate >= {_DAY}""")
def interval_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day slice of a feed whose dates are text."""
    feed = fx.stage_e(spark, sf_dir).withColumn("invoicedate", F.date_format("invoicedate", "yyyy-MM-dd"))
    return in_interval(feed, Interval.parse(SLICE_START, SLICE_END), "invoicedate")


@register("recipe_exact", """
SELECT CAST(l_orderkey AS BIGINT) AS shop_id, l_linenumber AS line, CAST(l_linenumber * 20 AS DOUBLE) / 10000 AS grams
FROM lineitem""")
def recipe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand texts of ten-thousandths, kept exact through the recipe."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("shop_id"), F.col("l_linenumber").alias("line"), F.lit("cheap").alias("product_name"),
        F.concat(F.lit("0.000"), F.col("l_linenumber").cast("string")).alias("demand"))
    return expand_materials(lines, "sql").select("shop_id", "line", F.col(MATERIALS[0]).cast("double").alias("grams"))


@register("recipe_unbounded", """
WITH parts AS (SELECT l_suppkey, sum(l_orderkey) AS high, sum(l_linenumber) AS low FROM lineitem GROUP BY l_suppkey)
SELECT CAST(l_suppkey AS VARCHAR) AS shop_id,
       concat(high * 20, repeat('0', 50), '.', rtrim(lpad(CAST(low * 20 AS VARCHAR), 40, '0'), '0')) AS local_arabica
FROM parts""")
def recipe_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand of up to a hundred digits, and of ten to the minus fortieth
    beside it, added up exactly (E3, A1)."""
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    demand = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("shop_id"), F.lit(None).cast("timestamp_ntz").alias("date"), F.lit("cheap").alias("product_name"),
        F.concat(key, F.repeat(F.lit("0"), 50), F.lit("."), F.lpad(line, 40, "0")).alias("demand"))
    mart = exact_material_demand(demand, unit="g")
    return mart.where(F.col("material_name") == MATERIALS[0]).select("shop_id", F.col("quantity_g").alias(MATERIALS[0]))


@register("recipe_rejects", """
SELECT l_orderkey AS shop_id, l_linenumber AS line, l_linenumber IN (3, 5) AS rejected,
       CASE WHEN l_linenumber NOT IN (3, 5) THEN l_linenumber * 20.0 / 100000 END AS grams,
       count(*) FILTER (WHERE l_linenumber IN (3, 5)) OVER () AS n_rejected
FROM lineitem""")
def recipe_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with texts that are no numbers: good and bad rows written apart
    in one pass and counted; the good ones through the recipe (E3)."""
    line = F.col("l_linenumber")
    text = F.when(line == 3, "n/a").when(line == 5, F.lit("1,5")).otherwise(F.concat(F.lit("0.0000"), line.cast("string")))
    demand = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("shop_id"), line.alias("line"), F.lit("cheap").alias("product_name"), text.alias("demand"))
    good, bad, counts = split_rejects(demand, scratch_path(spark, "rejects"))
    grams = from_limbs(material_limbs("sql")[MATERIALS[0]]).cast("double")
    out = good.select("shop_id", "line", F.lit(False).alias("rejected"), grams.alias("grams")).unionByName(
        bad.select("shop_id", "line", F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("grams")))
    return out.withColumn("n_rejected", F.lit(counts["rejected"]).cast("long"))


@register("mart_order_grams", with_fixtures("demand") + ",\n" + _mart_sql("sql", "mart") + """
SELECT date, shop_id, material_name, CAST(quantity_g AS DOUBLE) AS quantity_g,
       row_number() OVER (ORDER BY date NULLS FIRST, shop_id NULLS FIRST, material_name) AS position FROM mart""")
def mart_order_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grams mart in the order of its key, with each row's place (O2)."""
    out = with_position(material_demand(fx.demand(spark, sf_dir), unit="g", sorted=True))
    return out.withColumn("quantity_g", F.col("quantity_g").cast("double"))


@register("mart_order_kg", KG_SQL.replace("\nSELECT CAST(date AS DATE) AS date,", """
SELECT row_number() OVER (ORDER BY list_position(['""" + "', '".join(MATERIALS) + """'], material_name),
                          CAST(date AS DATE), shop_id) AS position,
       CAST(date AS DATE) AS date,"""))
def mart_order_kg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kilogram mart material after material, with each row's place (O3)."""
    out = with_position(material_demand(fx.demand(spark, sf_dir), unit="kg", sorted=True))
    return out.withColumn("demand_kg", F.col("demand_kg").cast("double"))


# --------------------------------------------------------------------------- checks

_CHECKS = {"id": {"null_check": {"equal_to": 0}}, "quantity": {"min": {"geq_to": -900}, "max": {"less_than": 0}}}


def _check_sql(where: str) -> str:
    return with_fixtures("stage_o") + f""",
part AS (SELECT * FROM stage_o WHERE {where}),
one AS (SELECT count(*) - count(id) AS nulls, coalesce(min(quantity), 0) AS lo, coalesce(max(quantity), 0) AS hi FROM part)
SELECT 'id' AS "column", 'null_check' AS "check", CAST(nulls AS DOUBLE) AS actual, 'equal_to' AS comparator,
       0.0::DOUBLE AS expected, CAST(NULL AS DOUBLE) AS tolerance, nulls = 0 AS passed FROM one
UNION ALL SELECT 'quantity', 'min', lo, 'geq_to', -900.0, NULL, lo >= -900 FROM one
UNION ALL SELECT 'quantity', 'max', hi, 'less_than', 0.0, NULL, hi < 0 FROM one"""


@register("column_check_where", _check_sql("operation = 'U'"))
def column_check_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks over the rows that a filter keeps (Q5)."""
    return column_checks(fx.stage_o(spark, sf_dir), _CHECKS, where="operation = 'U'")


@register("column_check_none", _check_sql("operation = 'none'"))
def column_check_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks over no rows: an empty result counts as zero (Q6)."""
    return column_checks(fx.stage_o(spark, sf_dir), _CHECKS, where="operation = 'none'")


@register("failed_check_keeps_state", with_fixtures("origin_e") + f"""
SELECT {_COLS} FROM origin_e WHERE invoicedate >= TIMESTAMP '2024-01-01' AND invoicedate < TIMESTAMP '2024-01-02'""")
def failed_check_keeps_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose checks fail ends the run and publishes nothing: the state is
    the day before it (Q7)."""
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "gated"))
    run_day(store, origin, changes.where("false"), "2024-01-01")
    try:
        run_day(store, origin, changes, "2024-01-02", checks={"quantity": {"min": {"greater_than": 1e9}}})
    except ConstraintViolation:
        return spark.read.parquet(store.newest()[1])
    raise AssertionError("a failing check did not end the run")


# --------------------------------------------------------------------------- jobs

@register("merge_first_load", with_fixtures("origin_o", "stage_o", "origin_e") + f""",
feed AS (SELECT * FROM stage_o WHERE operation <> 'I' UNION ALL
         SELECT * REPLACE (CAST(id + 1000000000 AS INT) AS id, 'I' AS operation) FROM origin_e),
{_latest_sql("feed")}{_merge_sql("origin_o", "latest", list(RETAIL_COLUMNS))}""")
def merge_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that is mostly inserts, as on a first load: the insert keys are
    broadcast only if they fit (J1, M2)."""
    new = fx.origin_e(spark, sf_dir).withColumn("id", (F.col("id") + 1_000_000_000).cast("int"))
    feed = fx.stage_o(spark, sf_dir).where("operation != 'I'").unionByName(new.withColumn("operation", F.lit("I")))
    return apply_changes(fx.origin_o(spark, sf_dir), latest_per_key(feed))


@register("replay_rerun", _replay_sql())
def replay_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of all days but the last four, caught up in one pass and
    published; the last four replayed day by day while the changes of one of
    them are missing; then that day run again with them, and the days after it
    rebuilt (B6)."""
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    daily, late = max(span.start, span.end - dt.timedelta(days=4)), span.end - dt.timedelta(days=2)
    store = SnapshotStore(spark, scratch_path(spark, "rerun"))
    before = None
    if daily > span.start:
        before = store.write(catch_up(origin, changes, span.start, daily), daily - dt.timedelta(days=1))
    early = changes.where(F.to_date("invoicedate") != F.lit(late))
    replay(store, origin, early, daily, span.end, previous=before)
    return rerun(store, origin, changes, late)


@register("replay_ledger", _replay_sql())
def replay_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days but the last four caught up in one pass; the last four brought
    up to date while the changes of one of them are missing, then with them:
    exactly that day and the days after it run again, and a third time none (B6)."""
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    daily, late = max(span.start, span.end - dt.timedelta(days=4)), span.end - dt.timedelta(days=2)
    store = SnapshotStore(spark, scratch_path(spark, "ledger"))
    if daily > span.start:
        store.write(catch_up(origin, changes, span.start, daily), daily - dt.timedelta(days=1))
    refresh(store, origin, changes.where(F.to_date("invoicedate") != F.lit(late)), daily, span.end)
    state, ran = refresh(store, origin, changes, daily, span.end)
    _, again = refresh(store, origin, changes, daily, span.end)
    if (ran, again) != ([d.ds for d in Interval(late, span.end).days()], []):
        raise AssertionError(f"the wrong days ran: {ran}, {again}")
    return state


@register("replay_gap_refused", _replay_sql(REPLAY_ORACLE_DAYS - 3))
def replay_gap_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four weeks published; the day after the next is refused as the one
    before it is missing, and the state stays (B1, B2, B6)."""
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    done = dt.date.fromisoformat(REPLAY_ORACLE_START) + dt.timedelta(days=REPLAY_ORACLE_DAYS - 3)
    store = SnapshotStore(spark, scratch_path(spark, "gap"))
    store.write(catch_up(origin, changes, REPLAY_ORACLE_START, done), done - dt.timedelta(days=1))
    try:
        run_day(store, origin, changes, done + dt.timedelta(days=1))
    except ConstraintViolation:
        return spark.read.parquet(store.newest()[1])
    raise AssertionError("a day without its predecessor ran")


@register("merge_constraints", _replay_sql())
def merge_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day with an insert that has no id, then with one whose text is
    too long: neither is published; then as it is (K12, K13, M2)."""
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    last = span.end - dt.timedelta(days=1)
    store = SnapshotStore(spark, scratch_path(spark, "constraints"))
    store.write(catch_up(origin, changes, span.start, last), last - dt.timedelta(days=1))
    new = (changes.where(F.to_date("invoicedate") == F.lit(last)).limit(1)  # one row shows the fault
           .withColumns({"operation": F.lit("I"), "id": F.lit(2_000_000_000)}))
    bad = [new.withColumn("id", F.lit(None).cast("int")), new.withColumn("invoice", F.repeat(F.lit("x"), 150))]
    refused = 0
    for row in bad:
        try:
            run_day(store, origin, changes.unionByName(row), last)
        except ConstraintViolation:
            refused += 1
    if refused != len(bad):
        raise AssertionError("a row that breaks a constraint was published")
    return spark.read.parquet(run_day(store, origin, changes, last))


@register("job_material_kg", KG_SQL)
def job_material_kg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract to the lake, kg mart to the lake, load of the mart table; the
    last day is run twice (B3, B4, K2)."""
    demand, root = fx.demand(spark, sf_dir), scratch_path(spark, "job-kg")
    [name] = _names(spark, "material_demand_kg")
    span = data_span((demand, "date"))
    run_extract(demand, root, span)
    run_material_kg(spark, root, span, table=name)
    run_material_kg(spark, root, Interval.day(span.end - dt.timedelta(days=1)), table=name)
    return read_table(spark, name).withColumn("demand_kg", F.col("demand_kg").cast("double"))


@register("job_material_g", _mart_query_sql("sql"))
def job_material_g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table, grams mart, upsert, landing table cleared; the last day
    is run twice (B5, M8). Demand of no shop, which conflicts with nothing, is
    in the second run's slice as little as in a key."""
    demand = fx.demand(spark, sf_dir)
    [landing] = _names(spark, "landing")
    store = SnapshotStore(spark, scratch_path(spark, "job-g"))
    span = data_span((demand, "date"))
    run_material_g_landing(demand, landing, store, span)
    run_material_g_landing(demand.where("shop_id IS NOT NULL"), landing, store, Interval.day(span.end - dt.timedelta(days=1)))
    left = read_table(spark, landing)
    assert left.isEmpty(), "the landing table is cleared at the end of a run"
    return (spark.read.parquet(store.newest()[1])
            .withColumn("quantity_g", F.col("quantity_g").cast("double")))


_WITHDRAWN = "(date >= TIMESTAMP '1998-03-01' AND date < TIMESTAMP '1998-06-01' AND product_name = 'cheap')"


@register("job_material_delta", "WITH every AS (SELECT * FROM (" + with_fixtures("demand") + "\nSELECT * FROM demand)),\n"
          + f"demand AS (SELECT * FROM every WHERE ({_WITHDRAWN}) IS NOT TRUE),\n" + _mart_sql("sql", "mart") + """
SELECT date, shop_id, material_name, CAST(quantity_g AS DOUBLE) AS quantity_g FROM mart""")
def job_material_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grams mart kept by signed deltas: everything loaded, then three
    months run again without a tier that was withdrawn; the rows of both runs
    cancel and only the groups that differ change (A1, A2, B5)."""
    demand, path = fx.demand(spark, sf_dir), scratch_path(spark, "mart-state")
    start_state(spark, path)
    run_material_delta(spark, path, None, demand, "load")
    before = in_interval(demand, Interval.parse("1998-03-01", "1998-06-01"), "date")
    after = before.where("product_name IS DISTINCT FROM 'cheap'")
    mart = run_material_delta(spark, path, before, after, "rerun")
    return mart.withColumn("quantity_g", F.col("quantity_g").cast("double"))


KEPT_CHECKS = {
    "quantity": {"null_check": {"equal_to": 0}, "min": {"geq_to": -1012}},
    "price": {"min": {"greater_than": 100}, "max": {"leq_to": 50, "tolerance": 0.5}},
}


@register("checks_kept_states", _MERGE_O_AS_M + """
SELECT 'quantity' AS "column", 'null_check' AS "check", CAST(count(*) FILTER (WHERE quantity IS NULL) AS DOUBLE) AS actual,
       'equal_to' AS comparator, 0.0::DOUBLE AS expected, CAST(NULL AS DOUBLE) AS tolerance,
       count(*) FILTER (WHERE quantity IS NULL) = 0 AS passed FROM m
UNION ALL
SELECT 'quantity', 'min', CAST(min(quantity) AS DOUBLE), 'geq_to', -1012.0, CAST(NULL AS DOUBLE), min(quantity) >= -1012 FROM m
UNION ALL
SELECT 'price', 'min', CAST(min(price) AS DOUBLE), 'greater_than', 100.0, CAST(NULL AS DOUBLE), min(price) > 100 FROM m
UNION ALL
SELECT 'price', 'max', CAST(max(price) AS DOUBLE), 'leq_to', 50.0, 0.5, max(price) <= 75 FROM m""")
def checks_kept_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks after the merge, from the states before it and the rows it
    changed; only parts that lost an extreme value are read again (Q1-Q4, A4, A5)."""
    path, month = scratch_path(spark, "kept-checks"), "date_format(invoicedate, 'yyyy-MM')"
    target, latest = fx.origin_o(spark, sf_dir), latest_per_key(fx.stage_o(spark, sf_dir))
    check_states(target, KEPT_CHECKS, month).write.parquet(f"{path}/before")
    merged = apply_changes(target, latest).withColumn("month", F.expr(month))
    merged.hint("rebalance", "month").write.partitionBy("month").parquet(f"{path}/table")
    merged = spark.read.schema(merged.schema).parquet(f"{path}/table")
    ids = latest.select("id")
    removed = target.withColumn("month", F.expr(month)).join(ids, "id", "left_semi")
    advanced = advance_states(spark.read.parquet(f"{path}/before"), removed, merged.join(ids, "id", "left_semi"), KEPT_CHECKS, "month")
    advanced.write.parquet(f"{path}/advanced")
    return state_report(settle_states(spark.read.parquet(f"{path}/advanced"), merged, KEPT_CHECKS, "month"), KEPT_CHECKS)
