"""Driver queries: one per operator group, each with an oracle in plain SQL.

Every query reads the driver's tables through ``fixtures`` (which only shape
rows) and runs the library's own operator over the whole input. The oracle is
written in a *different* formulation (merge as anti-join + union, latest as
``QUALIFY``, unpivot as ``UNION ALL``) so that a shared mistake shows.
Computed numeric outputs are cast to DOUBLE on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.interval import Interval, in_interval
from ..functions.recipes import MATERIALS, expand_materials
from ..operators.latest import first_per_key, latest_per_key
from ..operators.merge import append_interval, apply_changes, cdc_interval, merge_outcomes
from ..schemas import RETAIL_COLUMNS, RETAIL_COLUMNS_NO_OP
from . import fixtures as fx
from .fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the single-slice queries: one day of the January 2024
# change feed, given in both date spellings.
SLICE_START, SLICE_END = "2024-01-03", "20240104"

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Query]:
    from . import catalog_tables  # noqa: F401  (registers the table and file queries)
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_tables  # noqa: F401
    return dict(_ORACLES)


# --------------------------------------------------------------------------- SQL helpers

_COLS = ", ".join(RETAIL_COLUMNS)
_COLS_NO_OP = ", ".join(RETAIL_COLUMNS_NO_OP)


def _latest_sql(source: str, name: str = "latest", where: str = "") -> str:
    return (f"{name} AS (SELECT * FROM {source} {where} QUALIFY row_number() OVER "
            f"(PARTITION BY id ORDER BY last_updated DESC NULLS FIRST) = 1)")


def _merge_sql(target: str, latest: str, columns: list[str]) -> str:
    """Merge as: untouched-or-kept rows UNION ALL updated rows UNION ALL inserts."""
    upd = ", ".join("t.id" if c == "id" else f"c.{c}" for c in columns)
    cols = ", ".join(columns)
    return f"""
SELECT {", ".join("t." + c for c in columns)} FROM {target} t
  WHERE NOT EXISTS (SELECT 1 FROM {latest} c WHERE c.id = t.id AND c.operation IN ('U', 'D'))
UNION ALL
SELECT {upd} FROM {target} t JOIN {latest} c ON c.id = t.id AND c.operation = 'U'
UNION ALL
SELECT {cols} FROM {latest} c
  WHERE c.operation = 'I' AND NOT EXISTS (SELECT 1 FROM {target} t WHERE t.id = c.id)"""


# --------------------------------------------------------------------------- scans, filters

@register("scan_projection", with_fixtures("origin_o") + f"\nSELECT {_COLS} FROM origin_o")
def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit projection of the retail row."""
    return fx.origin_o(spark, sf_dir).select(*RETAIL_COLUMNS)


@register("interval_filter", with_fixtures("stage_e")
          + f"\nSELECT * FROM stage_e WHERE invoicedate >= TIMESTAMP '2024-01-03' "
            f"AND invoicedate < TIMESTAMP '2024-01-04'")
def interval_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open day slice with a dashless end bound."""
    return in_interval(fx.stage_e(spark, sf_dir), Interval.parse(SLICE_START, SLICE_END), "invoicedate")


# --------------------------------------------------------------------------- latest per key

@register("latest_change_per_id", with_fixtures("stage_o") + ",\n" + _latest_sql("stage_o")
          + "\nSELECT * FROM latest")
def latest_change_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest change per id over the whole feed."""
    return latest_per_key(fx.stage_o(spark, sf_dir), "id", "last_updated")


@register("first_value_distinct", with_fixtures("stage_o")
          + "\nSELECT unnest(arg_max(change, change.last_updated)) FROM stage_o AS change GROUP BY change.id")
def first_value_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal first_value-over-window + DISTINCT form."""
    return first_per_key(fx.stage_o(spark, sf_dir), "id", "last_updated")


# --------------------------------------------------------------------------- merges

_MERGE_O = (with_fixtures("origin_o", "stage_o") + ",\n" + _latest_sql("stage_o")
            + _merge_sql("origin_o", "latest", list(RETAIL_COLUMNS)))


@register("merge_full", _MERGE_O)
def merge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest change per id merged into the orders-sized target, shuffled plan."""
    latest = latest_per_key(fx.stage_o(spark, sf_dir))
    return apply_changes(fx.origin_o(spark, sf_dir), latest, strategy="shuffle")


@register("merge_small_change", _MERGE_O)
def merge_small_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same merge, size-checked plan: broadcast the U/D changes when their
    measured size fits the broadcast limit, else shuffle (§7.4)."""
    latest = latest_per_key(fx.stage_o(spark, sf_dir))
    return apply_changes(fx.origin_o(spark, sf_dir), latest, strategy="auto")


@register("merge_no_operation", with_fixtures("origin_o", "stage_o") + ",\n"
          + "target AS (SELECT " + _COLS_NO_OP + " FROM origin_o),\n" + _latest_sql("stage_o")
          + _merge_sql("target", "latest", list(RETAIL_COLUMNS_NO_OP)))
def merge_no_operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-column target: the operation is applied but not stored (M6)."""
    target = fx.origin_o(spark, sf_dir).select(*RETAIL_COLUMNS_NO_OP)
    latest = latest_per_key(fx.stage_o(spark, sf_dir))
    return apply_changes(target, latest)


@register("merge_interval", with_fixtures("origin_e", "stage_e") + ",\n"
          + _latest_sql("stage_e", where="WHERE invoicedate >= TIMESTAMP '2024-01-03' "
                                         "AND invoicedate < TIMESTAMP '2024-01-04'")
          + _merge_sql("origin_e", "latest", list(RETAIL_COLUMNS)))
def merge_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice the feed to one day *before* picking the latest, then merge (M7)."""
    return cdc_interval(fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir),
                        Interval.parse(SLICE_START, SLICE_END))


@register("merge_outcomes", with_fixtures("origin_o", "stage_o") + ",\n" + _latest_sql("stage_o") + """,
tk AS (SELECT id, count(*) AS n FROM origin_o GROUP BY id)
SELECT outcome, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN tk.id IS NOT NULL AND c.operation = 'D' THEN 'delete'
              WHEN tk.id IS NOT NULL AND c.operation = 'U' THEN 'update'
              WHEN tk.id IS NOT NULL THEN 'matched_noop'
              WHEN c.operation = 'I' THEN 'insert'
              ELSE 'unmatched_ignored' END AS outcome,
         coalesce(tk.n, 1) AS n
  FROM latest c LEFT JOIN tk ON tk.id = c.id) GROUP BY outcome
UNION ALL
SELECT 'untouched' AS outcome, CAST(count(*) AS BIGINT) AS n FROM origin_o t
  WHERE NOT EXISTS (SELECT 1 FROM latest c WHERE c.id = t.id)""")
def merge_outcomes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per merge outcome (op x matched) plus untouched target rows (M5)."""
    latest = latest_per_key(fx.stage_o(spark, sf_dir))
    return merge_outcomes(fx.origin_o(spark, sf_dir), latest)


@register("append_interval", with_fixtures("origin_o", "origin_e")
          + f"\nSELECT {_COLS} FROM origin_o UNION ALL SELECT {_COLS} FROM origin_e "
            "WHERE invoicedate >= TIMESTAMP '2024-01-03' AND invoicedate < TIMESTAMP '2024-01-04'")
def append_interval_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append one day of the origin table to the warehouse table (M1)."""
    return append_interval(fx.origin_o(spark, sf_dir), fx.origin_e(spark, sf_dir),
                           Interval.parse(SLICE_START, SLICE_END))


# --------------------------------------------------------------------------- recipes

# Grams a unit of demand takes of local arabica, foreign arabica
# and robusta, by tier; the last line is every other tier and none.
_GRAMS_A_UNIT = {
    "sql": (["('cheap', 20, 0, 0)", "('medium', 10, 10, 0)"], (0, 10, 10)),
    "frame": (["('cheap', 20, 0, 0)", "('medium', 10, 10, 0)", "('expensive', 0, 10, 10)"], (10, 0, 10)),
}


def _amounts_sql(recipe: str, name: str = "amounts", where: str = "") -> str:
    """CTE: every demand row with its grams, the factors joined in by tier."""
    known, other = _GRAMS_A_UNIT[recipe]
    grams = ", ".join(f"coalesce(u.{f}, {o}) * CAST(d.demand AS DECIMAL(24, 6)) AS {m}"
                      for f, o, m in zip("lfr", other, MATERIALS))
    return (f"{name} AS (SELECT d.*, {grams} FROM demand d LEFT JOIN "
            f"(VALUES {', '.join(known)}) AS u(tier, l, f, r) ON u.tier = d.product_name {where})")


def _recipe_query(recipe: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = expand_materials(fx.demand(spark, sf_dir), recipe)
        return out.select("shop_id", "date", "product_name", "demand",
                          *[F.col(m).cast("double").alias(m) for m in MATERIALS])
    run.__doc__ = f"Per-row tier -> grams, {recipe} recipe (E1-E4, P5, P6)."
    return run


for _recipe in ("sql", "frame"):
    register(f"recipe_{_recipe}", with_fixtures("demand") + ",\n" + _amounts_sql(_recipe) + f"""
SELECT shop_id, date, product_name, demand, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MATERIALS)}
FROM amounts""")(
        _recipe_query(_recipe))


# --------------------------------------------------------------------------- material marts

_MATS = list(MATERIALS)


def _mart_sql(recipe: str, name: str) -> str:
    """CTEs: sums per (date, shop), then one row per material."""
    sums = ", ".join(f"sum({m}) AS {m}" for m in _MATS)
    return (_amounts_sql(recipe, f"{name}_amounts") + f""",
{name}_sums AS (SELECT date, shop_id, {sums} FROM {name}_amounts GROUP BY ALL),
{name} AS (FROM {name}_sums UNPIVOT INCLUDE NULLS (quantity_g FOR material_name IN ({", ".join(_MATS)})))""")


def _mart_query_sql(recipe: str, value: str = "CAST(quantity_g AS DOUBLE)") -> str:
    return (with_fixtures("demand") + ",\n" + _mart_sql(recipe, "mart")
            + f"\nSELECT date, shop_id, material_name, {value} AS quantity_g FROM mart")


def _grams(spark: SparkSession, sf_dir: str, recipe: str = "sql", as_text: bool = False) -> DataFrame:
    from ..operators.materials import material_demand
    out = material_demand(fx.demand(spark, sf_dir), unit="g", recipe=recipe, as_text=as_text)
    return out if as_text else out.withColumn("quantity_g", F.col("quantity_g").cast("double"))


@register("material_grams", _mart_query_sql("sql"))
def material_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grams mart: SQL recipe, sum by date/shop/material, NULL shop kept."""
    return _grams(spark, sf_dir, "sql")


@register("mart_text_columns", _mart_query_sql("sql", "CAST(CAST(quantity_g AS DECIMAL(38, 4)) AS VARCHAR)"))
def mart_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grams mart with the quantity stored as text."""
    return _grams(spark, sf_dir, "sql", as_text=True)


KG_SQL = (with_fixtures("demand") + ",\n" + _mart_sql("frame", "mart") + """
SELECT CAST(date AS DATE) AS date, shop_id, material_name AS raw_material,
       CAST(coalesce(quantity_g, 0) AS DOUBLE) / 1000 AS demand_kg
FROM mart WHERE date IS NOT NULL AND shop_id IS NOT NULL""")


@register("material_kg", KG_SQL)
def material_kg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilogram mart: frame recipe, NULL keys dropped, sums then melt, g -> kg, DATE."""
    from ..operators.materials import material_demand
    out = material_demand(fx.demand(spark, sf_dir), unit="kg")
    return out.withColumn("demand_kg", F.col("demand_kg").cast("double"))


@register("upsert_material", with_fixtures("demand") + ",\n" + _mart_sql("sql", "stored") + ",\n"
          + _mart_sql("frame", "fresh") + """
SELECT date, shop_id, material_name, CAST(quantity_g AS DOUBLE) AS quantity_g FROM stored t
  WHERE NOT EXISTS (SELECT 1 FROM fresh s WHERE s.date = t.date AND s.shop_id = t.shop_id
                    AND s.material_name = t.material_name)
UNION ALL
SELECT date, shop_id, material_name, CAST(quantity_g AS DOUBLE) AS quantity_g FROM fresh""")
def upsert_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert the frame-recipe grams mart into the SQL-recipe one on
    (date, shop_id, material_name); NULL shops never conflict (J2, M8)."""
    from ..operators.materials import material_demand
    from ..operators.merge import upsert
    demand = fx.demand(spark, sf_dir)
    target = material_demand(demand, unit="g", recipe="sql")
    source = material_demand(demand, unit="g", recipe="frame")
    out = upsert(target, source, keys=("date", "shop_id", "material_name"))
    return out.withColumn("quantity_g", F.col("quantity_g").cast("double"))


# --------------------------------------------------------------------------- checks and constraints

# The merge oracle as a CTE ``m``: its first SELECT opens the CTE.
_MERGE_O_AS_M = _MERGE_O.replace("\nSELECT t.", ",\nm AS (SELECT t.", 1) + ")"


@register("column_check_report", _MERGE_O_AS_M + """
SELECT 'id' AS "column", 'null_check' AS "check", CAST(count(*) FILTER (WHERE id IS NULL) AS DOUBLE) AS actual,
       'equal_to' AS comparator, 0.0::DOUBLE AS expected, 0.0::DOUBLE AS tolerance,
       count(*) FILTER (WHERE id IS NULL) = 0 AS passed FROM m
UNION ALL
SELECT 'quantity', 'null_check', CAST(count(*) FILTER (WHERE quantity IS NULL) AS DOUBLE), 'equal_to', 0.0,
       CAST(NULL AS DOUBLE), count(*) FILTER (WHERE quantity IS NULL) = 0 FROM m
UNION ALL
SELECT 'quantity', 'min', CAST(coalesce(min(quantity), 0) AS DOUBLE), 'geq_to', -1012.0,
       CAST(NULL AS DOUBLE), coalesce(min(quantity), 0) >= -1012 FROM m""")
def column_check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured checks on the merged table, one aggregation pass (A4, A5, Q1-Q6)."""
    from ..operators.checks import column_checks
    from ..schemas import RETAIL_CHECKS
    return column_checks(merge_full(spark, sf_dir), RETAIL_CHECKS)


MIXED_CHECKS = {
    "id": {"unique_check": {"equal_to": 0}, "distinct_check": {"geq_to": 1000, "tolerance": 0.1}},
    "price": {"max": {"leq_to": 50, "tolerance": 0.5}, "min": {"greater_than": 0}},
    "customer_id": {"null_check": {"less_than": 1}},
}


@register("column_check_mix", with_fixtures("stage_o") + """
SELECT 'id' AS "column", 'unique_check' AS "check", CAST(count(id) - count(DISTINCT id) AS DOUBLE) AS actual,
       'equal_to' AS comparator, 0.0::DOUBLE AS expected, CAST(NULL AS DOUBLE) AS tolerance,
       count(id) - count(DISTINCT id) = 0 AS passed FROM stage_o
UNION ALL
SELECT 'id', 'distinct_check', CAST(count(DISTINCT id) AS DOUBLE), 'geq_to', 1000.0, 0.1,
       count(DISTINCT id) >= 900 FROM stage_o
UNION ALL
SELECT 'price', 'max', CAST(max(price) AS DOUBLE), 'leq_to', 50.0, 0.5, max(price) <= 75 FROM stage_o
UNION ALL
SELECT 'price', 'min', CAST(min(price) AS DOUBLE), 'greater_than', 0.0, CAST(NULL AS DOUBLE), min(price) > 0 FROM stage_o
UNION ALL
SELECT 'customer_id', 'null_check', CAST(count(*) FILTER (WHERE customer_id IS NULL) AS DOUBLE), 'less_than', 1.0,
       CAST(NULL AS DOUBLE), count(*) FILTER (WHERE customer_id IS NULL) < 1 FROM stage_o""")
def column_check_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check kind and comparator, tolerance widening the bound (Q1, Q3, Q4)."""
    from ..operators.checks import column_checks
    return column_checks(fx.stage_o(spark, sf_dir), MIXED_CHECKS)


@register("key_violations", with_fixtures("stage_o") + """
SELECT id, CAST(count(*) AS BIGINT) AS n, 'duplicate' AS reason FROM stage_o WHERE id IS NOT NULL
  GROUP BY id HAVING count(*) > 1
UNION ALL
SELECT id, CAST(count(*) AS BIGINT) AS n, 'null_key' AS reason FROM stage_o WHERE id IS NULL GROUP BY id""")
def key_violations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids repeated in the change feed, NULL ids."""
    from ..operators.keys import key_violations
    return key_violations(fx.stage_o(spark, sf_dir), ["id"])


def _length_sql() -> str:
    from ..schemas import RETAIL_LENGTHS
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(max(length({c})) AS BIGINT) AS max_length, "
        f"CAST({n} AS BIGINT) AS limit_length, CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) "
        f"AS violations FROM stage_o" for c, n in RETAIL_LENGTHS.items())


@register("length_violations", with_fixtures("stage_o") + "\n" + _length_sql())
def length_violations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VARCHAR(100) / char(1) limits of the change feed, one pass."""
    from ..operators.keys import length_violations
    from ..schemas import RETAIL_LENGTHS
    return length_violations(fx.stage_o(spark, sf_dir), RETAIL_LENGTHS)


@register("month_path", with_fixtures("demand") + """
SELECT strftime(date, '%Y/%m') AS month_path, CAST(count(*) AS BIGINT) AS n FROM demand GROUP BY 1""")
def month_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake month folder (yyyy/MM) of every demand row, counted."""
    from ..functions.interval import month_path
    return (fx.demand(spark, sf_dir).groupBy(month_path("date").alias("month_path"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@register("default_dates", with_fixtures("origin_o") + """
SELECT * REPLACE (CAST(current_date AS TIMESTAMP) AS invoicedate, CAST(current_date AS TIMESTAMP) AS last_updated)
FROM origin_o""")
def default_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that omits both dates gets today at midnight."""
    from ..schemas import RETAIL_SCHEMA
    from ..sources.tables import apply_defaults, retail_defaults
    loaded = fx.origin_o(spark, sf_dir).drop("invoicedate", "last_updated")
    return apply_defaults(loaded, RETAIL_SCHEMA, retail_defaults())


# --------------------------------------------------------------------------- files

@register("csv_round_trip", with_fixtures("demand") + "\nSELECT shop_id, date, product_name, demand FROM demand")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand written to the lake as day-partitioned CSV in year/month folders
    and read back by schema (S1, S6, S8, K1, K6)."""
    from ..schemas import DEMAND_SCHEMA
    from ..session import scratch_path
    from ..sources.lake import read_partitioned, write_partitioned
    root = scratch_path(spark, "lake")
    write_partitioned(fx.demand(spark, sf_dir), root, "product_demand", "date", fmt="csv")
    return read_partitioned(spark, root, "product_demand", DEMAND_SCHEMA, fmt="csv")


@register("interval_overwrite", with_fixtures("demand") + "\nSELECT shop_id, date, product_name, demand FROM demand")
def interval_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full extract, then the first day re-extracted twice: each rerun replaces
    that day's folder and leaves the others, so the lake still holds every row
    exactly once (S10, K1, K5, B3)."""
    from ..schemas import DEMAND_SCHEMA
    from ..session import scratch_path
    from ..sources.lake import read_partitioned, write_partitioned
    from .jobs import data_span, run_extract
    demand = fx.demand(spark, sf_dir)
    root = scratch_path(spark, "lake")
    write_partitioned(demand, root, "product_demand", "date", fmt="csv")
    first = Interval.day(data_span((demand, "date")).start)
    run_extract(demand, root, first)
    run_extract(demand, root, first)
    return read_partitioned(spark, root, "product_demand", DEMAND_SCHEMA, fmt="csv")


# --------------------------------------------------------------------------- replay

# Fixed span of the oracle: every day of January 2024 (the events' month).
REPLAY_ORACLE_START, REPLAY_ORACLE_DAYS = "2024-01-01", 31


def _replay_sql(days: int = REPLAY_ORACLE_DAYS) -> str:
    import datetime as dt
    start = dt.date.fromisoformat(REPLAY_ORACLE_START)
    parts = [with_fixtures("origin_e", "stage_e"), f"s0 AS (SELECT {_COLS} FROM origin_e WHERE false)"]
    for i in range(1, days + 1):
        lo, hi = start + dt.timedelta(days=i - 1), start + dt.timedelta(days=i)
        cond = f"WHERE invoicedate >= TIMESTAMP '{lo}' AND invoicedate < TIMESTAMP '{hi}'"
        parts.append(f"a{i} AS (SELECT {_COLS} FROM s{i - 1} UNION ALL SELECT {_COLS} FROM origin_e {cond})")
        parts.append(_latest_sql("stage_e", f"l{i}", where=cond))
        parts.append(f"s{i} AS ({_merge_sql(f'a{i}', f'l{i}', list(RETAIL_COLUMNS))})")
    return ",\n".join(parts) + f"\nSELECT * FROM s{days}"


def _stream_sql() -> str:
    """The orders-sized target with the changes of every day merged in order."""
    import datetime as dt
    start = dt.date.fromisoformat(REPLAY_ORACLE_START)
    parts = [with_fixtures("origin_o", "stage_o"), f"s0 AS (SELECT {_COLS} FROM origin_o)"]
    for i in range(1, REPLAY_ORACLE_DAYS + 1):
        parts.append(_latest_sql("stage_o", f"l{i}", where=f"WHERE CAST(invoicedate AS DATE) = '{start + dt.timedelta(days=i - 1)}'"))
        parts.append(f"s{i} AS ({_merge_sql(f's{i - 1}', f'l{i}', list(RETAIL_COLUMNS))})")
    return ",\n".join(parts) + f"\nSELECT * FROM s{REPLAY_ORACLE_DAYS}"


@register("replay_state", _replay_sql())
def replay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the feed in order: append the day's origin rows, merge the
    day's latest changes, check, publish a snapshot; the last snapshot (B1, B2, B6)."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from .jobs import data_span, replay
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    store = SnapshotStore(spark, scratch_path(spark, "replay"))
    return replay(store, origin, changes, span.start, span.end)


@register("replay_catchup", _replay_sql())
def replay_catchup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state as ``replay_state`` (every day appended and merged in
    order) computed in one pass: per-key live/dead events over the days, the
    last delete and the last update per key, one join (B6 as a catch-up)."""
    from ..operators.catchup import catch_up
    from .jobs import data_span
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    return catch_up(origin, changes, span.start, span.end)


@register("stream_merge", _stream_sql())
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed landed as files and consumed by a Structured Streaming
    query (``availableNow``): every batch folded into the published target
    snapshot, day by day, in ``foreachBatch``; the newest snapshot (S11, M7)."""
    return _streamed(spark, sf_dir, lambda feed: [feed])


@register("stream_merge_days", _stream_sql())
def stream_merge_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed in three batches: the even days of the second half, then
    every other row of all the rest, then what is left, so days come late, in
    the wrong order and in parts (M7, B6)."""
    day, half = F.dayofmonth("invoicedate"), F.pmod(F.xxhash64("invoice"), F.lit(2)) == 0
    late = (day > 15) & (day % 2 == 0)
    return _streamed(spark, sf_dir, lambda feed: [feed.where(late), feed.where(~late & half), feed.where(~late & ~half)])


def _streamed(spark: SparkSession, sf_dir: str, cut: Callable[[DataFrame], list[DataFrame]]) -> DataFrame:
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from ..streaming.changes import merge_stream
    root = scratch_path(spark, "stream")
    store = SnapshotStore(spark, f"{root}/state")
    store.write(fx.origin_o(spark, sf_dir), "1900-01-01")
    for part in cut(fx.stage_o(spark, sf_dir)):
        part.write.mode("append").parquet(f"{root}/changes")
        merge_stream(spark, f"{root}/changes", store)  # the stream goes on where it stopped
    return spark.read.parquet(store.newest()[1])


@register("merge_bucketed", _MERGE_O)
def merge_bucketed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target as a table that Spark keeps bucketed by id: the merge moves
    only the changes, its result has the same buckets (J1, M2-M5 at scale)."""
    from ..sources.bucketed import create_bucketed, merge_bucketed
    from .catalog_tables import _names
    target, result = _names(spark, "target", "merged")
    create_bucketed(fx.origin_o(spark, sf_dir), target, "id", buckets=64)
    return merge_bucketed(spark, target, latest_per_key(fx.stage_o(spark, sf_dir)), result)


@register("merge_classified", with_fixtures("origin_o", "stage_o") + ",\n" + _latest_sql("stage_o") + """,
tk AS (SELECT id, count(*) AS n FROM origin_o GROUP BY id)
SELECT c.id, c.operation, tk.id IS NOT NULL AS matched, CAST(coalesce(tk.n, 0) AS BIGINT) AS target_rows,
       CASE WHEN tk.id IS NOT NULL AND c.operation = 'D' THEN 'delete'
            WHEN tk.id IS NOT NULL AND c.operation = 'U' THEN 'update'
            WHEN tk.id IS NOT NULL THEN 'matched_noop'
            WHEN c.operation = 'I' THEN 'insert'
            ELSE 'unmatched_ignored' END AS outcome
FROM latest c LEFT JOIN tk ON tk.id = c.id""")
def merge_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every latest change (op x matched) and the target rows it touches (M5)."""
    from ..operators.merge import classify_changes
    return classify_changes(fx.origin_o(spark, sf_dir), latest_per_key(fx.stage_o(spark, sf_dir)))
