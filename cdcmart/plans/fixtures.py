"""Stand-in inputs built from the driver's test tables.

These functions only shape rows into the schemas the jobs expect (the retail
row, the product-demand row); they do none of the jobs' work. The same
definitions exist as SQL text (``FIXTURE_SQL``) for the DuckDB oracle.

* ``origin_o`` / ``stage_o``: a large target (orders) and a change feed
  (events) with two changes per id, three quarters of change ids matching.
* ``origin_e`` / ``stage_e``: both dated January 2024 (events), for daily
  slices and the replay; four changes per id, a third of change ids have no
  origin row (those origin rows carry negative ids).
* ``demand``: product demand per shop and ship date (lineitem x part), with a
  NULL tier, an unknown tier and a NULL shop present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _op_from_event_type() -> Column:
    t = F.col("event_type")
    return (F.when(t == "signup", "I").when(t == "error", "D")
             .when(t == "purchase", "U").when(t == "click", "U").otherwise("X"))


def _event_row(id_col: Column, prefix: str, operation: Column) -> list[Column]:
    return [
        id_col.cast("int").alias("id"),
        F.concat(F.lit(prefix), F.col("event_id").cast("string")).alias("invoice"),
        F.col("event_type").alias("stockcode"),
        F.col("props").alias("description"),
        (F.col("event_id") % 2000 - 1000).cast("int").alias("quantity"),
        F.col("ts").alias("invoicedate"),
        F.col("value").alias("price"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("country"),
        F.col("ts").alias("last_updated"),
        operation.alias("operation"),
    ]


def origin_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("int").alias("id"),
        F.concat(F.lit("INV"), F.col("o_orderkey").cast("string")).alias("invoice"),
        F.col("o_orderstatus").alias("stockcode"),
        F.col("o_orderpriority").alias("description"),
        (F.col("o_orderkey") % 2000 - 1000).cast("int").alias("quantity"),
        F.col("o_orderdate").alias("invoicedate"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("country"),
        F.col("o_orderdate").alias("last_updated"),
        F.lit(None).cast("string").alias("operation"),
    )


def stage_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(*_event_row(F.floor(F.col("event_id") / 2) * 4, "CHG", _op_from_event_type()))


def origin_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ev = F.col("event_id")
    id_col = F.when(ev % 3 != 0, ev).otherwise(-ev - 1)
    return e.select(*_event_row(id_col, "INV", F.lit(None).cast("string")))


def stage_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ev = F.col("event_id")
    return e.select(*_event_row(ev - ev % 4 + 1, "CHG", _op_from_event_type()))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    t = F.col("p_type")
    tier = (F.when(t == "ECONOMY", "cheap").when(t == "STANDARD", "medium")
             .when(t == "MEDIUM", "medium").when(t == "PROMO", "expensive")
             .when(t == "SMALL", F.lit(None)).otherwise(t))
    shop = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    return (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
              .select(F.when(shop != "S0", shop).alias("shop_id"),
                      F.col("l_shipdate").alias("date"),
                      tier.alias("product_name"),
                      F.col("l_quantity").cast("string").alias("demand")))


# The same inputs as SQL (DuckDB and Spark SQL both run this text).
FIXTURE_SQL = {
    "origin_o": """origin_o AS (SELECT cast(o_orderkey AS int) id, concat('INV', cast(o_orderkey AS varchar)) invoice,
  o_orderstatus stockcode, o_orderpriority description, cast(o_orderkey % 2000 - 1000 AS int) quantity,
  o_orderdate invoicedate, o_totalprice price, cast(o_custkey AS varchar) customer_id,
  concat('NATION_', cast(o_custkey % 25 AS varchar)) country, o_orderdate last_updated,
  cast(NULL AS varchar) operation FROM orders)""",
    "stage_o": """stage_o AS (SELECT cast(floor(event_id/2)*4 AS int) id, concat('CHG', cast(event_id AS varchar)) invoice,
  event_type stockcode, props description, cast(event_id % 2000 - 1000 AS int) quantity, ts invoicedate,
  value price, cast(user_id AS varchar) customer_id, concat('NATION_', cast(user_id % 25 AS varchar)) country,
  ts last_updated, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'purchase' THEN 'U'
  WHEN 'click' THEN 'U' ELSE 'X' END operation FROM events)""",
    "origin_e": """origin_e AS (SELECT cast(CASE WHEN event_id % 3 <> 0 THEN event_id ELSE -event_id - 1 END AS int) id,
  concat('INV', cast(event_id AS varchar)) invoice,
  event_type stockcode, props description, cast(event_id % 2000 - 1000 AS int) quantity, ts invoicedate,
  value price, cast(user_id AS varchar) customer_id, concat('NATION_', cast(user_id % 25 AS varchar)) country,
  ts last_updated, cast(NULL AS varchar) operation FROM events)""",
    "stage_e": """stage_e AS (SELECT cast(event_id - event_id % 4 + 1 AS int) id, concat('CHG', cast(event_id AS varchar)) invoice,
  event_type stockcode, props description, cast(event_id % 2000 - 1000 AS int) quantity, ts invoicedate,
  value price, cast(user_id AS varchar) customer_id, concat('NATION_', cast(user_id % 25 AS varchar)) country,
  ts last_updated, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'purchase' THEN 'U'
  WHEN 'click' THEN 'U' ELSE 'X' END operation FROM events)""",
    "demand": """demand AS (SELECT nullif(concat('S', cast(l_suppkey AS varchar)), 'S0') shop_id, l_shipdate date,
  CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'STANDARD' THEN 'medium' WHEN 'MEDIUM' THEN 'medium'
  WHEN 'PROMO' THEN 'expensive' WHEN 'SMALL' THEN NULL ELSE p_type END product_name,
  cast(l_quantity AS varchar) demand FROM lineitem JOIN part ON l_partkey = p_partkey)""",
}


def with_fixtures(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for the given fixture names."""
    return "WITH " + ",\n".join(FIXTURE_SQL[n] for n in names)
