"""Fixed schemas and the configured quality checks of the retail and demand tables.

Column names are lower case (PostgreSQL folds unquoted identifiers).
Types follow the source DDL: INT -> int, VARCHAR(n) -> string with a length
limit, FLOAT -> double, TIMESTAMP without zone -> timestamp_ntz, char(1) -> string.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The retail row, in stored column order.
RETAIL_COLUMNS = (
    "id", "invoice", "stockcode", "description", "quantity", "invoicedate",
    "price", "customer_id", "country", "last_updated", "operation",
)
# The 10-column form has no ``operation``.
RETAIL_COLUMNS_NO_OP = RETAIL_COLUMNS[:-1]

RETAIL_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("invoice", T.StringType()),
    T.StructField("stockcode", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoicedate", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("last_updated", T.TimestampNTZType()),
    T.StructField("operation", T.StringType()),
])

# VARCHAR(100) / char(1) limits of the retail DDL.
RETAIL_LENGTHS = {
    "invoice": 100, "stockcode": 100, "description": 100,
    "customer_id": 100, "country": 100, "operation": 1,
}

# Operation codes.
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"

DEMAND_SCHEMA = T.StructType([
    T.StructField("shop_id", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("demand", T.StringType()),
])

# Mart with grams per material (date kept as timestamp).
MATERIAL_G_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("shop_id", T.StringType()),
    T.StructField("material_name", T.StringType()),
    T.StructField("quantity_g", T.DecimalType(38, 4)),
])
# Mart with kilograms per raw material (date column is DATE).
MATERIAL_KG_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("shop_id", T.StringType()),
    T.StructField("raw_material", T.StringType()),
    T.StructField("demand_kg", T.DecimalType(38, 7)),
])

# Checks configured on the merged retail table.
RETAIL_CHECKS = {
    "id": {"null_check": {"equal_to": 0, "tolerance": 0}},
    "quantity": {
        "null_check": {"equal_to": 0},
        "min": {"geq_to": -1012},
    },
}
