"""Declared schemas. Ids are LONG, money is DECIMAL(18,2), times are whole seconds in UTC."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# What Spark gives for a sum of MONEY; stored totals use the same type.
MONEY_TOTAL = T.DecimalType(28, 2)


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_ID, _INT, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()

CUSTOMERS = _schema(
    ("customer_id", _ID, True), ("username", _TEXT, True), ("created_at", _TIME, True),
    ("updated_at", _TIME, True), ("batch_time", _TIME, True),
)
SELLERS = _schema(
    ("seller_id", _ID, True), ("username", _TEXT, True), ("created_at", _TIME, True),
    ("updated_at", _TIME, True), ("batch_time", _TIME, True),
)
# Lake table; `category` is the partition column and therefore last.
CATALOGUE = _schema(
    ("product_id", _ID, False), ("product_name", _TEXT, False), ("product_description", _TEXT, True),
    ("price", MONEY, False), ("seller_id", _ID, False), ("created_at", _TIME, True),
    ("updated_at", _TIME, True), ("category", _TEXT, True),
)
PRODUCTS = _schema(
    ("product_id", _ID, True), ("product_name", _TEXT, True), ("product_description", _TEXT, True),
    ("category", _TEXT, True), ("price", MONEY, True), ("seller_id", _ID, True), ("created_at", _TIME, True),
    ("updated_at", _TIME, True), ("batch_time", _TIME, True),
)
FACT_SALES = _schema(
    ("sale_id", _ID, True), ("customer_id", _ID, True), ("product_id", _ID, True), ("seller_id", _ID, True),
    ("sale_date", _TIME, True), ("quantity", _INT, True), ("total_amount", MONEY, True), ("batch_time", _TIME, True),
)
# One row per group of any rollup; `rollup` names it.
ROLLUP_STATE = _schema(
    ("period", T.DateType(), True), ("key_id", _ID, True), ("total_quantity", _ID, True),
    ("total_amount", MONEY_TOTAL, True), ("sales_count", _ID, True), ("rollup", _TEXT, True),
)

# Storage order of the warehouse tables (their leading sort columns).
SORT_KEYS = {
    "customers": ("batch_time", "customer_id"),
    "sellers": ("batch_time", "seller_id"),
    "products": ("batch_time", "product_id"),
    "fact_sales": ("batch_time", "sale_id"),
}
WAREHOUSE = {"customers": CUSTOMERS, "sellers": SELLERS, "products": PRODUCTS, "fact_sales": FACT_SALES}
