"""Seeded sample data: customers, sellers, products and sales, generated in parallel."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import at, draw
from tradewind.operators.enrich import price_sales
from tradewind.schemas import MONEY

# Value rules of the sample (fixed values).
CATEGORIES = ("Electronics", "Clothing", "Books", "Home", "Toys")
DAYS = 60
LOWEST_CENTS, HIGHEST_CENTS = 500, 100_000
MOST_UNITS = 5
SIZES = {"customers": 100, "sellers": 20, "products": 200, "sales": 10_000}


def _pick(row: Column, seed: int, stream: str, upper: int) -> Column:
    return draw(row, seed, stream, F.lit(upper))


def _times(row: Column, seed: int, table: str, end: datetime) -> tuple[Column, Column]:
    """Created within the last days before ``end``; updated between then and ``end``."""
    span = DAYS * 86_400
    age = _pick(row, seed, f"{table}.created", span) + 1
    last = F.unix_seconds(at(end))
    changed = draw(row, seed, f"{table}.updated", age)
    return F.timestamp_seconds(last - age), F.timestamp_seconds(last - age + changed)


def _accounts(spark: SparkSession, table: str, key: str, count: int, seed: int, end: datetime, suffix: str) -> DataFrame:
    row = F.col("id")
    created, updated = _times(row, seed, table, end)
    name = F.concat(F.lit("user"), _pick(row, seed, f"{table}.name", max(count, 1)).cast("string"), F.lit(suffix))
    return spark.range(1, count + 1).select(row.alias(key), name.alias("username"), created.alias("created_at"),
                                            updated.alias("updated_at"))


def customers(spark: SparkSession, count: int, seed: int, end: datetime) -> DataFrame:
    return _accounts(spark, "customers", "customer_id", count, seed, end, "")


def sellers(spark: SparkSession, count: int, seed: int, end: datetime) -> DataFrame:
    return _accounts(spark, "sellers", "seller_id", count, seed, end, " Seller")


def products(spark: SparkSession, count: int, sellers_count: int, seed: int, end: datetime) -> DataFrame:
    row = F.col("id")
    created, updated = _times(row, seed, "products", end)
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]),
                            (_pick(row, seed, "category", len(CATEGORIES)) + 1).cast("int"))
    cents = _pick(row, seed, "price", HIGHEST_CENTS - LOWEST_CENTS + 1) + LOWEST_CENTS
    return spark.range(1, count + 1).select(
        row.alias("product_id"), F.concat(F.lit("product "), row.cast("string")).alias("product_name"),
        F.concat(F.lit("sample description "), row.cast("string")).alias("product_description"),
        category.alias("category"), (cents.cast("decimal(18,0)") / 100).cast(MONEY).alias("price"),
        (_pick(row, seed, "seller", sellers_count) + 1).alias("seller_id"),
        created.alias("created_at"), updated.alias("updated_at"))


def sales(spark: SparkSession, count: int, customers_count: int, sellers_count: int, catalogue: DataFrame,
          products_count: int, seed: int, end: datetime) -> DataFrame:
    """Sales with independently drawn customer, product and seller, priced from the catalogue."""
    row = F.col("id")
    sold = F.unix_seconds(at(end)) - _pick(row, seed, "sold", DAYS * 86_400) - 1
    drawn = spark.range(1, count + 1).select(
        row.alias("sale_id"), (_pick(row, seed, "sale.customer", customers_count) + 1).alias("customer_id"),
        (_pick(row, seed, "sale.product", products_count) + 1).alias("product_id"),
        (_pick(row, seed, "sale.seller", sellers_count) + 1).alias("seller_id"),
        F.timestamp_seconds(sold).alias("sale_date"),
        (_pick(row, seed, "quantity", MOST_UNITS) + 1).cast("int").alias("quantity"))
    return (price_sales(drawn, catalogue)
            .select("sale_id", "customer_id", "product_id", "seller_id", "sale_date", "quantity", "total_amount"))
