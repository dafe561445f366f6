"""Price and seller of a purchase, looked up in the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import UNKNOWN_PRICE, line_amount
from tradewind.operators.keyed import absent_from, newest_by_key, own_shuffle
from tradewind.schemas import MONEY


def newest_products(products: DataFrame, *columns: str) -> DataFrame:
    """Unique lookup side: the catalogue may hold several loads of a product."""
    recency = [c for c in ("batch_time", "updated_at") if c in products.columns]
    rows = newest_by_key(products.select("product_id", *columns, *recency), "product_id", *recency)
    return own_shuffle(rows.select("product_id", *columns), "product_id")


def enrich(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases of known products, with the product's price and seller.

    No broadcast hint: the catalogue grows with the business, so its measured size decides the join.
    """
    return purchases.join(newest_products(products, "price", "seller_id"), "product_id", "inner")


def unknown_products(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """The refused side of :func:`enrich`."""
    return absent_from(purchases, products, "product_id")


def price_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """``total_amount`` from the product's price, or from the fixed price when the product is unknown."""
    price = F.coalesce(F.col("price"), F.lit(UNKNOWN_PRICE).cast(MONEY))
    return (sales.join(newest_products(products, "price"), "product_id", "left").withColumn("price", price)
            .withColumn("total_amount", line_amount(F.col("price"), F.col("quantity"))))
