"""Small tables for operator tests."""

from datetime import datetime
from decimal import Decimal

FACT = ("sale_id long, customer_id long, product_id long, seller_id long, sale_date timestamp, quantity int, "
        "total_amount decimal(18,2)")
PRODUCT = ("product_id long, product_name string, product_description string, price decimal(18,2), seller_id long, "
           "created_at timestamp, updated_at timestamp, category string")


def ts(day: int, hour: int = 0, minute: int = 0, second: int = 0, month: int = 1) -> datetime:
    return datetime(2024, month, day, hour, minute, second)


def sales(spark, *rows):
    """Rows: (sale, customer, product, seller, time, quantity, amount)."""
    return spark.createDataFrame([(*r[:6], Decimal(r[6])) for r in rows], FACT)


def ids(spark, name: str, *values):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


def dims(spark, customers=(1, 2), products=(1, 2), sellers=(1, 2)):
    return {"customers": ids(spark, "customer_id", *customers), "products": ids(spark, "product_id", *products),
            "sellers": ids(spark, "seller_id", *sellers)}


def product(number: int, category: str, name: str | None = None, price: str = "10.00", seller: int = 1, created=None,
            updated=None):
    return (number, name or f"p{number}", f"about {number}", Decimal(price), seller, created or ts(1),
            updated or ts(1), category)


def rows(df, *columns):
    """Rows as a sorted list of tuples; sorted by text, since nulls do not compare."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
