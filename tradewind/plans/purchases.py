"""The gate of the purchase path: session, role, product, id. Accepted and refused requests are all requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.ids import assign_ids
from tradewind.operators.access import BAD_PRODUCT, OK, authorise
from tradewind.operators.enrich import newest_products


def purchase_outcomes(requests: DataFrame, sessions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Purchase requests (``session_token``, ``product_id``) with user, status, and the product's price and seller.

    401 without a session, 404 without a user, 403 for a user who is no customer, 400 for an unknown product, else 200.
    """
    checked = authorise(requests.withColumn("needed_role", F.lit("customer")), sessions, users).drop("needed_role")
    known = newest_products(products, "price", "seller_id").withColumn("_known", F.lit(True))
    joined = checked.join(known, "product_id", "left")
    status = F.when((F.col("status") == OK) & F.col("_known").isNull(), BAD_PRODUCT).otherwise(F.col("status"))
    return joined.withColumn("status", status).drop("_known")


def accepted_purchases(outcomes: DataFrame, base_ms: int, order: list[str], highest: int | None = None) -> DataFrame:
    """Accepted requests as purchases, numbered above the highest sale so far."""
    taken = outcomes.where(F.col("status") == OK).withColumn("customer_id", F.col("user_id"))
    return assign_ids(taken, base_ms, order, "sell_id", highest)


def refused_requests(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") != OK)
