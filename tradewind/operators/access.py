"""Who may do what: token -> session -> user -> role, and product ownership.

Every request keeps its row and gets a status code, so accepted plus refused is always the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.keyed import newest_by_key, own_shuffle

# Status codes (fixed values).
OK, NO_SESSION, FORBIDDEN, NOT_FOUND, BAD_PRODUCT = 200, 401, 403, 404, 400
ROLES = ("seller", "customer")


def authorise(requests: DataFrame, sessions: DataFrame, users: DataFrame, active_only: bool = False) -> DataFrame:
    """Add ``user_id``, ``user_role`` and ``status`` to requests that carry ``session_token`` and ``needed_role``.

    A known token is enough unless ``active_only``, which also asks that the session has not ended. Tokens and
    user ids are primary keys, so neither join can multiply rows; both keep the request side whole, which is the
    side adaptive execution may split when one token or user is hot.
    """
    live = sessions.where(F.col("session_end").isNull()) if active_only else sessions
    tokens = own_shuffle(live.select("session_token", "user_id"), "session_token")
    roles = own_shuffle(users.select("user_id", "user_role"), "user_id")
    status = (F.when(F.col("user_id").isNull(), NO_SESSION)
              .when(F.col("user_role").isNull(), NOT_FOUND)
              .when(F.col("user_role") != F.col("needed_role"), FORBIDDEN)
              .otherwise(OK))
    return (requests.join(tokens, "session_token", "left").join(roles, "user_id", "left")
            .withColumn("status", status))


def own_product(authorised: DataFrame, products: DataFrame) -> DataFrame:
    """Refine the status of edit requests: the product must exist and belong to the user.

    The product's columns come along as ``old_*`` for the merge of the edit over the stored row.
    """
    newest = own_shuffle(newest_by_key(products, "product_id", "updated_at"), "product_id")
    stored = newest.select("product_id", *[F.col(c).alias(f"old_{c}") for c in products.columns if c != "product_id"])
    status = (F.when(F.col("status") != OK, F.col("status"))
              .when(F.col("old_seller_id").isNull(), NOT_FOUND)
              .when(F.col("old_seller_id") != F.col("user_id"), FORBIDDEN)
              .otherwise(OK))
    return authorised.join(stored, "product_id", "left").withColumn("status", status)


def valid_role(column: str = "user_role"):
    return F.col(column).isin(*ROLES)
