"""The wire format of a purchase: one flat JSON object per message."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import EPOCH, at, line_amount, missing_names, whole_second
from tradewind.schemas import FACT_SALES, MONEY

# Field order of a produced message, and the fields a consumer needs (fixed values).
PRODUCED = ("customer_id", "product_id", "sell_id", "price", "seller_id", "quantity")
REQUIRED = ("sell_id", "customer_id", "product_id", "seller_id", "quantity")
_KINDS = {"sell_id": T.LongType(), "customer_id": T.LongType(), "product_id": T.LongType(),
          "seller_id": T.LongType(), "quantity": T.IntegerType(),
          # Not required on read: kept as text, so that a broken price cannot fail a message.
          "price": T.StringType()}
MALFORMED, INCOMPLETE = "malformed", "missing_fields"


def to_messages(purchases: DataFrame, time_column: str = "ts") -> DataFrame:
    """Messages as a Kafka sink takes them: a key that keeps a sale's messages in order, and the JSON value."""
    return purchases.select(F.col("sell_id").cast("string").alias("key"),
                            F.to_json(F.struct(*PRODUCED)).alias("value"),
                            F.col(time_column).alias("timestamp"))


def parse(messages: DataFrame) -> DataFrame:
    """Decode and check messages (``value``, ``timestamp``); ``reason`` is null for a good one.

    The text is parsed as the only element of an array: that refuses what a strict JSON reader refuses, such as
    an object followed by something else. Absent, null and wrongly typed fields are reported alike.
    """
    schema = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in _KINDS.items()]))
    text = F.col("value").cast("string")
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), schema)
    # Exploding is a barrier: the text is parsed once per message, however many columns are derived from it.
    one = F.explode_outer(F.when(F.size("_parsed") == 1, F.col("_parsed")))
    fields = {n: F.col(f"_one.{n}") for n in _KINDS}
    reason: Column = (F.when(F.col("_one").isNull(), MALFORMED)
                      .when(F.size("missing_fields") > 0, INCOMPLETE))
    return (messages.select(text.alias("value"), "timestamp", parsed.alias("_parsed"))
            .select("value", "timestamp", one.alias("_one"))
            .select("value", "timestamp", "_one", *[c.alias(n) for n, c in fields.items() if n != "price"],
                    fields["price"].try_cast(MONEY).alias("price"))
            .withColumn("missing_fields", F.when(F.col("_one").isNotNull(),
                                                 missing_names({n: F.col(n) for n in REQUIRED})))
            .withColumn("reason", reason).drop("_one"))


def message_key() -> Column:
    """What makes a parsed message the same as another: the sale id of a good one, the text of any other."""
    return (F.when(F.col("reason").isNull(), F.concat(F.lit("sale "), F.col("sell_id").cast("string")))
            .otherwise(F.concat(F.lit("text "), F.coalesce("value", F.lit("")))))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """Dead letters: the text as it came, why it was refused, and which fields were missing."""
    return (parsed.where(F.col("reason").isNotNull())
            .select("value", "timestamp", "reason", F.array_join("missing_fields", ",").alias("missing_fields")))


def to_fact(good: DataFrame, batch_time: datetime | Column, reference_defaults: bool = False) -> DataFrame:
    """Fact rows of accepted messages.

    The sale happened at the message time and cost ``price * quantity``. With ``reference_defaults`` only the five
    required fields are stored: sale time and batch time are the epoch, the amount is zero.
    """
    stamp = at(batch_time) if isinstance(batch_time, datetime) else batch_time
    if reference_defaults:
        sale_date, amount, stamp = at(EPOCH), F.lit(0), at(EPOCH)
    else:
        sale_date = whole_second("timestamp")
        amount = F.coalesce(line_amount(F.col("price"), F.col("quantity")), F.lit(0))
    made = good.select(F.col("sell_id").alias("sale_id"), "customer_id", "product_id", "seller_id",
                       sale_date.alias("sale_date"), "quantity", amount.alias("total_amount"),
                       stamp.alias("batch_time"))
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SALES.fields])
