"""Column expressions shared by the jobs. All are Spark built-ins, so they stay inside generated code."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.schemas import MONEY

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Price of a sale whose product is unknown (fixed value).
UNKNOWN_PRICE = "50.00"


def at(moment: datetime) -> Column:
    """Typed timestamp literal; a moment without a zone is taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(round((moment - EPOCH).total_seconds() * 1_000_000)))


def day(ts: Column | str) -> Column:
    return F.to_date(ts)


def month(ts: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(ts, "MM")


def whole_second(ts: Column | str) -> Column:
    return F.date_trunc("second", ts)


def money(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def line_amount(price: Column, quantity: Column) -> Column:
    """``round(price * quantity, 2)`` in decimal arithmetic, so sums do not depend on their order."""
    return F.round(price * quantity.cast("decimal(10,0)"), 2).cast(MONEY)


def or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ratio(total: Column, count: Column) -> Column:
    """Division that gives null for an empty count, to six decimals."""
    return F.try_divide(total, count).cast("decimal(28,6)")


def missing_names(present: dict[str, Column]) -> Column:
    """Names of the columns that are null, as an array in the given order."""
    flags = [F.when(column.isNull(), F.lit(name)) for name, column in present.items()]
    return F.array_compact(F.array(*flags))


def draw(row: Column, seed: int, stream: str, upper: Column) -> Column:
    """Reproducible draw from ``0 .. upper-1``: a hash of the row number, so it does not depend on partitioning."""
    return F.pmod(F.xxhash64(row, F.lit(seed), F.lit(stream)), upper.cast("long"))
