"""The eleven panels: a rollup joined to its dimension's name, as a sorted series, a top ten or a ratio."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import ratio
from tradewind.operators.keyed import newest_by_key
from tradewind.plans.rollups import DIMENSION_OF, ROLLUPS, Rollup

TOP_N = 10
LABEL = {"products": "product_name", "sellers": "username", "customers": "username"}


@dataclass(frozen=True)
class Panel:
    """``top`` names the measure of a top list; a panel without it is a time series. ``hidden`` series are dropped."""

    name: str
    rollup: str
    top: str | None = None
    hidden: tuple[str, ...] = ()

    @property
    def spec(self) -> Rollup:
        return ROLLUPS[self.rollup]

    @property
    def dimension(self) -> str:
        return DIMENSION_OF[self.spec.key]


PANELS: dict[str, Panel] = {p.name: p for p in (
    Panel("dash_daily_sales_by_product", "daily_sales_by_product"),
    # The line chart of that panel draws the amount only.
    Panel("dash_daily_product_amount", "daily_sales_by_product", hidden=("total_quantity",)),
    Panel("dash_daily_sales_by_seller", "daily_sales_by_seller"),
    Panel("dash_daily_sales_by_customer", "daily_sales_by_customer"),
    Panel("dash_monthly_sales_by_product", "monthly_sales_by_product"),
    Panel("dash_monthly_sales_by_seller", "monthly_sales_by_seller"),
    Panel("dash_monthly_sales_by_customer", "monthly_sales_by_customer"),
    Panel("dash_top_products_by_quantity", "units_by_product", top="total_quantity_sold"),
    Panel("dash_top_customers_by_amount", "spend_by_customer", top="total_amount_spent"),
    Panel("dash_top_sellers_by_revenue", "revenue_by_seller", top="total_revenue"),
    Panel("dash_top_sellers_by_quantity", "units_by_seller", top="total_quantity_sold"),
)}


def names(dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Newest name per key: the warehouse keeps every load of a dimension row."""
    recency = [c for c in ("batch_time", "updated_at") if c in dimension.columns]
    return newest_by_key(dimension.select(key, label, *recency), key, *recency).select(key, label)


def panel(rollup: DataFrame, view: Panel, dimension: DataFrame, since: date | None = None) -> DataFrame:
    """A panel over its rollup, freshly built or read from the store.

    The join comes before the limit: an inner join may drop a key, so an earlier cut could lose a row.
    """
    spec, label = view.spec, LABEL[view.dimension]
    rows = rollup
    if since is not None and spec.period:
        rows = rows.where(F.col(spec.period_column) >= F.lit(since))
    rows = rows.join(names(dimension, spec.key, label), spec.key, "inner")
    if view.top:
        # The id breaks ties, so that the cut is the same on every run.
        return rows.orderBy(F.desc(view.top), spec.key).limit(TOP_N).select(label, view.top)
    shown = [m for m in spec.measures if m not in view.hidden]
    return rows.orderBy(spec.period_column, label, spec.key).select(spec.period_column, label, *shown)


def average_check(totals: DataFrame) -> DataFrame:
    """Revenue per sale; the gauge shows the last value that is not null, and null when nothing was sold."""
    value = ratio(F.col("total_revenue"), F.col("total_sales_count"))
    return totals.select(value.alias("average_check")).agg(F.last("average_check", ignorenulls=True).alias("average_check"))
