"""Incremental dimension loads by high watermark, and the daily run made of them.

A warehouse table is a table of loads (``sources.folded``): each load has its own folder, compaction folds them into a new generation,
and loads, watermarks and panels all read what ``dimension`` gives: the newest generation and the loads after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import at
from tradewind.schemas import WAREHOUSE
from tradewind.sources import folded
from tradewind.sources.tables import conform, in_storage_order, newest_in_footers


@dataclass(frozen=True)
class Dimension:
    """What to load into a warehouse table: source columns, and how they are renamed."""

    table: str
    columns: tuple[str, ...]
    renamed: dict[str, str]


_ACCOUNT = ("id", "username", "created_at", "updated_at")
DIMENSIONS: dict[str, Dimension] = {d.table: d for d in (
    Dimension("customers", _ACCOUNT, {"id": "customer_id"}),
    Dimension("sellers", _ACCOUNT, {"id": "seller_id"}),
    Dimension("products", ("product_id", "product_name", "product_description", "category", "price", "seller_id",
                           "created_at", "updated_at"), {}),
)}


def new_rows(source: DataFrame, spec: Dimension, low: datetime, batch_time: datetime,
             changed_since: bool = False) -> DataFrame:
    """Rows created in ``(low, batch_time]``, renamed and stamped.

    The window is half-open and ``batch_time`` is fixed for the run, so consecutive runs neither lose nor repeat a
    row. Bounds are typed literals: they reach a Parquet or JDBC scan as pushed filters. ``changed_since`` tests
    ``updated_at`` instead, to load changed rows as well.
    """
    moment = F.col("updated_at" if changed_since else "created_at")
    picked = source.where((moment > at(low)) & (moment <= at(batch_time)))
    return (picked.select(*[F.col(c).alias(spec.renamed.get(c, c)) for c in spec.columns])
            .withColumn("batch_time", at(batch_time)))


def dimension(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A warehouse table as it is now; empty before the first load."""
    return folded.read(spark, f"{warehouse}/{table}", WAREHOUSE[table]).select(*WAREHOUSE[table].fieldNames())


def watermark(spark: SparkSession, warehouse: str, table: str) -> datetime:
    """The newest batch time of a warehouse table, from its files' footers."""
    return newest_in_footers(spark, folded.paths(spark, f"{warehouse}/{table}"), WAREHOUSE[table])


def add_load(rows: DataFrame, warehouse: str, table: str) -> int:
    """Add rows as the table's next load. A load that stops half-way is not read, and is replaced by the next one."""
    root = f"{warehouse}/{table}"
    newest = folded.last(rows.sparkSession, root)
    return folded.write(in_storage_order(conform(rows, table), table), root, 0 if newest is None else newest + 1)


def load(spark: SparkSession, source: DataFrame, spec: Dimension, warehouse: str, batch_time: datetime,
         changed_since: bool = False) -> int:
    """One sync: watermark, window, stamp, append. Returns the row count, taken from the write itself."""
    low = watermark(spark, warehouse, spec.table)
    return add_load(new_rows(source, spec, low, batch_time, changed_since), warehouse, spec.table)


def run_daily(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], warehouse: str,
              batch_time: datetime, compact: bool = False) -> dict[str, int]:
    """Accounts first, then products, all with one ``batch_time``. An error ends the run and propagates.

    With ``compact`` each table becomes one generation after its load.
    """
    counts = {}
    for table in ("customers", "sellers", "products"):
        counts[table] = load(spark, sources[table](), DIMENSIONS[table], warehouse, batch_time)
        if compact:
            compact_table(spark, warehouse, table)
    return counts


def compact_table(spark: SparkSession, warehouse: str, table: str, keep_replaced: bool = False) -> None:
    """Fold a warehouse table into a new generation of fewer files in storage order; the rows stay the same.

    The generation counts from the moment it is finished, for the next load and for readers alike. What it replaces is removed, unless
    readers that have planned already are to be spared: then the next compaction removes it.
    """
    root = f"{warehouse}/{table}"
    folded.prune(spark, root)
    folded.fold(spark, root, WAREHOUSE[table], whole=True, shape=lambda rows: in_storage_order(rows, table))
    if not keep_replaced:
        folded.prune(spark, root)
