"""Sale and product ids: epoch milliseconds times 1000, plus a position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import shared_dir

# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
ROW_BITS = 33


def number_rows(rows: DataFrame, first: int, order: list[str], name: str) -> DataFrame:
    """Number the rows ``first, first + 1, ...`` in the given order.

    No window runs over the rows: they are range-partitioned and sorted, checkpointed (both passes below must see the
    same partitions, also after an executor is lost) and counted per partition; each partition then starts where the
    one before it ends. List a unique column last in ``order``, so that equal leading values can be spread over
    several partitions.
    """
    shared_dir(rows.sparkSession)  # checkpoint() needs the folder
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pos", F.monotonically_increasing_id()).checkpoint())
    placed = placed.withColumn("_slot", F.shiftright("_pos", ROW_BITS))
    sizes = placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"))
    # `sizes` has one row per partition, which is what bounds both this window and the broadcast.
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    row = F.col("_pos") - F.shiftleft("_slot", ROW_BITS)
    return (placed.join(F.broadcast(starts), "_slot")
            .withColumn(name, F.lit(first).cast("long") + F.col("_start") + row)
            .drop("_slot", "_pos", "_start"))


def assign_ids(requests: DataFrame, base_ms: int, order: list[str], name: str, highest: int | None = None) -> DataFrame:
    """Ids of one batch of requests, from ``base_ms * 1000`` on, or from above ``highest``, the greatest id given out so far.

    Rows of a batch share a millisecond, so a random suffix would collide; a run of n rows takes n/1000 ms of the id
    space instead, which a batch soon after it must not enter.
    """
    return number_rows(requests, max(base_ms * 1000, -1 if highest is None else highest + 1), order, name)


def highest_id(table: DataFrame, key: str) -> int | None:
    """The greatest id in a table: one value, from partial maxima."""
    return table.agg(F.max(key)).first()[0]
