"""The purchase gate of a stream: every request is decided once, and keeps its decision and its id for good.

A micro-batch of requests is joined with sessions, users and products as they are then, accepted requests are numbered from above the
last id given out, and all that is written down before anything is published. A batch that runs again, after a crash or in a new
session, finds its decisions and publishes them again, unchanged, however the tables have changed in between.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.access import OK
from tradewind.plans.purchases import accepted_purchases, purchase_outcomes, refused_requests
from tradewind.schemas import MONEY
from tradewind.sources import folded

DECISION = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("session_token", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()), T.StructField("quantity", T.IntegerType()), T.StructField("ts", T.TimestampType()),
    T.StructField("price", MONEY), T.StructField("seller_id", T.LongType()), T.StructField("status", T.IntegerType()),
    T.StructField("sell_id", T.LongType())])
ID_RANGE = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("first_id", T.LongType()),
                         T.StructField("last_id", T.LongType())])


@dataclass(frozen=True)
class PurchaseGate:
    """``tables`` gives sessions, users and products as they are when it is called. Decisions and id ranges go below ``root``.

    Ids begin at ``base_ms * 1000``, or above ``highest``, the greatest id given out by others.
    """

    root: str
    tables: Callable[[], tuple[DataFrame, DataFrame, DataFrame]]
    base_ms: int
    highest: int | None = None

    def purchases(self, requests: DataFrame, batch_id: int) -> DataFrame:
        """Accepted requests of a micro-batch as purchases: what ``jobs.publish_stream`` takes as its gate."""
        decided = self._decided(requests, batch_id)
        return decided.where(F.col("status") == OK).withColumn("customer_id", F.col("user_id"))

    def _decided(self, requests: DataFrame, batch_id: int) -> DataFrame:
        spark = requests.sparkSession
        if not folded.has(spark, f"{self.root}/decisions", batch_id):
            self._decide(requests, batch_id)
        decided = folded.read_batch(spark, f"{self.root}/decisions", batch_id, DECISION)
        # Written after the decisions, and from them, so that a range that a crash kept from being recorded is recorded now.
        if not folded.has(spark, f"{self.root}/ids", batch_id):
            used = decided.agg(F.lit(batch_id).cast("long").alias("batch_id"), F.min("sell_id").alias("first_id"),
                               F.max("sell_id").alias("last_id"))
            folded.write(used, f"{self.root}/ids", batch_id)
        return decided

    def _decide(self, requests: DataFrame, batch_id: int) -> None:
        outcomes = purchase_outcomes(requests, *self.tables()).persist()
        try:
            taken = accepted_purchases(outcomes, self.base_ms, ["request_id"], self._last_id(requests.sparkSession, batch_id))
            rows = taken.unionByName(refused_requests(outcomes), allowMissingColumns=True)
            folded.write(rows.select(*[F.col(f.name).cast(f.dataType) for f in DECISION.fields]), f"{self.root}/decisions", batch_id)
        finally:
            outcomes.unpersist()

    def _last_id(self, spark: SparkSession, batch_id: int) -> int | None:
        """The greatest id of the batches before this one. Its own record, if it left one, doesn't count."""
        before = self.id_ranges(spark).where(F.col("batch_id") < batch_id).agg(F.max("last_id")).first()[0]
        return max((x for x in (before, self.highest) if x is not None), default=None)

    def id_ranges(self, spark: SparkSession) -> DataFrame:
        """The ids that each batch gave out; null for a batch that accepted nothing."""
        return folded.read(spark, f"{self.root}/ids", ID_RANGE)

    def decisions(self, spark: SparkSession) -> DataFrame:
        """All requests so far with their status, and the id of the accepted ones."""
        return folded.read(spark, f"{self.root}/decisions", DECISION)

    def fold(self, spark: SparkSession, before: int) -> None:
        """Fold decisions and ranges of the batches below ``before``; the newest batch may run again and stays as it is."""
        for name, schema in (("decisions", DECISION), ("ids", ID_RANGE)):
            folded.prune(spark, f"{self.root}/{name}")
            folded.fold(spark, f"{self.root}/{name}", schema, before - 1)
