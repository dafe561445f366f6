"""Keys of the warehouse's dimensions, stored by bucket, for readers that ask for a few of them at a time.

    <root>/<table>/...     a table of batches (``sources.folded``), one for each load of the dimension, divided by bucket of the key

A micro-batch reads the buckets that its own keys fall into, and nothing else of a dimension: the numbers of these buckets, at most as
many as there are, go into the scan as a partition filter. A key is stored once, whatever number of loads or rows it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.keyed import absent_from
from tradewind.plans.rollups import DIMENSION_OF
from tradewind.schemas import WAREHOUSE
from tradewind.sources import folded

BUCKET = "bucket"


@dataclass(frozen=True)
class DimensionKeys:
    """Keys of the dimensions in ``warehouse``, below ``root``.

    ``buckets`` stays the same for as long as the folder is used. More of them let a small batch read less; a batch with many more
    keys than buckets reads them all, as it must. One process writes the keys: the stream that asks for them.
    """

    root: str
    warehouse: str
    buckets: int = 1024

    def bucket(self, key: str) -> Column:
        return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(self.buckets)).cast("int"))

    def catch_up(self, spark: SparkSession) -> None:
        """Take in the loads that came since the last call; if there are none, this only lists folders.

        A load is taken in as a whole or not at all, so a run that stops is made good by the next one.
        """
        for key, table in DIMENSION_OF.items():
            source, root = f"{self.warehouse}/{table}", f"{self.root}/{table}"
            newest, have = folded.last(spark, source), folded.last(spark, root)
            if newest is None or newest == have:
                continue
            # A compacted table gives earlier loads again; their keys are known.
            loads = spark.read.schema(WAREHOUSE[table]).parquet(*folded.paths_after(spark, source, have))
            keys = loads.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull()).distinct()
            new = keys if have is None else absent_from(keys, self.read(spark, key), key)
            placed = new.withColumn(BUCKET, self.bucket(key)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, key)
            folded.prune(spark, root)
            folded.write(placed, root, newest, by=BUCKET)
            folded.fold(spark, root, self._schema(key), newest - 1, by=BUCKET,
                        shape=lambda rows, key=key: rows.sortWithinPartitions(BUCKET, key))

    def _schema(self, key: str) -> T.StructType:
        return T.StructType([T.StructField(key, T.LongType()), T.StructField(BUCKET, T.IntegerType())])

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        """All keys of a dimension, with their buckets."""
        return folded.read(spark, f"{self.root}/{DIMENSION_OF[key]}", self._schema(key), by=BUCKET)

    def met(self, rows: DataFrame) -> dict[str, DataFrame]:
        """Of each dimension the keys that ``rows`` have and that are known now. ``rows`` are read twice, so persist them first."""
        spark = rows.sparkSession
        self.catch_up(spark)
        touched = rows.agg(*[F.collect_set(self.bucket(key)).alias(key) for key in DIMENSION_OF]).first()
        found = {}
        for key, table in DIMENSION_OF.items():
            near = self.read(spark, key).where(F.col(BUCKET).isin(sorted(touched[key]))).select(key)
            found[table] = near.join(rows.select(key).distinct(), key, "left_semi")
        return found
