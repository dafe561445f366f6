"""Reading tables and cutting lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import prepare, work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and still there if an executor is lost."""
    place = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def arrow_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 16) -> None:
    """Bound the batches that go to Python, as a text may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
