"""Reads and writes that take the format as an argument: Parquet and JDBC here, a lake format where one is installed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import EPOCH
from tradewind.schemas import SORT_KEYS, WAREHOUSE
from tradewind.sources import files


def read_table(spark: SparkSession, fmt: str, location: str | None = None, **options: str) -> DataFrame:
    """Scan by format: a path, a catalogue name (``fmt="table"``) or a JDBC table (``dbtable`` in the options).

    Filters and columns asked of the result are pushed to the source by Spark. For a large JDBC table pass
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``; without them it is one task.
    """
    if fmt == "table":
        return spark.table(location)
    reader = spark.read.format(fmt).options(**options)
    return reader.load(location) if location else reader.load()


def jdbc_options(url: str, table: str, partition_by: str | None = None, bounds: tuple[int, int] | None = None,
                 partitions: int = 1, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **extra}
    if partition_by and bounds and partitions > 1:
        options |= {"partitionColumn": partition_by, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
                    "numPartitions": str(partitions)}
    return options


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows under a path that may not have been written yet."""
    if files.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def table_listed(spark: SparkSession, database: str, table: str) -> bool:
    """The same question asked of the catalogue's listing."""
    return not spark.sql(f"SHOW TABLES IN {database}").where(F.col("tableName") == table).isEmpty()


def conform(rows: DataFrame, table: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """Rows in the declared columns and types of a warehouse table.

    Columns the rows lack take a default: the epoch for times, zero for numbers, the empty text for strings (the
    column defaults of the warehouse), or what ``defaults`` gives. Columns the rows have keep their nulls.
    """
    given = set(rows.columns)
    return rows.select(*[(F.col(f.name).cast(f.dataType) if f.name in given else _default(f, defaults or {})).alias(f.name)
                         for f in WAREHOUSE[table].fields])


def _default(field: T.StructField, defaults: dict[str, object]) -> Column:
    if field.name in defaults:
        return F.lit(defaults[field.name]).cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_seconds(F.lit(0))
    return F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType)


def in_storage_order(rows: DataFrame, table: str) -> DataFrame:
    """Sorted inside each task, so that Parquet row groups can be skipped on the leading key; no shuffle."""
    return rows.sortWithinPartitions(*SORT_KEYS[table])


def append(rows: DataFrame, fmt: str, location: str | None = None, **options: str) -> int:
    """Append and return the number of rows written, counted by the write itself."""
    seen = Observation("append")
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).options(**options).mode("append")
    writer.save(location) if location else writer.save()
    return seen.get["rows"]


def high_watermark(table: DataFrame) -> datetime:
    """Newest ``batch_time``, or the epoch for an empty table. One scalar reaches the driver."""
    micros = table.agg(F.unix_micros(F.max("batch_time"))).first()[0]
    return EPOCH if micros is None else _moment(micros)


def newest_in_footers(spark: SparkSession, places: list[str], schema: T.StructType, column: str = "batch_time") -> datetime:
    """The same for Parquet folders, from the statistics in the files' footers: no row is read.

    Footers are read by Spark's aggregate pushdown, which covers whole numbers, and that is how a time is stored (``newest_stored``). A
    file whose times are all null has no such statistics; then the column is read after all.
    """
    if not places:
        return EPOCH
    try:
        with _footer_reads(spark):
            micros = newest_stored(spark, places, schema, column).first()[0]
    except (PySparkException, Py4JJavaError) as error:
        if "aggregatePushdown" not in str(error):  # the setting that Spark names where statistics are missing
            raise
        rows = spark.read.schema(schema).parquet(*places)
        return high_watermark(rows.select(F.col(column).alias("batch_time")))
    return EPOCH if micros is None else _moment(micros)


def newest_stored(spark: SparkSession, places: list[str], schema: T.StructType, column: str) -> DataFrame:
    """The greatest value of a time column, as stored: microseconds since the epoch.

    ``schema`` must have the columns in the files' order, as the pushdown finds a column's statistics by its place.
    """
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name == column else f.dataType) for f in schema.fields])
    return spark.read.schema(stored).parquet(*places).agg(F.max(column).alias("high"))


@contextmanager
def _footer_reads(spark: SparkSession) -> Iterator[None]:
    """Parquet by the source that can answer from footers, for the length of one read."""
    others = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    with setting(spark, "spark.sql.sources.useV1SourceList", ",".join(others)), setting(spark, "spark.sql.parquet.aggregatePushdown", "true"):
        yield


def high_watermark_jdbc(spark: SparkSession, url: str, table: str, column: str = "batch_time", **options: str) -> datetime:
    """The same for a JDBC table, with the maximum computed in the database (Spark pushes no aggregate there).

    The table is named as in ``dbtable``; columns are quoted, as Spark quotes them when it creates a table.
    """
    query = f'(SELECT max("{column}") AS "high" FROM {table}) AS t'
    high = read_table(spark, "jdbc", url=url, dbtable=query, **options)
    micros = high.agg(F.unix_micros(F.max("high"))).first()[0]
    return EPOCH if micros is None else _moment(micros)


def _moment(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
