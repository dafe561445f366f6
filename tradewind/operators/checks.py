"""Constraints as queries: unique, not null and foreign keys that the store does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.keyed import absent_from, repeated_keys


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("constraint_name"), F.col("violations").cast("long").alias("violations"))


def unique_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of their key; null keys are the not-null check's business."""
    extra = repeated_keys(df.where(F.col(key).isNotNull()), key)
    counted = extra.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("violations"))
    return _named(counted, f"{table}.{key} unique")


def not_null_checks(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All columns of a table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"{table}.{c} not null").alias("constraint_name"),
                                         F.col(c).alias("violations")) for c in columns]))
    return counts.select(pairs.alias("c")).select("c.*")


def foreign_key_check(df: DataFrame, table: str, key: str, parent: DataFrame, parent_name: str) -> DataFrame:
    """Child rows whose key has no parent."""
    orphans = absent_from(df.select(key).where(F.col(key).isNotNull()), parent, key)
    counted = orphans.agg(F.count(F.lit(1)).alias("violations"))
    return _named(counted, f"{table}.{key} references {parent_name}")


def text_length_check(df: DataFrame, table: str, column: str, limit: int) -> DataFrame:
    """Values longer than the declared VARCHAR length."""
    counted = df.agg(F.count_if(F.length(column) > limit).alias("violations"))
    return _named(counted, f"{table}.{column} length <= {limit}")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
