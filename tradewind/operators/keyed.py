"""Keyed row operators: newest per key, first per key, existence, insert-if-absent.

They use aggregates rather than windows: an aggregate combines on the map side, so a key that holds a third of
all rows reaches its reducer as one row per map task instead of as one unbounded group. Existence tests are semi and anti
joins straight on the key column, which needs no unique right side; adaptive execution splits a hot key on their wide side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_by_key(df: DataFrame, key: str, *recency: str) -> DataFrame:
    """One row per key: the one with the greatest ``recency``, ties settled by the remaining columns."""
    rank = [c for c in recency if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in rank]
    picked = df.groupBy(key).agg(F.max(F.struct(*rank, *rest)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the one with the least ``order``."""
    rest = [c for c in df.columns if c != key and c not in order]
    picked = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def own_shuffle(rows: DataFrame, key: str) -> DataFrame:
    """Let the next join shuffle an aggregated side itself, so that its other side can be split when it is skewed.

    The rows stay the same; a computed key only hides that they are partitioned by it already. The aggregated side
    is the small one, and when it is broadcast nothing is shuffled at all.
    """
    empty = {"string": "", "binary": bytearray()}
    kind = rows.schema[key].dataType.typeName()
    if kind in empty:
        return rows.withColumn(key, F.concat(F.col(key), F.lit(empty[kind])))
    return rows.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


def keep_known(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the dimension, each once however often the dimension repeats the key."""
    return df.join(dimension.select(key), key, "left_semi").select(*df.columns)


def key_copies(dimension: DataFrame, key: str, name: str) -> DataFrame:
    """How often each key occurs. Joining this and multiplying equals an inner join without its blow-up."""
    counted = dimension.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return own_shuffle(counted, key)


def absent_from(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``existing``."""
    return df.join(existing.select(key), key, "left_anti").select(*df.columns)


def insert_if_absent(incoming: DataFrame, existing: DataFrame, key: str, *order: str) -> DataFrame:
    """What an insert that ignores key conflicts would add: the first row per key, if the key is new."""
    return absent_from(first_by_key(incoming, key, *order), existing, key)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
