"""Additive merge of partial aggregates, and the keyed upsert plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.keyed import absent_from, own_shuffle, repeated_keys


def add_up(parts: DataFrame, keys: list[str], measures: list[str], drop_zero_rows: bool = False) -> DataFrame:
    """Sum the measures of rows with equal keys; with no keys, one row comes out even for empty input."""
    types = {f.name: f.dataType for f in parts.schema.fields}
    sums = [F.sum(m).cast(types[m]).alias(m) for m in measures]
    if not keys:
        zero = [F.coalesce(F.sum(m), F.lit(0)).cast(types[m]).alias(m) for m in measures]
        return parts.agg(*zero)
    merged = parts.groupBy(*keys).agg(*sums)
    return nonzero(merged, measures) if drop_zero_rows else merged


def nonzero(rows: DataFrame, measures: list[str]) -> DataFrame:
    """Rows with a measure that is neither null nor zero."""
    some = F.lit(False)
    for m in measures:
        some = some | (F.coalesce(F.col(m), F.lit(0)) != 0)
    return rows.where(some)


def add_increment(state: DataFrame, delta: DataFrame, keys: list[str], measures: list[str],
                  drop_zero_rows: bool = False) -> DataFrame:
    """State after one more batch of partial aggregates."""
    return add_up(state.unionByName(delta), keys, measures, drop_zero_rows)


class RepeatedSourceKey(ValueError):
    """An upsert source names one target row more than once."""


def require_unique(source: DataFrame, key: str) -> None:
    repeated = repeated_keys(source, key).take(3)
    if repeated:
        raise RepeatedSourceKey(f"upsert source repeats {key}: {[r[key] for r in repeated]}")


def merge_rows(target: DataFrame, source: DataFrame, key: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Target rows after ``update when matched, insert when not``; ``kept`` columns survive an update.

    Written as a left join plus an anti join rather than one full outer join: adaptive execution can split a hot
    target key in both of these, but in no full outer join. ``source`` must have unique keys.
    """
    columns = target.columns
    edits = source.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns if c != key], F.lit(True).alias("_hit"))
    joined = target.join(own_shuffle(edits, key), key, "left")
    updated = joined.select(*[
        F.col(c) if c == key or c in kept
        else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        for c in columns])
    return updated.unionByName(absent_from(source, target, key).select(*columns))
