"""Stored rollup state: a folded base plus one delta per micro-batch.

    <root>/delta/batch_id=N/rollup=.../year=.../   overwritten as a whole, so a replayed batch changes nothing
    <root>/base/upto=N/rollup=.../year=.../        all deltas up to N folded together
    <root>/folds/                         one appended row per finished base

A reader takes the newest finished base and the deltas after it, and adds them up. A fold that dies half-way
leaves a base that no row in ``folds`` names; a batch replayed after it was folded is ignored. A panel with a time range
opens the folders of its years only, and the rows of a file lie in the order of their periods.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.plans.rollups import STATE_KEYS, STATE_MEASURES
from tradewind.operators.merge import add_up, nonzero
from tradewind.schemas import ROLLUP_STATE
from tradewind.sources import files
from tradewind.sources.tables import read_or_empty

_FOLDS = T.StructType([T.StructField("upto", T.LongType())])
# Year of the period; null for rollups without one.
_STORED = T.StructType([*ROLLUP_STATE.fields, T.StructField("year", T.IntegerType())])
_DELTA = T.StructType([*_STORED.fields, T.StructField("batch_id", T.LongType())])
# Upto value of a backfill: before any streamed batch, whose ids start at 0.
BACKFILL = -1
# Name of the mark in a delta without repeated state keys; readers of Parquet skip names that start so.
_UNIQUE = "_unique"


def _ranged(state: DataFrame) -> DataFrame:
    """State dealt out for a base: each task holds a range, so a file holds one rollup (two at a border) and a large rollup is
    spread evenly: state keys are unique, so no range is hot."""
    return state.repartitionByRange(*STATE_KEYS)


def _write(state: DataFrame, path: str) -> None:
    """Each task writes what it holds, in the order of folders and periods. The writer asks for the order of folders, so rows are
    sorted once."""
    dated = state.withColumns({"year": F.year("period"), "rollup": F.coalesce("rollup", F.lit(""))})
    (dated.sortWithinPartitions("rollup", "year", "period", "key_id")
     .write.mode("overwrite").option("compression", "zstd").partitionBy("rollup", "year").parquet(path))


def write_delta(delta: DataFrame, root: str, batch_id: int, built: bool = False) -> None:
    """A delta gets few files per rollup. One that was ``built`` (see ``backfill``) is written as it lies, and marked, so that a
    fold knows that it repeats no state key."""
    folder = f"{root}/delta/batch_id={batch_id}"
    files.remove(delta.sparkSession, f"{folder}/{_UNIQUE}")
    _write(delta if built else delta.hint("rebalance", "rollup"), folder)
    if built:
        files.mark(delta.sparkSession, f"{folder}/{_UNIQUE}")


def _folded(spark: SparkSession, root: str) -> int | None:
    return read_or_empty(spark, f"{root}/folds", _FOLDS).agg(F.max("upto")).first()[0]


def _parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, int | None]:
    upto = _folded(spark, root)
    deltas = read_or_empty(spark, f"{root}/delta", _DELTA)
    if upto is None:
        return spark.createDataFrame([], _STORED), deltas, None
    base = spark.read.schema(_STORED).parquet(f"{root}/base/upto={upto}")
    return base, deltas.where(F.col("batch_id") > upto), upto


def read_state(spark: SparkSession, root: str, drop_zero_rows: bool = False, since: date | None = None) -> DataFrame:
    """Merged state. A filter on ``rollup`` prunes to that rollup's folders; ``since`` leaves out earlier periods, whose years'
    folders are not opened. Rollups without periods are not cut.

    Right after a fold there is nothing to add up, and the base is read as it is.
    """
    base, deltas, upto = _parts(spark, root)
    if since is not None:
        shown = (F.col("year").isNull() | (F.col("year") >= since.year)) & (F.col("period").isNull() | (F.col("period") >= F.lit(since)))
        base, deltas = base.where(shown), deltas.where(shown)
    if upto is not None and not drop_zero_rows and deltas.isEmpty():
        return base.drop("year")
    return add_up(base.unionByName(deltas.drop("batch_id")), STATE_KEYS, STATE_MEASURES, drop_zero_rows)


def _commit(spark: SparkSession, root: str, upto: int) -> None:
    spark.createDataFrame([(upto,)], _FOLDS).coalesce(1).write.mode("append").parquet(f"{root}/folds")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove what no reader can hold any more: bases older than the last ``keep`` folds, and the deltas in all of those.

    A fold is recorded before anything that it replaces is removed, and removing goes by the record alone, so a run that
    stops half-way is finished by the next. A delta that is written again later lies below a fold, and is ignored.
    """
    folds = sorted({r[0] for r in read_or_empty(spark, f"{root}/folds", _FOLDS).collect()}, reverse=True)
    if len(folds) < keep:
        return []
    removed = []
    for kind, name, oldest in (("delta", "batch_id=", folds[keep - 1] + 1), ("base", "upto=", folds[keep - 1])):
        for found in files.names(spark, f"{root}/{kind}"):
            if found.startswith(name) and int(found.removeprefix(name)) < oldest:
                files.remove(spark, f"{root}/{kind}/{found}")
                removed.append(f"{kind}/{found}")
    return sorted(removed)


def backfill(state: DataFrame, root: str, unique: bool = False, built: bool = False) -> None:
    """Seed the store from facts that were there before any streamed batch. Repeated state keys are added up, as in any fold,
    unless the caller knows that there are none (``unique``), as in rollups that were just built. State ``built`` by ``build_all``
    has none either, and lies by key in tasks of like size, so it is not dealt out again: each task writes a file to each
    folder that it has rows of."""
    path = f"{root}/base/upto={BACKFILL}"
    _write(state if built else _ranged(state if unique else add_up(state, STATE_KEYS, STATE_MEASURES)), path)
    _commit(state.sparkSession, root, BACKFILL)


def _alone(spark: SparkSession, root: str, parts: DataFrame) -> Column:
    """True for rows in folders (rollup and year) that one part has rows of, if that part repeats no state key. Only names of
    folders reach the driver, from the paths of the files."""
    found = parts.groupBy("rollup", "year").agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last"))
    single = found.where(F.col("first") == F.col("last")).collect()
    unique = {n: n == BACKFILL or files.exists(spark, f"{root}/delta/batch_id={n}/{_UNIQUE}") for n in {r["first"] for r in single}}
    alone = F.lit(False)
    for r in single:
        if unique[r["first"]]:
            alone = alone | (F.col("rollup").eqNullSafe(r["rollup"]) & F.col("year").eqNullSafe(F.lit(r["year"]).cast("int")))
    return alone


def compact(spark: SparkSession, root: str, settled: bool = False, drop_zero_rows: bool = False) -> int | None:
    """Fold deltas into a new base; the rows read back stay the same. Returns the last folded batch id.

    Folders that one part has rows of hold nothing to add up: their rows are moved, sorted file by file, and only the other
    folders are shuffled. A fold of late batches therefore shuffles the years that they reach, not the store.

    The newest batch may still be being written, or may run again, so it stays out unless the stream is ``settled``
    (stopped after a finished batch). Older batches are complete: a stream runs them one after the other.
    """
    base, deltas, upto = _parts(spark, root)
    newest = deltas.agg(F.max("batch_id")).first()[0]
    older = deltas if settled else deltas.where(F.col("batch_id") < newest)
    last = None if newest is None else newest if settled else older.agg(F.max("batch_id")).first()[0]
    if last is None:
        return upto
    parts = base.withColumn("batch_id", F.lit(BACKFILL).cast("long")).unionByName(deltas.where(F.col("batch_id") <= last))
    alone = _alone(spark, root, parts)
    merged = add_up(parts.where(~alone), STATE_KEYS, STATE_MEASURES, drop_zero_rows)
    moved = parts.where(alone).select(*STATE_KEYS, *STATE_MEASURES)
    _write((nonzero(moved, STATE_MEASURES) if drop_zero_rows else moved).unionByName(_ranged(merged)), f"{root}/base/upto={last}")
    _commit(spark, root, last)
    return last
