"""Sessions kept from a stream of logins and logouts.

Each micro-batch writes what it says of its tokens; the parts are merged when they are read, and by folds, which keep one row per token.
Earliest login and latest logout don't depend on order or batches, so a logout that comes long after its login, or before it, counts
all the same, and no state has to be given up after a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.plans.accounts import merge_parts, session_parts, started
from tradewind.sources import folded
from tradewind.streaming.jobs import start

EVENT = T.StructType([T.StructField("session_token", T.StringType()), T.StructField("user_id", T.LongType()),
                      T.StructField("action", T.StringType()), T.StructField("ts", T.TimestampType())])
SESSION = T.StructType([T.StructField("session_token", T.StringType()), T.StructField("user_id", T.LongType()),
                        T.StructField("session_start", T.TimestampType()), T.StructField("session_end", T.TimestampType())])


def keep_sessions(log: DataFrame, root: str, checkpoint: str, fold_every: int | None = None, continuous: bool = False) -> StreamingQuery:
    """Take a stream of ``login`` and ``logout`` events into the sessions below ``root``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        store_events(batch, batch_id, root)
        if fold_every and (batch_id + 1) % fold_every == 0:
            fold(batch.sparkSession, root, batch_id)

    return start(log, each, checkpoint, continuous)


def store_events(batch: DataFrame, batch_id: int, root: str) -> None:
    folded.write(session_parts(batch).select(*SESSION.fieldNames()), root, batch_id)


def fold(spark: SparkSession, root: str, before: int) -> None:
    """Merge what batches below ``before`` wrote; the newest may run again. A range has one row per token."""
    folded.prune(spark, root)
    folded.fold(spark, root, SESSION, before - 1, shape=lambda rows: merge_parts(rows).select(*SESSION.fieldNames()))


def read_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions as ``sessionise_logins`` would make them of all events so far."""
    return started(merge_parts(folded.read(spark, root, SESSION)))
