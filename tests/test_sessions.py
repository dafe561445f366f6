import random

import pytest
from helpers import rows, ts

from tradewind.plans.accounts import sessionise_logins
from tradewind.sources import folded
from tradewind.streaming import sessions

LOG = [("t1", 1, "login", ts(1)), ("t1", 1, "logout", ts(2)), ("t1", 1, "login", ts(3)), ("t2", 2, "login", ts(1)), ("t3", 3, "logout", ts(1)),
       ("t4", 4, "logout", ts(9)), ("t4", 4, "login", ts(2)), ("t1", 1, "logout", ts(28)), ("t5", 5, "login", ts(4)), ("t5", 5, "logout", ts(3))]


def log(spark, events):
    return spark.createDataFrame(events, sessions.EVENT)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_and_batches_give_the_same(spark, place, seed):
    events, rng = LOG * 2, random.Random(seed)
    rng.shuffle(events)
    at, batch = 0, 0
    while at < len(events):
        many = rng.randint(1, 6)
        sessions.store_events(log(spark, events[at:at + many]), batch, place)
        if rng.random() < 0.6:
            sessions.fold(spark, place, batch)
        at, batch = at + many, batch + 1
    assert rows(sessions.read_sessions(spark, place)) == rows(sessionise_logins(log(spark, LOG)))


def test_a_stream_with_folds_restarts_and_late_logouts(spark, place):
    def run(*events):
        log(spark, list(events)).coalesce(1).write.mode("append").parquet(f"{place}/log")
        stream = spark.readStream.schema(sessions.EVENT).option("maxFilesPerTrigger", "1").parquet(f"{place}/log")
        sessions.keep_sessions(stream, f"{place}/sessions", f"{place}/checkpoint", fold_every=1).awaitTermination()

    for event in LOG:
        run(event)
    assert rows(sessions.read_sessions(spark, f"{place}/sessions")) == rows(sessionise_logins(log(spark, LOG)))
    # A range has one row per token, and the folders don't grow with the batches.
    assert len(folded.paths(spark, f"{place}/sessions")) <= folded.FAN + 2


def test_a_batch_that_runs_again(spark, place):
    for _ in range(2):
        sessions.store_events(log(spark, LOG), 0, place)
    assert rows(sessions.read_sessions(spark, place)) == rows(sessionise_logins(log(spark, LOG)))
