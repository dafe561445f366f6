import json
import random
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from helpers import PRODUCT, ids, product, rows, ts

from tradewind.operators.enrich import enrich
from tradewind.plans import rollup_store
from tradewind.plans.rollups import ROLLUPS, build, from_state
from tradewind.sources import files, folded
from tradewind.streaming import jobs
from tradewind.streaming.messages import parse, rejected, to_fact, accepted

GOOD = {"customer_id": 1, "product_id": 1, "sell_id": 5, "price": 2.5, "seller_id": 1, "quantity": 2}


def body(**changes):
    message = {**GOOD, **changes}
    return json.dumps({k: v for k, v in message.items() if v != "absent"})


def messages(spark, *values, at=ts(5)):
    return spark.createDataFrame([(str(i), v, at) for i, v in enumerate(values)], jobs.MESSAGE)


@pytest.mark.parametrize("value,reason,missing", [
    (body(), None, None), (body(price="cheap"), None, None), (body(price="absent"), None, None),
    (body(note={"a": [1]}), None, None), ("  " + body() + "\n", None, None),
    ("xx", "malformed", None), ("[1]", "malformed", None), ("[" + body() + "]", "malformed", None), ("5", "malformed", None),
    ('"text"', "malformed", None), ("null", "malformed", None), ("", "malformed", None), (None, "malformed", None),
    (body() + " trailing", "malformed", None), (body() + body(), "malformed", None), (body() + "," + body(), "malformed", None),
    ("{}", "missing_fields", "sell_id,customer_id,product_id,seller_id,quantity"),
    (body(sell_id="absent"), "missing_fields", "sell_id"), (body(seller_id=None), "missing_fields", "seller_id"),
    (body(sell_id="7"), "missing_fields", "sell_id"), (body(quantity=1.5), "missing_fields", "quantity"),
    (body(quantity=99999999999), "missing_fields", "quantity"),
])
def test_message_check(spark, value, reason, missing):
    parsed = parse(messages(spark, value))
    if reason is None:
        assert rows(accepted(parsed), "sell_id", "quantity") == [(5, 2)] and rows(rejected(parsed)) == []
    else:
        assert rows(rejected(parsed)) == [(value, ts(5), reason, missing)] and rows(accepted(parsed)) == []


def test_fact_of_a_message(spark):
    at = datetime(2024, 1, 5, 1, 2, 3, 999000)
    good = accepted(parse(messages(spark, body(), body(price="absent"), at=at)))
    got = rows(to_fact(good, ts(9)), "sale_id", "sale_date", "quantity", "total_amount", "batch_time")
    assert got == [(5, datetime(2024, 1, 5, 1, 2, 3), 2, D("0.00"), ts(9)), (5, datetime(2024, 1, 5, 1, 2, 3), 2, D("5.00"), ts(9))]
    plain = rows(to_fact(good, ts(9), reference_defaults=True), "sale_date", "total_amount", "batch_time")
    assert plain == [(datetime(1970, 1, 1), D("0.00"), datetime(1970, 1, 1))] * 2


class World:
    """Folders of one stream test, with dimensions that can change between runs."""

    def __init__(self, spark, place):
        self.spark, self.root = spark, place
        self.products = ids(spark, "product_id", 1)
        self.out = jobs.Outputs(f"{place}/facts", f"{place}/dead", f"{place}/rollups", self.dims)

    def dims(self):
        return {"products": self.products, "sellers": ids(self.spark, "seller_id", 1, 2),
                "customers": ids(self.spark, "customer_id", 1, 2)}

    def send(self, *values, at=ts(5)):
        messages(self.spark, *values, at=at).coalesce(1).write.mode("append").parquet(f"{self.root}/topic")

    def drain(self, **options):
        stream = jobs.read_messages(self.spark, "parquet", f"{self.root}/topic", **options)
        jobs.ingest(stream, self.out, f"{self.root}/checkpoint", batch_time=ts(9)).awaitTermination()

    def facts(self):
        return rows(jobs.read_facts(self.spark, self.out.facts), "sale_id", "product_id", "quantity", "total_amount")

    def dead(self):
        return rows(jobs.read_dead_letters(self.spark, self.out.dead_letters), "value")

    def rollup(self, name):
        return rows(from_state(rollup_store.read_state(self.spark, self.out.rollups), ROLLUPS[name]))


def test_accepted_plus_rejected_is_all_and_a_restart_goes_on(spark, place):
    world = World(spark, place)
    world.send(body(sell_id=1), "xx", body(sell_id=2, quantity="absent"))
    world.drain()
    assert (len(world.facts()), len(world.dead())) == (1, 2)
    world.drain()  # nothing new
    world.send(body(sell_id=3), "yy")
    world.drain()
    assert world.facts() == [(1, 1, 2, D("5.00")), (3, 1, 2, D("5.00"))]
    assert len(world.dead()) == 3
    assert world.rollup("average_sale_check") == [(D("10.00"), 2)]


def test_a_replayed_batch_changes_nothing(spark, place):
    world = World(spark, place)
    batch = messages(spark, body(sell_id=1), body(sell_id=2), "xx")
    for _ in range(2):
        jobs.store_batch(batch, 0, world.out, ts(9))
    assert len(world.facts()) == 2 and len(world.dead()) == 1
    assert world.rollup("units_by_product") == [(1, 4)]


def test_late_dimension_counts_in_batch_but_not_in_the_stream(spark, place):
    world = World(spark, place)
    world.send(body(sell_id=1, product_id=8), body(sell_id=2))
    world.drain()
    world.products = ids(spark, "product_id", 1, 8)
    world.send(body(sell_id=3, product_id=8))
    world.drain()
    assert world.rollup("daily_sales_by_product") == [(date(2024, 1, 5), 1, 2, D("5.00")), (date(2024, 1, 5), 8, 2, D("5.00"))]
    assert world.rollup("units_by_product") == [(1, 2), (8, 4)]
    facts = jobs.read_facts(spark, world.out.facts)
    assert rows(build(facts, ROLLUPS["daily_sales_by_product"], world.dims())) == [
        (date(2024, 1, 5), 1, 2, D("5.00")), (date(2024, 1, 5), 8, 4, D("10.00"))]


def test_order_and_batching_do_not_matter(spark, place):
    values = [body(sell_id=i, quantity=1 + i % 4, seller_id=1 + i % 3) for i in range(24)]
    results = []
    for run in range(2):
        world = World(spark, f"{place}/{run}")
        random.Random(run).shuffle(values)
        for start in range(0, 24, 8 if run else 12):
            world.send(*values[start:start + (8 if run else 12)])
        world.drain(maxFilesPerTrigger="1")
        rollup_store.compact(spark, world.out.rollups)
        results.append([world.rollup(name) for name in ROLLUPS])
    assert results[0] == results[1]


def test_purchases_to_rollups(spark, place):
    world = World(spark, place)
    catalogue = spark.createDataFrame([product(1, "A", price="19.99", seller=2, updated=ts(1)),
                                       product(1, "A", price="29.99", seller=2, updated=ts(2))], PRODUCT)
    bought = spark.createDataFrame([(5, 1, 1, 3, ts(5, 12)), (6, 1, 77, 3, ts(5, 12))],
                                   "sell_id long, customer_id long, product_id long, quantity int, ts timestamp")
    bought.write.parquet(f"{place}/bought")
    stream = spark.readStream.schema(bought.schema).parquet(f"{place}/bought")
    jobs.publish_stream(stream, lambda batch, _: enrich(batch, catalogue), f"{place}/sent", "parquet", f"{place}/topic").awaitTermination()
    world.drain()
    assert world.facts() == [(5, 1, 3, D("89.97"))]
    assert world.rollup("revenue_by_seller") == [(2, D("89.97"))]


def ingested(world, **options):
    stream = jobs.read_messages(world.spark, "parquet", f"{world.root}/topic", **options)
    return jobs.ingest(stream, world.out, f"{world.root}/checkpoint", batch_time=ts(9), repeats="1 day")


def test_a_message_sent_twice_counts_once(spark, place):
    """Repeats in one file, in another batch with another time and price, and after a restart; late messages are no repeats."""
    world = World(spark, place)
    world.send(body(sell_id=1), body(sell_id=1), body(sell_id=2), "xx", "xx", body(sell_id=3, quantity="absent"))
    world.send(body(sell_id=2, price=9.0), "xx", body(sell_id=3), at=ts(25))
    query = ingested(world, maxFilesPerTrigger="1")
    query.awaitTermination()
    assert len(query.recentProgress) >= 2
    assert [f[0] for f in world.facts()] == [1, 2, 3] and len(world.dead()) == 2
    world.send(body(sell_id=1), body(sell_id=4), "xx", "yy", at=ts(1))  # long before all others
    ingested(world).awaitTermination()
    assert [f[:1] + f[3:] for f in world.facts()] == [(n, D("5.00")) for n in (1, 2, 3, 4)]
    assert world.dead() == sorted([(body(sell_id=3, quantity="absent"),), ("xx",), ("yy",)], key=repr)
    assert world.rollup("average_sale_check") == [(D("20.00"), 4)]


def test_a_batch_that_runs_again_keeps_its_first_messages(spark, place, monkeypatch):
    """The stream dies after its outputs are written and before it says so; the state of the batch is not the next one's yet."""
    world = World(spark, place)
    world.send(body(sell_id=1), body(sell_id=1), "xx")
    real = jobs.store_parsed

    def dying(*args):
        real(*args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(jobs, "store_parsed", dying)
        with pytest.raises(Exception, match="stopped"):
            ingested(world).awaitTermination()
    assert [f[0] for f in world.facts()] == [1]
    ingested(world).awaitTermination()
    assert [f[0] for f in world.facts()] == [1] and len(world.dead()) == 1


def test_files_are_bounded_and_nothing_changes(spark, place, monkeypatch):
    """Many batches with a fold after every other one: the folders left are few, and the rows are those of all batches."""
    monkeypatch.setattr(folded, "FAN", 3)
    out, left = jobs.Outputs(f"{place}/facts", f"{place}/dead"), []
    for n in range(20):
        jobs.store_batch(messages(spark, body(sell_id=n), f"bad {n}").coalesce(1), n, out, ts(9))
        if n % 2:
            jobs.fold_outputs(spark, out, n)
        left.append(sum(len(files.names(spark, f"{out.facts}/{kind}")) for kind in ("batch", "folded")))
    assert sorted(r.sale_id for r in jobs.read_facts(spark, out.facts).collect()) == list(range(20))
    assert jobs.read_dead_letters(spark, out.dead_letters).count() == 20
    assert max(left) <= 11  # it grows with the number of levels only
    assert len(folded.paths(spark, out.facts)) <= 6


def test_a_batch_may_run_again_after_a_fold(spark, place):
    world = World(spark, place)
    out = jobs.Outputs(world.out.facts, world.out.dead_letters)
    for n in range(3):
        jobs.store_batch(messages(spark, body(sell_id=n)), n, out, ts(9))
    jobs.fold_outputs(spark, out, 2)
    before = world.facts()
    jobs.store_batch(messages(spark, body(sell_id=2)), 2, out, ts(9))
    assert world.facts() == before and [f[0] for f in before] == [0, 1, 2]


@pytest.mark.parametrize("step", ["write", "removal"])
def test_a_fold_that_stops_half_way(spark, place, step, monkeypatch):
    root, schema = f"{place}/table", ids(spark, "a", 1).schema
    for n in range(4):
        folded.write(ids(spark, "a", n, 10 + n), root, n)
    want = rows(folded.read(spark, root, schema))
    if step == "write":  # the range is there, its end marker is not
        folded.fold(spark, root, schema, 2)
        files.remove(spark, f"{root}/folded/0-2-0/_SUCCESS")
        assert rows(folded.read(spark, root, schema)) == want
        folded.prune(spark, root)
        assert files.names(spark, f"{root}/folded") == [] and rows(folded.read(spark, root, schema)) == want
    else:  # one batch is removed, another one half
        folded.fold(spark, root, schema, 2)
        files.remove(spark, f"{root}/batch/0")
        files.remove(spark, f"{root}/batch/1/_SUCCESS")
        assert rows(folded.read(spark, root, schema)) == want
        assert folded.prune(spark, root) == ["batch/1", "batch/2"]
    folded.fold(spark, root, schema, 2)
    assert rows(folded.read(spark, root, schema)) == want and folded.last(spark, root) == 3
    folded.fold(spark, root, schema, whole=True)
    folded.prune(spark, root)
    assert rows(folded.read(spark, root, schema)) == want and folded.paths(spark, root) == [f"{root}/folded/0-3-1"]
    assert files.names(spark, f"{root}/batch") == []


def test_ranges_of_a_level_come_together(spark, place, monkeypatch):
    monkeypatch.setattr(folded, "FAN", 3)
    root, schema = f"{place}/table", ids(spark, "a", 1).schema
    for n in range(27):
        folded.write(ids(spark, "a", n), root, n)
        folded.prune(spark, root)
        folded.fold(spark, root, schema)
        assert len(folded.paths(spark, root)) <= 6
    assert folded.ranges(spark, root) == [(0, 26, 3)]
    assert sorted(r[0] for r in folded.read(spark, root, schema).collect()) == list(range(27))


def test_kafka_options():
    source, sink = jobs.kafka_source("host:9092", maxOffsetsPerTrigger="1000"), jobs.kafka_sink("host:9092")
    assert source["startingOffsets"] == "earliest" and source["subscribe"] == sink["topic"] == "purchases"
    assert sink["kafka.retries"] == "3"
