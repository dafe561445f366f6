"""Keys of dimensions by bucket: what a micro-batch reads, and what stays true whatever the warehouse does in between."""

import random

import pytest
from helpers import ids, rows, ts
from pyspark.sql import functions as F
from test_streaming import body, messages

from tradewind.plans import rollup_store, sync
from tradewind.plans.dimension_keys import DimensionKeys
from tradewind.plans.rollups import DIMENSION_OF, ROLLUPS, from_state
from tradewind.sources import files, folded
from tradewind.streaming import jobs

KEY_OF = {table: key for key, table in DIMENSION_OF.items()}


def load(spark, place, **tables):
    for table, numbers in tables.items():
        sync.add_load(ids(spark, KEY_OF[table], *numbers), f"{place}/warehouse", table)


def store(place, buckets=64):
    return DimensionKeys(f"{place}/keys", f"{place}/warehouse", buckets)


def asked(spark, *numbers):
    return spark.createDataFrame([(n, n, n) for n in numbers], "seller_id long, product_id long, customer_id long").cache()


def known(found):
    return {table: [r[0] for r in rows(found[table].distinct())] for table in found}


def test_a_batch_reads_its_buckets_only(spark, place):
    load(spark, place, products=range(2000), sellers=range(50), customers=[])
    keys = store(place)
    found = keys.met(asked(spark, 3, 7, 5000, None))
    assert known(found) == {"products": [3, 7], "sellers": [3, 7], "customers": []}
    wanted = {r[0] for r in asked(spark, 3, 7, 5000).select(keys.bucket("product_id")).collect()}
    plan = found["products"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and plan.split("PartitionFilters: [")[1].startswith("bucket#")
    read = [f for f in found["products"].inputFiles() if "/keys/" in f]
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in keys.read(spark, "product_id").inputFiles()} == set(range(64))
    scanned = keys.read(spark, "product_id").where(F.col("bucket").isin(sorted(wanted))).select("product_id")
    opened = {r[0].split("bucket=")[1].split("/")[0] for r in scanned.select(F.input_file_name()).distinct().collect()}
    assert {int(b) for b in opened} <= wanted and len(read) >= len(opened)


def test_a_key_is_stored_once_whatever_the_loads(spark, place):
    keys, rng = store(place, 4), random.Random(1)
    everything = set()
    for day in range(12):
        new = [rng.randrange(300) for _ in range(30)]
        everything.update(new)
        load(spark, place, products=new * 2)
        if day % 4 == 3:
            sync.compact_table(spark, f"{place}/warehouse", "products")
        keys.catch_up(spark)
        assert sorted(r.product_id for r in keys.read(spark, "product_id").collect()) == sorted(everything)
    keys.catch_up(spark)
    assert len(folded.paths(spark, f"{place}/keys/products")) <= folded.FAN + 2
    wrong = keys.read(spark, "product_id").where(F.col("bucket") != keys.bucket("product_id"))
    assert wrong.count() == 0


def test_a_load_taken_in_half_way_is_taken_in_again(spark, place):
    load(spark, place, products=[1, 2], sellers=[1], customers=[1])
    keys = store(place)
    keys.catch_up(spark)
    load(spark, place, products=[2, 3])
    keys.catch_up(spark)
    files.remove(spark, f"{place}/keys/products/batch/1/_SUCCESS")  # as if the write had stopped
    assert sorted(r.product_id for r in keys.read(spark, "product_id").collect()) == [1, 2]
    assert known(keys.met(asked(spark, 1, 2, 3)))["products"] == [1, 2, 3]
    assert keys.read(spark, "product_id").count() == 3


def test_before_any_load_nothing_is_known(spark, place):
    assert known(store(place).met(asked(spark, 1))) == {"products": [], "sellers": [], "customers": []}


@pytest.mark.parametrize("buckets", [1, 16])
def test_the_stream_counts_as_with_whole_dimensions(spark, place, buckets):
    """Dimensions grow between batches: a sale counts if its keys are loaded when it arrives, with either way of asking."""
    have = {"products": [1], "sellers": [1, 2], "customers": [1, 2]}
    whole = jobs.Outputs(f"{place}/a", f"{place}/a-dead", f"{place}/a-rollups",
                         lambda: {t: ids(spark, KEY_OF[t], *have[t]) for t in have})
    near = jobs.Outputs(f"{place}/b", f"{place}/b-dead", f"{place}/b-rollups", keys=store(place, buckets))
    load(spark, place, **have)
    rng = random.Random(buckets)
    for n in range(3):
        sent = messages(spark, *[body(sell_id=100 * n + i, product_id=rng.randint(1, 4), seller_id=rng.randint(1, 3)) for i in range(30)])
        for out in (whole, near):
            jobs.store_batch(sent, n, out, ts(9))
        have["products"].append(n + 2)
        load(spark, place, products=[n + 2])
    for name in ROLLUPS:
        a, b = (rows(from_state(rollup_store.read_state(spark, out.rollups), ROLLUPS[name])) for out in (whole, near))
        assert a == b and a
