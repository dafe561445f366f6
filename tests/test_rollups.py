import random
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from helpers import dims, rows, sales, ts
from pyspark.sql import functions as F

from tradewind.operators.merge import add_increment, add_up
from tradewind.plans import rollup_store
from tradewind.plans.rollups import (ROLLUPS, STATE_KEYS, STATE_MEASURES, build, build_all, from_state,
                                     star_existence, to_state)
from tradewind.registry.fixtures import Marketplace

from conftest import SMALL


def test_one_row_per_day_not_per_timestamp(spark):
    fact = sales(spark, (1, 1, 1, 1, ts(5, 1), 2, "3.00"), (2, 1, 1, 1, ts(5, 2), 3, "4.50"))
    got = rows(build(fact, ROLLUPS["daily_sales_by_product"], dims(spark)))
    assert got == [(date(2024, 1, 5), 1, 5, D("7.50"))]


def test_unknown_dimension_leaves_star_rollups_only(spark):
    fact = sales(spark, (1, 1, 9, 1, ts(5), 2, "3.00"), (2, 1, 1, 1, ts(6), 1, "1.00"))
    assert rows(build(fact, ROLLUPS["daily_sales_by_seller"], dims(spark))) == [(date(2024, 1, 6), 1, 1, D("1.00"))]
    assert rows(build(fact, ROLLUPS["daily_sales_by_product"], dims(spark))) == [(date(2024, 1, 6), 1, 1, D("1.00"))]
    assert rows(build(fact, ROLLUPS["units_by_seller"])) == [(1, 3)]
    assert rows(star_existence(fact, dims(spark)), "sale_id") == [(2,)]


@pytest.mark.parametrize("strict,units,amount", [(False, 10, "5.00"), (True, 40, "20.00")])
def test_duplicated_dimension_rows(spark, strict, units, amount):
    fact = sales(spark, (1, 1, 1, 1, ts(5), 10, "5.00"))
    twice = dims(spark, products=(1, 1), sellers=(1, 1))
    got = rows(build(fact, ROLLUPS["daily_sales_by_product"], twice, strict=strict))
    assert got == [(date(2024, 1, 5), 1, units, D(amount))]


def test_strict_equals_an_inner_join(spark):
    m = Marketplace(spark, SMALL)
    copies = {"products": m.products.unionByName(m.products.where("product_id > 50")), "sellers": m.sellers,
              "customers": m.customers.unionByName(m.customers.where("customer_id < 40"))}
    joined = m.fact_sales
    for key, table in (("product_id", "products"), ("seller_id", "sellers"), ("customer_id", "customers")):
        joined = joined.join(copies[table].select(key), key)
    want = joined.groupBy(F.to_date("sale_date").alias("sale_date"), "customer_id").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_amount").alias("total_amount"))
    got = build(m.fact_sales, ROLLUPS["daily_sales_by_customer"], copies, strict=True)
    columns = ["sale_date", "customer_id", "total_quantity", "total_amount"]
    assert rows(got, *columns) == rows(want, *columns)


def test_empty_input(spark):
    none = sales(spark)
    assert rows(build(none, ROLLUPS["average_sale_check"])) == [(D("0.00"), 0)]
    assert rows(build(none, ROLLUPS["units_by_product"])) == []
    some = sales(spark, (1, 1, 1, 1, ts(5), 10, "5.00"))
    assert rows(build(some, ROLLUPS["monthly_sales_by_seller"], dims(spark, products=()))) == []


def test_since_cuts_whole_buckets(spark):
    fact = sales(spark, (1, 1, 1, 1, ts(5), 1, "1.00"), (2, 1, 1, 1, ts(20), 1, "1.00"), (3, 1, 1, 1, ts(2, month=2), 1, "1.00"))
    by_day = build(fact, ROLLUPS["daily_sales_by_seller"], dims(spark), since=date(2024, 1, 20))
    by_month = build(fact, ROLLUPS["monthly_sales_by_seller"], dims(spark), since=date(2024, 1, 20))
    assert [r[0] for r in rows(by_day)] == [date(2024, 1, 20), date(2024, 2, 2)]
    assert [r[0] for r in rows(by_month)] == [date(2024, 2, 1)]


def test_merge_can_drop_zero_rows(spark):
    parts = spark.createDataFrame([(1, 2, 5), (1, -2, -5), (2, 1, 0)], "k long, a long, b long")
    assert rows(add_up(parts, ["k"], ["a", "b"])) == [(1, 0, 0), (2, 1, 0)]
    assert rows(add_up(parts, ["k"], ["a", "b"], drop_zero_rows=True)) == [(2, 1, 0)]


def test_merge_without_keys_adds(spark):
    one = build(sales(spark, (1, 1, 1, 1, ts(5), 1, "1.50")), ROLLUPS["average_sale_check"])
    two = build(sales(spark, (2, 1, 1, 1, ts(6), 1, "2.50"), (3, 1, 1, 1, ts(6), 1, "1.00")), ROLLUPS["average_sale_check"])
    assert rows(add_increment(one, two, [], ["total_revenue", "total_sales_count"])) == [(D("5.00"), 3)]


def test_all_in_one_pass_equals_each(spark, place):
    m = Marketplace(spark, SMALL)
    fact = m.fact_sales.withColumn("product_id", F.when(F.col("quantity") > 3, F.col("product_id")))
    known = {**m.dims, "sellers": m.sellers.where("seller_id > 2")}
    state = build_all(fact, known, place)
    for spec in ROLLUPS.values():
        assert rows(from_state(state, spec)) == rows(build(fact, spec, known)), spec.name


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_increments_of_any_split_equal_the_whole(spark, place, seed):
    m = Marketplace(spark, SMALL)
    fact = m.fact_sales.persist()
    pieces = random.Random(seed).randint(2, 4)
    piece = F.pmod(F.xxhash64("sale_id", F.lit(seed)), F.lit(pieces))
    for n in range(pieces):
        part = build_all(fact.where(piece == n), m.dims, f"{place}/ledger-{n}")
        if n == 0 and seed == 1:
            rollup_store.backfill(part, place)
        else:
            rollup_store.write_delta(part, place, n)
        if n == 1:
            rollup_store.compact(spark, place)
    want = rows(build_all(fact, m.dims, f"{place}/ledger"), *STATE_KEYS, *STATE_MEASURES)
    assert rows(rollup_store.read_state(spark, place), *STATE_KEYS, *STATE_MEASURES) == want
    last = rollup_store.compact(spark, place, settled=True)
    assert last == pieces - 1
    assert rows(rollup_store.read_state(spark, place), *STATE_KEYS, *STATE_MEASURES) == want
    assert rollup_store.compact(spark, place, settled=True) == last
    fact.unpersist()


def _state(spark, units: int, key: int = 1):
    spec = ROLLUPS["units_by_product"]
    return to_state(spark.createDataFrame([(key, units)], "product_id long, total_quantity_sold long"), spec)


def _units(spark, place):
    return rows(from_state(rollup_store.read_state(spark, place), ROLLUPS["units_by_product"]))


def test_replayed_delta_counts_once(spark, place):
    for batch_id, units in ((0, 5), (1, 7), (1, 7), (0, 5)):
        rollup_store.write_delta(_state(spark, units), place, batch_id)
    assert _units(spark, place) == [(1, 12)]


def test_a_live_fold_leaves_the_newest_batch_out(spark, place):
    rollup_store.write_delta(_state(spark, 5), place, 0)
    assert rollup_store.compact(spark, place) is None
    rollup_store.write_delta(_state(spark, 7), place, 1)
    assert rollup_store.compact(spark, place) == 0
    rollup_store.write_delta(_state(spark, 9), place, 1)  # the newest batch runs again with other content
    rollup_store.write_delta(_state(spark, 100), place, 0)  # a folded batch runs again: ignored
    assert _units(spark, place) == [(1, 14)]


def test_an_unfinished_fold_is_not_read(spark, place):
    rollup_store.write_delta(_state(spark, 5), place, 0)
    rollup_store._write(_state(spark, 999), f"{place}/base/upto=0")  # died before the fold was recorded
    assert _units(spark, place) == [(1, 5)]


def test_empty_store(spark, place):
    assert _units(spark, place) == []
    assert rows(from_state(rollup_store.read_state(spark, place), ROLLUPS["average_sale_check"])) == [(D("0.00"), 0)]


def opened(frame):
    """Files that a query's scan opens."""
    return {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}


def test_a_panel_with_a_time_range_opens_its_years_only(spark, place):
    fact = sales(spark, *[(n, 1, 1, 1, datetime(1995 + n % 6, 1 + n % 12, 2), 1, "2.00") for n in range(72)])
    spec = ROLLUPS["daily_sales_by_seller"]
    rollup_store.backfill(build_all(fact, dims(spark), f"{place}/ledger"), place)
    rollup_store.write_delta(to_state(build(sales(spark, (99, 1, 1, 1, datetime(2000, 3, 2), 5, "1.00")), spec, dims(spark)), spec), place, 0)
    since = date(1999, 6, 1)
    whole, cut = (rollup_store.read_state(spark, place, since=s).where(F.col("rollup") == spec.name) for s in (None, since))
    assert rows(cut, *STATE_KEYS, *STATE_MEASURES) == rows(whole.where(F.col("period") >= F.lit(since)), *STATE_KEYS, *STATE_MEASURES)
    rollup_store.compact(spark, place, settled=True)
    whole, cut = (rollup_store.read_state(spark, place, since=s).where(F.col("rollup") == spec.name) for s in (None, since))
    years = lambda files: {f.split("year=")[1][:4] for f in files}
    assert years(opened(cut)) == {"1999", "2000"} and years(opened(whole)) == {str(y) for y in range(1995, 2001)}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "rollup#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "year#" in plan.split("PartitionFilters: [")[1].split("], ")[0]
    # Rollups without periods are whole.
    assert rollup_store.read_state(spark, place, since=since).where("rollup = 'units_by_seller'").first()["total_quantity"] == 72
