from pyspark.sql import functions as F

from conftest import SMALL
from helpers import PRODUCT, product, rows
from tradewind.functions.ids import assign_ids, highest_id
from tradewind.plans import rollup_store
from tradewind.plans.purchases import accepted_purchases, purchase_outcomes, refused_requests
from tradewind.plans.rollups import build_all, ledger
from tradewind.registry.fixtures import Marketplace


def world(spark):
    sessions = spark.createDataFrame([("c", 1, None), ("s", 2, None), ("gone", 9, None)], "session_token string, user_id long, session_end timestamp")
    users = spark.createDataFrame([(1, "customer"), (2, "seller")], "user_id long, user_role string")
    products = spark.createDataFrame([product(7, "A", price="2.50", seller=4)], PRODUCT)
    return sessions, users, products


def requests(spark, *values):
    return spark.createDataFrame(list(values), "request_id long, session_token string, product_id long, quantity int")


def test_every_request_has_an_outcome(spark):
    asked = requests(spark, (1, "c", 7, 2), (2, "s", 7, 1), (3, "gone", 7, 1), (4, "no", 7, 1), (5, None, 7, 1), (6, "c", 8, 1), (7, "c", None, 1))
    outcomes = purchase_outcomes(asked, *world(spark))
    assert rows(outcomes, "request_id", "status") == [(1, 200), (2, 403), (3, 404), (4, 401), (5, 401), (6, 400), (7, 400)]
    sold = accepted_purchases(outcomes, 1000, ["request_id"])
    assert rows(sold, "sell_id", "customer_id", "price", "seller_id") == [(1_000_000, 1, product(7, "A", price="2.50")[3], 4)]
    assert refused_requests(outcomes).count() + sold.count() == asked.count()


def test_batches_close_in_time_share_no_id(spark):
    first = assign_ids(spark.range(10_000).select(F.col("id").alias("n")), 1000, ["n"], "new_id").cache()
    second = assign_ids(spark.range(100).select(F.col("id").alias("n")), 1005, ["n"], "new_id", highest_id(first, "new_id"))
    assert first.unionByName(second).select("new_id").distinct().count() == 10_100
    assert second.agg(F.min("new_id")).first()[0] == highest_id(first, "new_id") + 1
    assert assign_ids(second.select("n"), 2000, ["n"], "new_id", 5).agg(F.min("new_id")).first()[0] == 2_000_000


def test_rows_without_a_sale_are_synced(spark):
    m = Marketplace(spark, SMALL.replace("0.001", "0.1"))
    assert m.customers_src.count() == m.customers.count() == 15_000
    assert m.products_src.count() == m.products.count() and m.sellers_src.count() == m.sellers.count()


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_the_ledger_reads_the_fact_once(spark):
    m = Marketplace(spark, SMALL)
    assert scans(ledger(m.fact_sales, m.dims)) == 5  # lines, orders and three dimensions


def test_a_panel_reads_its_rollup_only(spark, place):
    m = Marketplace(spark, SMALL)
    rollup_store.backfill(build_all(m.fact_sales, m.dims, f"{place}/ledger"), place)
    read = rollup_store.read_state(spark, place).where("rollup = 'revenue_by_seller'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert scans(read) == 1 and "rollup#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_repeated_keys_of_a_backfill_are_added_up(spark, place):
    m = Marketplace(spark, SMALL)
    state = build_all(m.fact_sales.limit(50), m.dims, f"{place}/ledger").cache()
    rollup_store.backfill(state.unionByName(state), place)
    before = rows(rollup_store.read_state(spark, place).select(*state.columns))
    rollup_store.write_delta(state.limit(0), place, 0)
    assert rows(rollup_store.read_state(spark, place).select(*state.columns)) == before and len(before) == state.count()


def test_folded_parts_are_removed(spark, place):
    m = Marketplace(spark, SMALL)
    state = build_all(m.fact_sales.limit(40), m.dims, f"{place}/ledger").cache()
    for batch in range(6):
        rollup_store.write_delta(state, place, batch)
        if batch in (1, 3, 5):
            rollup_store.compact(spark, place)
    want = rows(rollup_store.read_state(spark, place).select(*state.columns))
    assert rollup_store.prune(spark, place, keep=3) == ["delta/batch_id=0"]
    assert rollup_store.prune(spark, place) == ["base/upto=0", "delta/batch_id=1", "delta/batch_id=2"]
    assert rollup_store.prune(spark, place) == []
    rollup_store.write_delta(state, place, 2)  # a replay of a batch that was folded and removed
    assert rows(rollup_store.read_state(spark, place).select(*state.columns)) == want
