"""Plans and results under skew: one key holds a third of all rows, and no side is broadcast."""

from contextlib import ExitStack
from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tradewind.functions.ids import assign_ids
from tradewind.operators.access import authorise
from tradewind.operators.enrich import enrich, price_sales, unknown_products
from tradewind.operators.keyed import first_by_key, newest_by_key
from tradewind.plans import rollup_store, rollups
from tradewind.plans.rollups import ROLLUPS, STATE_KEYS, STATE_MEASURES, build, build_all, from_state, key_copies, star_existence, to_state
from tradewind.registry.fixtures import Marketplace
from tradewind.sources.tables import setting

from conftest import SMALL

TIGHT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def tight(spark):
    with ExitStack() as stack:
        for key, value in TIGHT.items():
            stack.enter_context(setting(spark, key, value))
        yield spark


@pytest.fixture
def skewed(spark, place):
    """60,000 purchases, a third of them of product 7; a catalogue in which product 9 is stored very often."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 700)
    spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("sell_id"), (F.col("id") % 97).alias("customer_id"), key.cast("long").alias("product_id"),
        (1 + F.col("id") % 5).cast("int").alias("quantity"), F.concat(F.lit("t"), key.cast("string")).alias("session_token"),
        F.lit("customer").alias("needed_role")).write.parquet(f"{place}/purchases")
    loads = spark.range(0, 900, 1, 4).select(F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 500).cast("long").alias("product_id"),
                                             (F.col("id") % 50).cast("decimal(18,2)").alias("price"), (F.col("id") % 5).alias("seller_id"),
                                             F.timestamp_seconds("id").alias("updated_at"))
    loads.write.parquet(f"{place}/products")
    return spark.read.parquet(f"{place}/purchases"), spark.read.parquet(f"{place}/products")


def ran(df):
    """Run a query to the end and return its final plan; the extra grouping keeps all columns in use."""
    out = df.groupBy((F.hash(*df.columns) % 5).alias("g")).count()
    out.collect()
    return out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_lookups_split_a_hot_key(tight, skewed):
    purchases, products = skewed
    tokens = products.groupBy(F.concat(F.lit("t"), F.col("product_id").cast("string")).alias("session_token")).agg(
        F.max("product_id").alias("user_id"), F.lit(None).cast("timestamp").alias("session_end"))
    users = tokens.select("user_id", F.lit("customer").alias("user_role")).distinct()
    for df in (enrich(purchases, products), price_sales(purchases, products), unknown_products(purchases, products),
               authorise(purchases, tokens, users)):
        plan = ran(df)
        assert "SortMergeJoin(skew=true)" in plan
        assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_star_and_strict_joins_split_a_hot_key(tight, skewed):
    purchases, products = skewed
    dims = {"products": products, "sellers": products.select(F.col("product_id").alias("seller_id")),
            "customers": products.select(F.col("product_id").alias("customer_id"))}
    fact = purchases.withColumn("seller_id", F.col("product_id"))
    assert ran(star_existence(fact, dims)).count("skew=true") >= 2
    assert "skew=true" in ran(fact.join(key_copies(products, "product_id", "n"), "product_id"))


def test_results_under_skew_equal_plain_ones(tight, skewed):
    purchases, products = skewed
    newest = {}
    for r in products.collect():
        if r.product_id not in newest or r.updated_at > newest[r.product_id].updated_at:
            newest[r.product_id] = r
    bought = purchases.collect()
    want = sorted((b.sell_id, newest[b.product_id].price) for b in bought if b.product_id in newest)
    assert rows(enrich(purchases, products).select("sell_id", "price").orderBy("sell_id")) == sorted(want, key=repr)
    assert unknown_products(purchases, products).count() == len(bought) - len(want)
    assert rows(newest_by_key(products, "product_id", "updated_at"), "product_id", "updated_at") == sorted(
        ((k, r.updated_at) for k, r in newest.items()), key=repr)
    first = rows(first_by_key(products, "product_id", "updated_at"), "product_id")
    assert len(first) == len(newest)


def test_keyed_picks_combine_before_the_shuffle(spark, skewed):
    _, products = skewed
    plan = newest_by_key(products, "product_id", "updated_at")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_ids_are_dense_and_ordered_whatever_the_partitioning(spark):
    for parts in (1, 7):
        frame = spark.range(0, 5000, 1, parts).select((F.col("id") * 13 % 5000).alias("n"), F.lit("x").alias("t"))
        numbered = assign_ids(frame, 5, ["t", "n"], "new_id")
        assert numbered.where(F.col("new_id") != F.lit(5000) + F.col("n")).count() == 0 and numbered.count() == 5000
    assert assign_ids(spark.range(0).select(F.col("id").alias("n")), 5, ["n"], "new_id").count() == 0


def test_rollup_reads_only_its_columns(spark, place):
    m = Marketplace(spark, SMALL)
    m.fact_sales.write.parquet(place)
    plan = build(spark.read.parquet(place), ROLLUPS["units_by_product"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<product_id:bigint,quantity:int>" in plan
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_since_reaches_the_scan(spark, place):
    from datetime import date
    m = Marketplace(spark, SMALL)
    m.fact_sales.write.parquet(place)
    plan = build(spark.read.parquet(place), ROLLUPS["daily_sales_by_seller"], m.dims, since=date(2000, 1, 1))
    assert "GreaterThanOrEqual(sale_date" in plan._jdf.queryExecution().executedPlan().toString()


def sold(spark, place, keys=4000):
    """60,000 sales over 700 days; a third of them are of product 7 and a third of the products' keys are null or unknown."""
    spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 11 > 0, F.col("id")).alias("sale_id"), (F.col("id") % 3001).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 > 0, F.col("id") % keys).cast("long").alias("product_id"), (F.col("id") % 97).alias("seller_id"),
        F.timestamp_seconds(F.lit(852_076_800) + F.col("id") * 1009).alias("sale_date"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 5).cast("int").alias("quantity"), (F.col("id") % 1000 / 8).cast("decimal(18,2)").alias("total_amount")
    ).write.parquet(f"{place}/fact")
    known = {"products": keys - 5, "customers": 3001, "sellers": 96}
    return spark.read.parquet(f"{place}/fact"), {t: spark.range(n).select(F.col("id").alias(f"{t[:-1]}_id")) for t, n in known.items()}


def test_a_key_is_dealt_out_once_for_all_levels_unless_it_is_hot(tight, place, monkeypatch):
    monkeypatch.setattr(rollups, "SALES_A_TASK", 10_000)
    fact, dims = sold(tight, place)
    state = build_all(fact, dims, f"{place}/all").persist()
    for spec in ROLLUPS.values():
        assert rows(from_state(state, spec)) == rows(build(fact, spec, dims)), spec.name
    lies = state.withColumn("task", F.spark_partition_id()).where("rollup like '%product'")
    at = {r.key_id: r.tasks for r in lies.groupBy("key_id").agg(F.count_distinct("task").alias("tasks")).collect()}
    # At most 1000 keys can be taken for hot ones.
    assert sum(n == 1 for n in at.values()) >= 2800 and at[7] > 1
    assert max(lies.groupBy("task").agg(F.count_distinct("key_id")).collect(), key=lambda r: r[1])[1] < 1000
    state.unpersist()


def test_all_rollups_of_no_sales(spark, place):
    fact, dims = sold(spark, place)
    assert build_all(fact.limit(0), dims, f"{place}/all").count() == 0


STATE = [*STATE_KEYS, *STATE_MEASURES]


def test_a_built_state_is_written_and_folded_without_dealing_it_out_again(tight, place, monkeypatch):
    fact, dims = sold(tight, place)
    before = F.col("sale_date") < F.lit("1998-01-01").cast("timestamp")
    ranged = []
    monkeypatch.setattr(rollup_store, "_ranged", lambda state, deal=rollup_store._ranged: ranged.append(state) or deal(state))
    rollup_store.backfill(build_all(fact.where(before), dims, f"{place}/a"), f"{place}/store", built=True)
    assert not ranged
    rollup_store.write_delta(build_all(fact.where(~before), dims, f"{place}/b"), f"{place}/store", 0, built=True)
    want = rows(build_all(fact, dims, f"{place}/c"), *STATE)
    assert rows(rollup_store.read_state(tight, f"{place}/store"), *STATE) == want
    rollup_store.compact(tight, f"{place}/store", settled=True)
    assert rows(rollup_store.read_state(tight, f"{place}/store"), *STATE) == want
    # Years that one part has are moved; only rollups without a period are added up.
    assert [r[0] for r in ranged[0].select("period").distinct().collect()] == [None]
    got = tight.read.parquet(f"{place}/store/base/upto=0").where("rollup = 'daily_sales_by_product'").select("period", F.input_file_name().alias("f"))
    by_file = {}
    for r in got.collect():
        by_file.setdefault(r.f, []).append(r.period)
    assert by_file and all(p == sorted(p) for p in by_file.values())


@pytest.mark.parametrize("drop", [False, True])
def test_a_fold_adds_up_keys_that_a_delta_repeats(spark, place, drop):
    spec = ROLLUPS["daily_sales_by_seller"]
    def state(*found):
        return to_state(spark.createDataFrame(found, "sale_date string, seller_id long, total_quantity long, total_amount decimal(18,2)")
                        .withColumn("sale_date", F.to_date("sale_date")), spec)
    one = D("1.00")
    rollup_store.backfill(state(("1997-05-01", 1, 2, one), ("1997-05-02", None, 0, D(0)), (None, 3, 4, one)), place)
    rollup_store.write_delta(state(("1998-05-01", 1, 2, one), ("1998-05-01", 1, 3, one)), place, 0)
    rollup_store.write_delta(state(("1999-05-01", 1, 2, one), ("1999-05-02", 1, 0, D(0))), place, 1, built=True)
    rollup_store.write_delta(state(("2000-05-01", 1, 9, one)), place, 2, built=True)
    rollup_store.write_delta(state(("2000-05-01", 1, 5, one), ("2000-05-01", 1, 6, one)), place, 2)  # runs again: no longer marked
    want = rows(rollup_store.read_state(spark, place, drop_zero_rows=drop), *STATE)
    assert [r[3] for r in want if r[1] and r[1].year in (1998, 2000)] == [5, 11] and len(want) == 5 + 2 * (not drop)
    rollup_store.compact(spark, place, settled=True, drop_zero_rows=drop)
    assert rows(rollup_store.read_state(spark, place), *STATE) == want
