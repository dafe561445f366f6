from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from helpers import rows, ts

from tradewind.functions.columns import EPOCH
from tradewind.plans.sync import DIMENSIONS, add_load, compact_table, dimension, load, new_rows, run_daily, watermark
from tradewind.schemas import WAREHOUSE
from tradewind.sources import files, folded, tables
from tradewind.sources.tables import (append, conform, high_watermark, high_watermark_jdbc, jdbc_options,
                                      read_or_empty, read_table, table_exists, table_listed)

ACCOUNT = "id int, username string, created_at timestamp, updated_at timestamp"
LOW, HIGH = ts(10), ts(11)


def accounts(spark, *times):
    return spark.createDataFrame([(i, f"user'{i}", t, t) for i, t in enumerate(times)], ACCOUNT)


def test_window_is_half_open_and_stamped(spark):
    source = accounts(spark, LOW, LOW + timedelta(seconds=1), HIGH, HIGH + timedelta(seconds=1))
    got = new_rows(source, DIMENSIONS["customers"], LOW, HIGH)
    assert got.columns == ["customer_id", "username", "created_at", "updated_at", "batch_time"]
    assert rows(got, "customer_id", "batch_time") == [(1, HIGH), (2, HIGH)]


def test_two_runs_load_each_row_once(spark, place):
    spec = DIMENSIONS["sellers"]
    assert load(spark, accounts(spark, ts(9), LOW), spec, place, LOW) == 2
    # A row created at the very end of the first run, one in between, and one after the second.
    later = accounts(spark, ts(9), LOW, LOW + timedelta(seconds=1), HIGH, ts(12))
    assert load(spark, later, spec, place, HIGH) == 2
    assert load(spark, later, spec, place, HIGH) == 0
    assert rows(dimension(spark, place, "sellers"), "seller_id", "batch_time") == [(0, LOW), (1, LOW), (2, HIGH), (3, HIGH)]


def test_changed_rows_on_request(spark):
    source = spark.createDataFrame([(1, "a", ts(1), ts(10, 12)), (2, "b", ts(1), ts(2))], ACCOUNT)
    assert rows(new_rows(source, DIMENSIONS["customers"], LOW, HIGH)) == []
    assert rows(new_rows(source, DIMENSIONS["customers"], LOW, HIGH, changed_since=True), "customer_id") == [(1,)]


def test_watermark_of_an_empty_table_is_the_epoch(spark, place):
    assert high_watermark(read_or_empty(spark, place, WAREHOUSE["customers"])) == EPOCH
    assert not files.exists(spark, place)


def test_daily_run_stops_at_the_first_error(spark, place):
    def broken():
        raise ConnectionError("no database")

    sources = {"customers": lambda: accounts(spark, LOW), "sellers": broken, "products": broken}
    with pytest.raises(ConnectionError):
        run_daily(spark, sources, place, HIGH)
    assert files.exists(spark, f"{place}/customers") and not files.exists(spark, f"{place}/products")


def test_conform_fills_defaults_and_types(spark):
    got = conform(spark.createDataFrame([(1, 2, 3, 4, 5)], "sale_id long, customer_id long, product_id long, seller_id long, quantity long"),
                  "fact_sales")
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in WAREHOUSE["fact_sales"].fields]
    (row,) = got.collect()
    assert (row.sale_id, row.quantity, str(row.total_amount)) == (1, 5, "0.00")
    assert row.sale_date == row.batch_time == datetime(1970, 1, 1)


def test_compaction_keeps_rows_and_sorts_them(spark, place):
    spec = DIMENSIONS["customers"]
    load(spark, accounts(spark, ts(9), ts(8), ts(7)), spec, place, LOW)
    load(spark, accounts(spark, ts(9), ts(10, 5)), spec, place, HIGH)
    before = rows(dimension(spark, place, "customers"))
    compact_table(spark, place, "customers")
    after = dimension(spark, place, "customers")
    assert rows(after) == before
    keys = [(r.batch_time, r.customer_id) for r in after.coalesce(1).collect()]
    assert keys == sorted(keys)


def folders(table):
    return sorted({"/".join(f.split("/")[-3:-1]) for f in table.inputFiles()})


def test_daily_runs_read_the_newest_generation_and_later_loads(spark, place):
    """Watermark, load and readers go by the generation; what it replaces is gone, and a load that died is not seen."""
    def run(until, batch_time, compact):
        source = accounts(spark, *[ts(day) for day in range(1, until)])
        items = source.select(F.col("id").cast("long").alias("product_id"), F.lit("p").alias("product_name"), F.lit("").alias("product_description"),
                              F.lit("A").alias("category"), F.lit(1).cast("decimal(18,2)").alias("price"), F.lit(1).cast("long").alias("seller_id"),
                              "created_at", "updated_at")
        return run_daily(spark, {"customers": lambda: source, "sellers": lambda: source, "products": lambda: items}, place, batch_time, compact)

    assert run(5, ts(4, 12), True) == {"customers": 4, "sellers": 4, "products": 4}
    assert run(8, ts(7, 12), True) == {"customers": 3, "sellers": 3, "products": 3}
    for table in DIMENSIONS:
        assert folders(dimension(spark, place, table)) == ["folded/0-1-1"]
        assert files.names(spark, f"{place}/{table}/folded") == ["0-1-1"] and files.names(spark, f"{place}/{table}/batch") == []
    assert run(9, ts(8, 12), False) == {"customers": 1, "sellers": 1, "products": 1}
    assert folders(dimension(spark, place, "sellers")) == ["batch/2", "folded/0-1-1"]
    files.remove(spark, f"{place}/sellers/batch/2/_SUCCESS")  # as if that load had died
    assert high_watermark(dimension(spark, place, "sellers")) == ts(7, 12).replace(tzinfo=timezone.utc)
    assert run(9, ts(8, 13), False) == {"customers": 0, "sellers": 1, "products": 0}
    assert rows(dimension(spark, place, "sellers"), "seller_id") == [(n,) for n in range(8)]


def test_the_watermark_comes_from_footers(spark, place):
    assert watermark(spark, place, "sellers") == EPOCH
    for stamp in (ts(7, 12), ts(9, 1, 2, 3)):
        add_load(accounts(spark, ts(1), ts(2)).withColumnRenamed("id", "seller_id").withColumn("batch_time", F.lit(stamp)), place, "sellers")
    add_load(accounts(spark).withColumnRenamed("id", "seller_id"), place, "sellers")  # a load without rows
    assert watermark(spark, place, "sellers") == ts(9, 1, 2, 3).replace(tzinfo=timezone.utc)
    places = folded.paths(spark, f"{place}/sellers")
    with tables._footer_reads(spark):
        plan = tables.newest_stored(spark, places[:2], WAREHOUSE["sellers"], "batch_time")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(batch_time)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    # Times that are all null have no statistics.
    add_load(accounts(spark, ts(1)).withColumnRenamed("id", "seller_id").withColumn("batch_time", F.lit(None).cast("timestamp")), place, "sellers")
    assert watermark(spark, place, "sellers") == ts(9, 1, 2, 3).replace(tzinfo=timezone.utc)


def test_replaced_files_may_stay_for_readers(spark, place):
    for n in range(2):
        add_load(accounts(spark, ts(9)).withColumnRenamed("id", "seller_id"), place, "sellers")
    early = dimension(spark, place, "sellers")
    compact_table(spark, place, "sellers", keep_replaced=True)
    assert early.count() == dimension(spark, place, "sellers").count() == 2
    assert folders(early) == ["batch/0", "batch/1"] and folders(dimension(spark, place, "sellers")) == ["folded/0-1-0"]
    compact_table(spark, place, "sellers")
    assert files.names(spark, f"{place}/sellers/batch") == []


def test_jdbc_source_and_sink(spark):
    """Derby in memory: visible to this process only, which is all a local session has."""
    url = "jdbc:derby:memory:synctest;create=true"
    source = accounts(spark, ts(9), LOW, ts(10, 1), HIGH)
    append(source, "jdbc", **jdbc_options(url, "accounts"))
    read = read_table(spark, "jdbc", **jdbc_options(url, "accounts", "id", (0, 4), 2))
    assert read.rdd.getNumPartitions() == 2
    fresh = new_rows(read, DIMENSIONS["customers"], LOW, HIGH)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "*GreaterThan(created" in plan and "*LessThanOrEqual(created" in plan
    assert rows(fresh, "customer_id") == [(2,), (3,)]
    assert append(fresh, "jdbc", **jdbc_options(url, "customers")) == 2
    assert high_watermark_jdbc(spark, url, "customers") == HIGH.replace(tzinfo=timezone.utc)
    append(fresh.where("false"), "jdbc", **jdbc_options(url, "nothing"))
    assert high_watermark_jdbc(spark, url, "nothing") == EPOCH


def test_pushdown_on_the_warehouse(spark, place):
    append(conform(new_rows(accounts(spark, ts(9)), DIMENSIONS["customers"], EPOCH, LOW), "customers"), "parquet", f"{place}/customers")
    stored = spark.read.schema(WAREHOUSE["customers"]).parquet(f"{place}/customers").withColumnRenamed("customer_id", "id")
    plan = new_rows(stored, DIMENSIONS["customers"], LOW, HIGH).select("customer_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_at" in plan and "username" not in plan.split("ReadSchema")[1]


def test_table_preconditions(spark):
    spark.sql("create database if not exists preconditions")
    spark.sql("create table if not exists preconditions.here (a int) using parquet")
    for check in (table_exists, table_listed):
        assert check(spark, "preconditions", "here") and not check(spark, "preconditions", "gone")
    assert read_table(spark, "table", "preconditions.here").columns == ["a"]
    spark.sql("drop table preconditions.here")
