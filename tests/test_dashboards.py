from datetime import date
from decimal import Decimal as D

from helpers import dims, rows, sales, ts

from tradewind.plans.dashboards import PANELS, average_check, panel
from tradewind.plans.rollups import ROLLUPS, build


def _named(spark, key, *pairs):
    return spark.createDataFrame(list(pairs), f"{key} long, username string, batch_time timestamp")


def test_top_ten_breaks_ties_by_id(spark):
    rollup = spark.createDataFrame([(i, 5) for i in range(11, 0, -1)], "seller_id long, total_quantity_sold long")
    sellers = _named(spark, "seller_id", *[(i, f"s{i:02d}", ts(1)) for i in range(1, 12)])
    got = [r[0] for r in panel(rollup, PANELS["dash_top_sellers_by_quantity"], sellers).collect()]
    assert got == [f"s{i:02d}" for i in range(1, 11)]


def test_top_ten_fills_up_when_the_first_has_no_name(spark):
    rollup = spark.createDataFrame([(i, 100 - i) for i in range(12)], "seller_id long, total_quantity_sold long")
    sellers = _named(spark, "seller_id", *[(i, f"s{i:02d}", ts(1)) for i in range(2, 12)])
    got = [r[0] for r in panel(rollup, PANELS["dash_top_sellers_by_quantity"], sellers).collect()]
    assert got == [f"s{i:02d}" for i in range(2, 12)]


def test_newest_name_is_shown_once(spark):
    fact = sales(spark, (1, 1, 1, 1, ts(5), 1, "2.00"))
    loads = _named(spark, "seller_id", (1, "old", ts(1)), (1, "new", ts(3)), (1, "older", ts(2)))
    spec = PANELS["dash_daily_sales_by_seller"]
    got = rows(panel(build(fact, spec.spec, dims(spark)), spec, loads))
    assert got == [(date(2024, 1, 5), "new", 1, D("2.00"))]


def test_series_is_sorted_and_cut(spark):
    fact = sales(spark, (1, 1, 1, 1, ts(7), 1, "2.00"), (2, 1, 1, 2, ts(6), 1, "2.00"), (3, 1, 1, 1, ts(6), 1, "2.00"),
                 (4, 1, 1, 1, ts(1), 1, "2.00"))
    sellers = _named(spark, "seller_id", (1, "b", ts(1)), (2, "a", ts(1)))
    view = PANELS["dash_daily_sales_by_seller"]
    got = panel(build(fact, view.spec, dims(spark)), view, sellers, since=date(2024, 1, 2)).collect()
    assert [(r[0].day, r[1]) for r in got] == [(6, "a"), (6, "b"), (7, "b")]


def test_amount_panel_hides_units(spark):
    view = PANELS["dash_daily_product_amount"]
    products = spark.createDataFrame([(1, "p")], "product_id long, product_name string")
    fact = sales(spark, (1, 1, 1, 1, ts(5), 1, "2.00"))
    assert panel(build(fact, view.spec, dims(spark)), view, products).columns == ["sale_date", "product_name", "total_amount"]


def test_average_check(spark):
    fact = sales(spark, (1, 1, 1, 1, ts(5), 1, "2.00"), (2, 1, 1, 1, ts(5), 1, "3.00"))
    assert rows(average_check(build(fact, ROLLUPS["average_sale_check"]))) == [(D("2.500000"),)]
    assert rows(average_check(build(sales(spark), ROLLUPS["average_sale_check"]))) == [(None,)]
