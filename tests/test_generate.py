from helpers import rows, ts
from pyspark.sql import functions as F

from tradewind.sources import generate


def sample(spark, seed=1):
    products = generate.products(spark, 200, 20, seed, ts(28))
    return products, generate.sales(spark, 10_000, 100, 20, products, 200, seed, ts(28))


def test_same_seed_same_rows(spark):
    assert rows(sample(spark)[1].limit(50).orderBy("sale_id")) == rows(sample(spark)[1].limit(50).orderBy("sale_id"))
    total = [sample(spark, seed)[1].agg(F.sum("total_amount")).first()[0] for seed in (1, 1, 2)]
    assert total[0] == total[1] != total[2]


def test_value_rules(spark):
    products, sales = sample(spark)
    low, high, kinds, sellers = products.agg(F.min("price"), F.max("price"), F.count_distinct("category"), F.max("seller_id")).first()
    assert 5 <= low and high <= 1000 and kinds == 5 and sellers <= 20
    units = {r[0] for r in sales.select("quantity").distinct().collect()}
    assert units == {1, 2, 3, 4, 5} and sales.count() == 10_000
    wrong = sales.join(products.select("product_id", "price"), "product_id").where("total_amount <> round(price * quantity, 2)")
    assert wrong.count() == 0
    span = sales.agg(F.min("sale_date"), F.max("sale_date"), F.count_distinct("customer_id"), F.count_distinct("product_id")).first()
    assert (ts(28) - span[0]).days < 60 and span[1] < ts(28) and span[2] == 100 and span[3] == 200
    assert products.where("created_at > updated_at").count() == 0


def test_unknown_product_has_the_fixed_price(spark):
    none = generate.products(spark, 0, 20, 1, ts(28))
    sales = generate.sales(spark, 100, 10, 5, none, 200, 1, ts(28))
    assert sales.where("total_amount <> 50 * quantity").count() == 0


def test_accounts(spark):
    people, shops = generate.customers(spark, 100, 1, ts(28)), generate.sellers(spark, 20, 1, ts(28))
    assert rows(people.agg(F.min("customer_id"), F.max("customer_id"), F.count("customer_id"))) == [(1, 100, 100)]
    assert shops.where(F.col("username").endswith(" Seller")).count() == 20
    assert people.where("created_at > updated_at or updated_at > timestamp'2024-01-28'").count() == 0
