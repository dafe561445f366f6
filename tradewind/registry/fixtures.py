"""The test tables as the marketplace's tables. ``oracles.py`` holds the same mapping as SQL text."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.functions.columns import at, money
from tradewind.plans.accounts import sessionise_logins
from tradewind.plans.purchases import accepted_purchases, purchase_outcomes
from tradewind.plans.sync import DIMENSIONS, new_rows
from tradewind.session import prepare

# Run times of the sample: what the warehouse holds already, this run, and the days users and edits are taken from.
LOADED = datetime(1995, 1, 6)
BATCH = datetime(1995, 3, 1)
USERS_UNTIL = datetime(2024, 1, 4)
REGISTERED_UNTIL = datetime(2024, 1, 15)
EDITED_SINCE = datetime(2001, 7, 1)
NOW = datetime(2024, 2, 1)
BASE_MS = 1_706_745_600_000  # NOW in epoch milliseconds
SINCE = datetime(2001, 8, 6).date()
SPLIT = datetime(1998, 1, 1)
UNSOLD = datetime(1992, 1, 1)

_SCHEMAS: dict[tuple[str, str], StructType] = {}


class Marketplace:
    """All views of one data folder. Nothing is read until a view is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = prepare(spark), sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is looked up in the files once per session, as a catalogue would know it."""
        path = f"{self.dir}/{name}.parquet"
        known = (self.spark.sparkContext.applicationId, path)
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)

    # --- star schema ---

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("username"))

    @cached_property
    def sellers(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("username"))

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("product_description"), F.col("p_type").alias("category"),
            money("p_retailprice").alias("price"), F.expr("p_partkey div 20").alias("seller_id"))

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {"products": self.products, "sellers": self.sellers, "customers": self.customers}

    @cached_property
    def fact_sales(self) -> DataFrame:
        """A line and its order. The line number does not make the sale id unique; nothing in the fact asks for that.

        Orders grow with the lines, so this is a shuffle join at any scale, never a broadcast of orders.
        """
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                              "l_quantity", "l_extendedprice")
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return lines.join(orders.hint("merge"), "l_orderkey").select(
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("sale_id"),
            F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"), F.col("l_shipdate").cast("timestamp").alias("sale_date"),
            F.col("l_quantity").cast("int").alias("quantity"), money("l_extendedprice").alias("total_amount"))

    @cached_property
    def sale_lines(self) -> DataFrame:
        """Sales without their customers: each line has its order, so rollups that name no customer need no join."""
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("sale_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"), F.col("l_shipdate").cast("timestamp").alias("sale_date"),
            F.col("l_quantity").cast("int").alias("quantity"), money("l_extendedprice").alias("total_amount"))

    # --- sources of the syncs: a row exists from its first sale on, one without a sale from UNSOLD on ---

    @cached_property
    def customers_src(self) -> DataFrame:
        first = self.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(
            F.min(F.col("o_orderdate")).cast("timestamp").alias("created_at"))
        names = self.customers.withColumnRenamed("customer_id", "id")
        return names.join(first, "id", "left").withColumn("created_at", F.coalesce("created_at", at(UNSOLD))).withColumn(
            "updated_at", F.col("created_at"))

    @cached_property
    def sellers_src(self) -> DataFrame:
        first = self.table("lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(
            F.min(F.col("l_shipdate")).cast("timestamp").alias("created_at"))
        names = self.sellers.withColumnRenamed("seller_id", "id")
        return names.join(first, "id", "left").withColumn("created_at", F.coalesce("created_at", at(UNSOLD))).withColumn(
            "updated_at", F.col("created_at"))

    @cached_property
    def products_src(self) -> DataFrame:
        sold = self.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
            F.min("l_shipdate").cast("timestamp").alias("created_at"),
            F.max("l_shipdate").cast("timestamp").alias("updated_at"))
        unsold = {c: F.coalesce(c, at(UNSOLD)) for c in ("created_at", "updated_at")}
        return self.products.join(sold, "product_id", "left").withColumns(unsold)

    def loaded(self, table: str) -> DataFrame:
        """What an earlier run at ``LOADED`` put into the warehouse."""
        return new_rows(getattr(self, f"{table}_src"), DIMENSIONS[table], datetime(1970, 1, 1), LOADED)

    # --- catalogue ---

    @cached_property
    def products_target(self) -> DataFrame:
        """The catalogue at the time of ``BATCH``."""
        return self.products_src.where(F.col("created_at") <= at(BATCH))

    @cached_property
    def product_edits(self) -> DataFrame:
        """New versions of the products sold lately; some move to another category, some are not in the catalogue."""
        size = self.table("part").select(F.col("p_partkey").alias("product_id"), "p_size")
        moved = F.when(F.col("p_size") > 40, F.lit("MOVED")).otherwise(F.col("category"))
        return (self.products_src.where(F.col("updated_at") >= at(EDITED_SINCE)).join(size, "product_id")
                .withColumn("product_name", F.concat("product_name", F.lit(" v2"))).withColumn("category", moved)
                .withColumn("price", (F.col("price") * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(18,2)"))
                .drop("p_size"))

    @cached_property
    def update_documents(self) -> DataFrame:
        """Update records as JSON; small products come without a description."""
        small = self.table("part").where(F.col("p_size") < 10).select(
            F.col("p_partkey").alias("product_id"), F.lit(True).alias("small"))
        edits = self.products_src.join(small, "product_id", "left")
        text = F.when(F.col("small").isNull(), F.col("product_description"))
        record = F.struct("product_id", "product_name", "price", text.alias("product_description"), "created_at",
                          "updated_at", "category", "seller_id")
        return edits.select(F.col("product_id").alias("record_id"), F.to_json(record).alias("document"))

    # --- accounts and requests, from the event log ---

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("long")
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), k.alias("k"),
            F.concat(F.lit("tok"), F.col("user_id").cast("string"), F.lit("-"), k.cast("string")).alias("session_token"),
            (F.col("user_id") * 20 + k).alias("product_id"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"),
            F.when(F.col("user_id") % 2 == 0, "customer").otherwise("seller").alias("role"))

    def _of(self, kind: str) -> DataFrame:
        return self.events.where(F.col("event_type") == kind)

    @cached_property
    def users(self) -> DataFrame:
        """Users who signed up in the first days."""
        early = self._of("signup").where(F.col("ts") <= at(USERS_UNTIL))
        return early.select("user_id", F.col("login").alias("user_login"), F.col("role").alias("user_role")).distinct()

    @cached_property
    def session_log(self) -> DataFrame:
        """Signups log a token in, errors log it out."""
        action = F.when(F.col("event_type") == "signup", "login").otherwise("logout")
        return (self.events.where(F.col("event_type").isin("signup", "error"))
                .select("session_token", "user_id", action.alias("action"), "ts"))

    @cached_property
    def sessions(self) -> DataFrame:
        return sessionise_logins(self.session_log)

    @cached_property
    def registrations(self) -> DataFrame:
        role = F.when(F.col("value") >= 100, "admin").otherwise(F.col("role"))
        return self._of("signup").select(F.col("event_id").alias("request_id"), F.col("login").alias("username"),
                                         role.alias("user_role"), F.col("ts").alias("created_at"))

    @cached_property
    def requests(self) -> DataFrame:
        """Every event as a request: purchases are for customers, all else for sellers."""
        needed: Column = F.when(F.col("event_type") == "purchase", "customer").otherwise("seller")
        return self.events.select(F.col("event_id").alias("request_id"), "session_token", needed.alias("needed_role"))

    @cached_property
    def edit_requests(self) -> DataFrame:
        """Clicks as edit requests. The id arrives as text; a request without a price leaves it as it is."""
        return self._of("click").select(
            F.col("event_id").alias("request_id"), "session_token", F.col("product_id").cast("string").alias("product_id"),
            F.concat(F.lit("edit "), F.col("event_id").cast("string")).alias("product_name"),
            F.when(F.col("value") >= 10, money("value")).alias("price"))

    @cached_property
    def add_requests(self) -> DataFrame:
        """Views as requests to add a product."""
        return self._of("view").select(
            F.col("event_id").alias("request_id"), "session_token",
            F.concat(F.lit("new "), F.col("event_id").cast("string")).alias("product_name"),
            F.lit(None).cast("string").alias("product_description"),
            F.concat(F.lit("CATEGORY "), (F.col("k") % 5).cast("string")).alias("category"), F.col("value").alias("price"))

    @cached_property
    def purchases(self) -> DataFrame:
        """Purchases; the product may be one that the catalogue does not have."""
        return self._of("purchase").select(
            F.col("event_id").alias("sell_id"), F.col("user_id").alias("customer_id"), "product_id",
            (1 + F.col("event_id") % 5).cast("int").alias("quantity"), "ts")

    @cached_property
    def purchase_requests(self) -> DataFrame:
        """Purchases as they are asked for: a session token, a product and a quantity."""
        return self._of("purchase").select(
            F.col("event_id").alias("request_id"), "session_token", "product_id",
            (1 + F.col("event_id") % 5).cast("int").alias("quantity"), "ts")

    @cached_property
    def accepted(self) -> DataFrame:
        """The requests that pass the gate, as purchases."""
        outcomes = purchase_outcomes(self.purchase_requests, self.sessions, self.users, self.products)
        return accepted_purchases(outcomes, BASE_MS, ["request_id"])

    @cached_property
    def stray_messages(self) -> DataFrame:
        """What else arrives on the topic: plain text from errors, objects that lack fields from the rest."""
        partial = F.to_json(F.struct(F.col("event_id").alias("sell_id"), F.col("user_id").alias("customer_id"),
                                     F.col("event_type").alias("note")))
        return (self.events.where(F.col("event_type") != "purchase")
                .select(F.col("event_id").cast("string").alias("key"),
                        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), F.col("event_id").cast("string")))
                        .otherwise(partial).alias("value"), F.col("ts").alias("timestamp")))
