"""Registered queries: each takes (spark, data folder) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import at
from tradewind.functions.ids import assign_ids
from tradewind.operators import checks
from tradewind.operators.access import ROLES, authorise
from tradewind.operators.enrich import enrich, price_sales, unknown_products
from tradewind.operators.keyed import own_shuffle
from tradewind.operators.merge import add_increment
from tradewind.plans import accounts, catalogue, dashboards, purchases, rollup_store, sync
from tradewind.plans.checked_loads import CheckedTable, not_null, one_of, text_length
from tradewind.plans.dimension_keys import DimensionKeys
from tradewind.plans.rollups import ROLLUPS, Rollup, build, build_all, from_state, star_existence, to_state
from tradewind.registry.fixtures import BASE_MS, BATCH, LOADED, NOW, REGISTERED_UNTIL, SINCE, SPLIT, Marketplace
from tradewind.schemas import ROLLUP_STATE, WAREHOUSE
from tradewind.session import work_dir
from tradewind.sources.tables import conform, high_watermark, in_storage_order
from tradewind.streaming import jobs, sessions
from tradewind.streaming.gate import PurchaseGate
from tradewind.streaming.messages import parse, rejected, to_messages

Query = Callable[[SparkSession, str], DataFrame]


# --- stars and rollups ---

def existing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return star_existence(m.fact_sales, m.dims)


def rollup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    spec = ROLLUPS[name]
    return build(m.fact_sales if spec.star or spec.key == "customer_id" else m.sale_lines, spec, m.dims)


def backfill_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven rollups from one pass over the fact."""
    m = Marketplace(spark, sf_dir)
    return build_all(m.fact_sales, m.dims, work_dir(spark, "ledger"))


# --- panels, over stored rollups as dashboards read them: the fact is aggregated once, by the backfill ---

def _stored(m: Marketplace, spec: Rollup, since: date | None = None) -> DataFrame:
    """A rollup as its panel reads it: from a store, which this query fills with the rollups that its panels need.

    ``backfill_rollups`` and ``compact_rollup`` fill a store with all eleven.
    """
    store = work_dir(m.spark, "rollups")
    # The store holds the whole rollup, and a panel with a time range reads the years that it shows.
    built = build(m.fact_sales if spec.star or spec.key == "customer_id" else m.sale_lines, spec, m.dims)
    rollup_store.backfill(to_state(built, spec), store, unique=True)
    return from_state(rollup_store.read_state(m.spark, store, since=since), spec)


def panel(spark: SparkSession, sf_dir: str, name: str, since: date | None = None) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    view = dashboards.PANELS[name]
    return dashboards.panel(_stored(m, view.spec, since), view, m.dims[view.dimension], since)


def panel_from_fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A series straight from the fact, cut to the panel's time range, which also cuts the fact that is read."""
    m = Marketplace(spark, sf_dir)
    view = dashboards.PANELS[name]
    return dashboards.panel(build(m.fact_sales, view.spec, m.dims, since=SINCE), view, m.dims[view.dimension], SINCE)


def average_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return dashboards.average_check(_stored(m, ROLLUPS["average_sale_check"]))


# --- dimension syncs ---

def watermark(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The watermark of a warehouse table after two loads."""
    m = Marketplace(spark, sf_dir)
    warehouse, spec = work_dir(spark, "warehouse"), sync.DIMENSIONS[table]
    for rows in (m.loaded(table), sync.new_rows(getattr(m, f"{table}_src"), spec, LOADED, BATCH)):
        sync.add_load(rows, warehouse, table)
    return spark.range(1).select(at(sync.watermark(spark, warehouse, table)).alias("high_watermark"))


def sync_new(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    low = high_watermark(m.loaded(table))
    # Products come from the catalogue's table.
    source = spark.table(_catalogue(m, m.products_src)) if table == "products" else getattr(m, f"{table}_src")
    return sync.new_rows(source, sync.DIMENSIONS[table], low, BATCH)


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run against a warehouse that an earlier run filled; returns the three dimensions, each one generation."""
    m = Marketplace(spark, sf_dir)
    warehouse = work_dir(spark, "warehouse")
    for table in sync.DIMENSIONS:
        sync.add_load(m.loaded(table), warehouse, table)
    sources = {table: partial(getattr, m, f"{table}_src") for table in sync.DIMENSIONS}
    sync.run_daily(spark, sources, warehouse, BATCH, compact=True)
    parts = [sync.dimension(spark, warehouse, table)
             .select(F.lit(table).alias("table_name"), F.col(key).alias("id"), F.col(name).alias("name"), "created_at",
                     "batch_time")
             for table, key, name in (("customers", "customer_id", "username"), ("sellers", "seller_id", "username"),
                                      ("products", "product_id", "product_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def compact_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension after two loads, folded into one generation in storage order: the same rows in fewer files."""
    m = Marketplace(spark, sf_dir)
    warehouse = work_dir(spark, "warehouse")
    for rows in (m.loaded("sellers"), sync_new(spark, sf_dir, "sellers")):
        sync.add_load(rows, warehouse, "sellers")
    sync.compact_table(spark, warehouse, "sellers")
    return sync.dimension(spark, warehouse, "sellers")


# --- increments ---

def _halves(m: Marketplace) -> tuple[DataFrame, DataFrame]:
    early = F.coalesce(F.col("sale_date") < at(SPLIT), F.lit(False))
    return m.fact_sales.where(early), m.fact_sales.where(~early)


def merge_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup of the older sales plus the increment of the newer ones."""
    m = Marketplace(spark, sf_dir)
    spec = ROLLUPS["monthly_sales_by_seller"]
    before, after = (build(part, spec, m.dims) for part in _halves(m))
    return add_increment(before, after, spec.keys, list(spec.measures))


def merge_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ROLLUPS["average_sale_check"]
    before, after = (build(part, spec) for part in _halves(Marketplace(spark, sf_dir)))
    return add_increment(before, after, [], list(spec.measures))


def compact_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored rollup state: backfilled from the older sales, increased by the newer ones, then folded."""
    m = Marketplace(spark, sf_dir)
    store = work_dir(spark, "rollups")
    before, after = _halves(m)
    rollup_store.backfill(build_all(before, m.dims, f"{store}/ledger-before"), store, built=True)
    rollup_store.write_delta(build_all(after, m.dims, f"{store}/ledger-after"), store, 0, built=True)
    rollup_store.compact(spark, store, settled=True)
    return rollup_store.read_state(spark, store).select(*ROLLUP_STATE.fieldNames())


# --- catalogue ---

def _catalogue(m: Marketplace, products: DataFrame) -> str:
    """A fresh lake table that holds these products."""
    where = work_dir(m.spark, "lake")
    name = catalogue.create(m.spark, f"lake_{where.rsplit('-', 1)[1]}", where, replace=True)
    catalogue.append(m.spark, name, products)
    return name


def append_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    name = _catalogue(m, m.products_src)
    added, _ = catalogue.added_products(m.add_requests, m.sessions, m.users, NOW, BASE_MS, ["request_id"], spark.table(name))
    catalogue.append(spark, name, added)
    return spark.table(name)


def upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    name = _catalogue(m, m.products_target)
    catalogue.upsert(spark, name, m.product_edits)
    return spark.table(name)


def resumed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the edits stop after the rewritten categories are in place; the upsert of the other half finishes them first."""
    m = Marketplace(spark, sf_dir)
    name = _catalogue(m, m.products_target)
    half = F.col("product_id") % 2 == 0
    stage = catalogue.new_stage(spark, name)
    catalogue.stage_upsert(spark, name, m.product_edits.where(half), stage)
    catalogue.decide(spark, stage)
    catalogue.overwrite_staged(spark, name, stage)
    catalogue.upsert(spark, name, m.product_edits.where(~half))
    return catalogue.read(spark, name)


def upsert_update_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update records merged into the catalogue; incomplete ones stay out (``validate_product_updates`` reports them)."""
    m = Marketplace(spark, sf_dir)
    name = _catalogue(m, m.products_target)
    catalogue.upsert(spark, name, catalogue.complete(catalogue.parse_records(m.update_documents)))
    return spark.table(name)


def list_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return catalogue.to_json_lines(spark.table(_catalogue(m, m.products_src)))


def validate_product_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = catalogue.parse_records(Marketplace(spark, sf_dir).update_documents)
    return records.select("record_id", "product_name", "price", F.array_join("missing_fields", ",").alias("missing_fields"))


def authorised_product_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    checked = catalogue.checked_edits(m.edit_requests, m.sessions, m.users, m.products_src)
    return checked.select("request_id", "user_id", "product_id", "product_name", "price", "old_product_name",
                          "old_price", "status")


def edited_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    checked = catalogue.checked_edits(m.edit_requests, m.sessions, m.users, m.products_src)
    return catalogue.edited_products(checked, NOW)


def edit_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole edit path: checked requests, laid over the stored rows, put into the catalogue."""
    m = Marketplace(spark, sf_dir)
    name = _catalogue(m, m.products_src)
    checked = catalogue.checked_edits(m.edit_requests, m.sessions, m.users, spark.table(name))
    catalogue.upsert(spark, name, catalogue.edited_products(checked, NOW))
    return spark.table(name)


# --- access ---

def authorise_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return authorise(m.requests, m.sessions, m.users).select("request_id", "user_id", "user_role", "status")


def authorise_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with sessions that have ended refused."""
    m = Marketplace(spark, sf_dir)
    return authorise(m.requests, m.sessions, m.users, active_only=True).select("request_id", "user_id", "status")


def register_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return accounts.registration_outcomes(m.registrations, m.users)


def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return accounts.new_users(accounts.registration_outcomes(m.registrations, m.users), m.users)


def new_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the registrations add to ``customers`` and ``sellers``."""
    m = Marketplace(spark, sf_dir)
    outcomes = accounts.registration_outcomes(m.registrations, m.users)
    added = accounts.new_accounts(outcomes, {"customers": m.customers, "sellers": m.sellers})
    parts = [rows.select(F.lit(table).alias("table_name"), "username", "created_at", "updated_at")
             for table, rows in added.items()]
    return parts[0].unionByName(parts[1])


def registered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users``, ``customers`` and ``sellers`` after the registrations went into all three as one batch, which is then sent again."""
    m = Marketplace(spark, sf_dir)
    accounts_of = accounts.Registry(work_dir(spark, "accounts"))
    accounts_of.found({"users": m.users, "customers": m.customers_src, "sellers": m.sellers_src})
    for _ in range(2):
        accounts_of.register(m.registrations, 1)
    parts = [accounts_of.table(spark, table).select(F.lit(table).alias("table_name"), "id", "username", "created_at")
             for table in ("customers", "sellers")]
    users = accounts_of.table(spark, "users").select(F.lit("users"), "user_id", "user_login", F.lit(None).cast("timestamp"))
    return parts[0].unionByName(parts[1]).union(users)


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations and purchases through checked loads, the registrations in two: all rows, with what the quarantined ones break."""
    m = Marketplace(spark, sf_dir)
    root = work_dir(spark, "checked")
    people = CheckedTable(f"{root}/registrations", m.registrations.schema,
                          {**not_null("request_id", "username", "user_role"), **text_length("username", 255), **one_of("user_role", *ROLES)},
                          unique="username", order=("created_at", "request_id"))
    early = F.col("created_at") < at(REGISTERED_UNTIL)
    for load_id, part in enumerate((m.registrations.where(early), m.registrations.where(~early))):
        people.load(part, load_id)
    bought = CheckedTable(f"{root}/purchases", m.purchases.schema, {**not_null("sell_id", "quantity"), "quantity below 5": F.col("quantity") < 5},
                          {"customer_id": m.customers, "product_id": m.products}, "sell_id", ("ts",))
    bought.load(m.purchases, 0)
    parts = []
    for name, table, key in (("registrations", people, "request_id"), ("purchases", bought, "sell_id")):
        good = table.rows(spark).select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.lit("").alias("broken"))
        bad = table.quarantined(spark).select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.array_join("broken", "; ").alias("broken"))
        parts.append(good.unionByName(bad))
    return parts[0].unionByName(parts[1])


def check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return checks.report(
        checks.unique_check(m.users, "users", "user_login"),
        checks.not_null_checks(m.users, "users", ["user_id", "user_login", "user_role"]),
        checks.text_length_check(m.users, "users", "user_login", 255),
        checks.unique_check(m.sessions, "sessions", "session_token"),
        checks.not_null_checks(m.sessions, "sessions", ["user_id", "session_start"]),
        checks.foreign_key_check(m.sessions, "sessions", "user_id", m.users, "users"),
        checks.unique_check(m.registrations, "registrations", "username"),
        *[check for table, rows, key in (("customers", m.customers, "customer_id"), ("sellers", m.sellers, "seller_id"))
          for check in (checks.unique_check(rows, table, key), checks.unique_check(rows, table, "username"),
                        checks.not_null_checks(rows, table, [key, "username"]),
                        checks.text_length_check(rows, table, "username", 50))])


def sessionise_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Marketplace(spark, sf_dir).sessions


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session log as a stream, in several batches with folds between them."""
    m = Marketplace(spark, sf_dir)
    root = work_dir(spark, "sessions")
    m.session_log.repartition("action").write.parquet(f"{root}/log")  # a token's logins and logouts come in different batches
    stream = spark.readStream.schema(sessions.EVENT).options(**_files_for(spark, f"{root}/log", 4)).parquet(f"{root}/log")
    sessions.keep_sessions(stream, f"{root}/kept", f"{root}/checkpoint", fold_every=2).awaitTermination()
    return sessions.read_sessions(spark, f"{root}/kept")


# --- purchases ---

def enrich_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return enrich(m.purchases, m.products).select("sell_id", "customer_id", "product_id", "seller_id", "price", "quantity", "ts")


def refused_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return unknown_products(m.purchases, m.products).select("sell_id", "customer_id", "product_id", "quantity")


def outcomes_of_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase request with its status; the accepted ones are what is published."""
    m = Marketplace(spark, sf_dir)
    checked = purchases.purchase_outcomes(m.purchase_requests, m.sessions, m.users, m.products)
    return checked.select("request_id", "user_id", "product_id", "quantity", "price", "seller_id", "status")


def publish_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(Marketplace(spark, sf_dir).accepted)


def _topic(m: Marketplace) -> DataFrame:
    return to_messages(m.accepted).unionByName(m.stray_messages)


def reject_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of everything on the topic."""
    return rejected(parse(_topic(Marketplace(spark, sf_dir))))


def _files_for(spark: SparkSession, folder: str, batches: int) -> dict[str, str]:
    """Options that make about so many micro-batches of what lies in a folder."""
    files = len(spark.read.parquet(folder).inputFiles())
    return {"maxFilesPerTrigger": str(max(1, -(-files // batches)))}


def _outputs(m: Marketplace, root: str, rollups: bool) -> jobs.Outputs:
    """With ``rollups`` the dimensions are loaded into a warehouse first, whose keys the stream keeps by bucket."""
    keys = None
    if rollups:
        for table in m.dims:
            sync.add_load(m.dims[table], f"{root}/warehouse", table)
        keys = DimensionKeys(f"{root}/keys", f"{root}/warehouse", buckets=16)
    return jobs.Outputs(f"{root}/fact_sales", f"{root}/dead_letters", f"{root}/rollups" if rollups else None, keys=keys)


def _consume(m: Marketplace, rollups: bool = False) -> jobs.Outputs:
    """Publish to a folder standing in for the topic, then run the consumer until it is drained, with folds between its batches."""
    root = work_dir(m.spark, "stream")
    jobs.publish(m.accepted, "parquet", f"{root}/topic")
    m.stray_messages.write.mode("append").parquet(f"{root}/topic")
    out = _outputs(m, root, rollups)
    messages = jobs.read_messages(m.spark, "parquet", f"{root}/topic", **_files_for(m.spark, f"{root}/topic", 3))
    jobs.ingest(messages, out, f"{root}/checkpoint", batch_time=NOW, fold_every=2).awaitTermination()
    return out


def stream_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _consume(Marketplace(spark, sf_dir))
    return jobs.read_facts(spark, out.facts)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _consume(Marketplace(spark, sf_dir))
    return jobs.read_dead_letters(spark, out.dead_letters)


def stream_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _consume(Marketplace(spark, sf_dir), rollups=True)
    return rollup_store.read_state(spark, out.rollups).select(*ROLLUP_STATE.fieldNames())


def stream_repeated_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase is sent twice, every third one a third time after a restart; the fact has each once."""
    m = Marketplace(spark, sf_dir)
    root = work_dir(spark, "stream")
    topic, out = f"{root}/topic", _outputs(m, root, rollups=False)
    again = m.accepted.where(F.col("request_id") % 3 == 0)
    for sent in (m.accepted.unionByName(again), m.accepted.where(F.col("request_id") % 3 != 0)):
        jobs.publish(sent, "parquet", topic)
    for run in range(2):
        messages = jobs.read_messages(spark, "parquet", topic, **_files_for(spark, topic, 2))
        jobs.ingest(messages, out, f"{root}/checkpoint", batch_time=NOW, repeats="7 days").awaitTermination()
        if run == 0:
            jobs.publish(again, "parquet", topic)
    return jobs.read_facts(spark, out.facts)


def stream_gated_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All purchase requests through the streaming gate, with what was published of them: accepted plus refused is everything.

    Ids depend on the batches, so a request only shows that its message has its id.
    """
    m = Marketplace(spark, sf_dir)
    root = work_dir(spark, "gate")
    m.purchase_requests.write.parquet(f"{root}/requests")
    gate = PurchaseGate(f"{root}/gate", lambda: (m.sessions, m.users, m.products), BASE_MS)
    stream = (spark.readStream.schema(m.purchase_requests.schema).options(**_files_for(spark, f"{root}/requests", 3))
              .parquet(f"{root}/requests"))
    jobs.publish_stream(stream, gate.purchases, f"{root}/checkpoint", "parquet", f"{root}/topic", after=gate.fold).awaitTermination()
    sent = spark.read.schema(jobs.MESSAGE).parquet(f"{root}/topic").select(F.col("key").cast("long").alias("sell_id"), F.col("value").alias("message"))
    decided = gate.decisions(spark).join(own_shuffle(sent, "sell_id"), "sell_id", "left")
    field = lambda name: F.get_json_object("message", f"$.{name}").cast("long").alias(f"sent_{name}")
    return decided.select("request_id", "user_id", "product_id", "quantity", "price", "seller_id", "status",
                          *map(field, ("customer_id", "product_id", "quantity")),
                          (F.get_json_object("message", "$.sell_id").cast("long") == F.col("sell_id")).alias("own_id"))


# --- conformance, prices, ids ---

def conform_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without a batch time or amount, in the fact's columns and storage order."""
    m = Marketplace(spark, sf_dir)
    return in_storage_order(conform(m.fact_sales.drop("total_amount"), "fact_sales"), "fact_sales")


def priced_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales priced from the catalogue of the batch time; products that came later have the fixed price."""
    m = Marketplace(spark, sf_dir)
    sales = m.fact_sales.select("sale_id", "product_id", "quantity")
    return price_sales(sales, m.products_target)


def numbered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marketplace(spark, sf_dir)
    return assign_ids(m.purchases.select("sell_id", "customer_id"), BASE_MS, ["sell_id"], "assigned_id")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {"star_existence": existing_sales}
    registered |= {name: partial(rollup, name=name) for name in ROLLUPS}
    registered |= {"backfill_rollups": backfill_rollups}
    registered |= {name: partial(panel, name=name) for name in dashboards.PANELS}
    series = [name for name, p in dashboards.PANELS.items() if not p.top and not p.hidden]
    registered |= {f"{name}_since": partial(panel, name=name, since=SINCE) for name in series}
    registered |= {f"{name.removeprefix('dash_')}_since": partial(panel_from_fact, name=name) for name in series}
    registered |= {"dash_average_check": average_check}
    for table in sync.DIMENSIONS:
        registered[f"high_watermark_{table}"] = partial(watermark, table=table)
        registered[f"sync_new_{table}"] = partial(sync_new, table=table)
    registered |= {
        "daily_run": daily_run, "compact_dimension": compact_sellers,
        "merge_rollup_increment": merge_increment, "merge_average_check": merge_totals, "compact_rollup": compact_rollups,
        "append_product": append_product, "upsert_update_records": upsert_update_records, "upsert_products": upsert_products, "resumed_upsert": resumed_upsert, "list_products": list_products,
        "validate_product_updates": validate_product_updates, "authorised_product_edits": authorised_product_edits,
        "edited_products": edited_products, "edit_products": edit_products,
        "authorise_requests": authorise_requests, "authorise_active_requests": authorise_active,
        "register_users": register_users, "new_users": new_users, "new_accounts": new_accounts, "registered_tables": registered_tables, "check_constraints": check_constraints,
        "quarantined_rows": quarantined_rows, "stream_sessions": stream_sessions,
        "sessionise_logins": sessionise_logins,
        "enrich_purchases": enrich_purchases, "refused_purchases": refused_purchases,
        "publish_purchases": publish_purchases, "reject_purchases": reject_purchases,
        "stream_purchases": stream_purchases, "stream_rejects": stream_rejects, "stream_rollups": stream_rollups,
        "stream_repeated_purchases": stream_repeated_purchases, "stream_gated_purchases": stream_gated_purchases,
        "purchase_outcomes": outcomes_of_purchases, "conform_fact": conform_fact, "price_sales": priced_sales, "assign_ids": numbered_requests,
    }
    return registered
