"""The eleven sales rollups: one spec per rollup drives the batch aggregate, the increment, the merge and the backfill."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import day, month
from tradewind.operators.keyed import absent_from, keep_known, key_copies, own_shuffle
from tradewind.operators.merge import add_up
from tradewind.schemas import MONEY_TOTAL

# Fact key -> dimension table. Sellers come first: the fewest rows, and the cheapest test.
DIMENSION_OF = {"seller_id": "sellers", "product_id": "products", "customer_id": "customers"}
PERIOD_COLUMN = {"day": "sale_date", "month": "sale_month"}
STATE_KEYS = ["rollup", "period", "key_id"]
STATE_MEASURES = ["total_quantity", "total_amount", "sales_count"]


@dataclass(frozen=True)
class Rollup:
    """``measures`` maps an output column to the state measure behind it; ``star`` asks for known dimensions."""

    name: str
    key: str | None
    period: str | None
    measures: dict[str, str]
    star: bool

    @property
    def period_column(self) -> str | None:
        return PERIOD_COLUMN.get(self.period)

    @property
    def keys(self) -> list[str]:
        return [c for c in (self.period_column, self.key) if c]

    def bucket(self, ts: Column) -> Column:
        return month(ts) if self.period == "month" else day(ts)


_BOTH = {"total_quantity": "total_quantity", "total_amount": "total_amount"}

ROLLUPS: dict[str, Rollup] = {r.name: r for r in (
    Rollup("daily_sales_by_product", "product_id", "day", _BOTH, star=True),
    Rollup("daily_sales_by_seller", "seller_id", "day", _BOTH, star=True),
    Rollup("daily_sales_by_customer", "customer_id", "day", _BOTH, star=True),
    Rollup("monthly_sales_by_product", "product_id", "month", _BOTH, star=True),
    Rollup("monthly_sales_by_seller", "seller_id", "month", _BOTH, star=True),
    Rollup("monthly_sales_by_customer", "customer_id", "month", _BOTH, star=True),
    Rollup("units_by_product", "product_id", None, {"total_quantity_sold": "total_quantity"}, star=False),
    Rollup("spend_by_customer", "customer_id", None, {"total_amount_spent": "total_amount"}, star=False),
    Rollup("revenue_by_seller", "seller_id", None, {"total_revenue": "total_amount"}, star=False),
    Rollup("units_by_seller", "seller_id", None, {"total_quantity_sold": "total_quantity"}, star=False),
    Rollup("average_sale_check", None, None,
           {"total_revenue": "total_amount", "total_sales_count": "sales_count"}, star=False),
)}


def _measure(state_measure: str, weight: Column | None = None) -> Column:
    """Sum of one measure; ``weight`` counts how many joined rows a fact row stands for."""
    if state_measure == "sales_count":
        return (F.count("sale_id") if weight is None
                else F.coalesce(F.sum(F.when(F.col("sale_id").isNotNull(), weight)), F.lit(0)).cast("long"))
    source = F.col("quantity" if state_measure == "total_quantity" else "total_amount")
    total = F.sum(source if weight is None else source * weight)
    return total.cast("long" if state_measure == "total_quantity" else MONEY_TOTAL)


def star_existence(fact: DataFrame, dims: dict[str, DataFrame], skip: str | None = None) -> DataFrame:
    """Fact rows whose seller, product and customer are all known. Duplicated dimension rows do not multiply."""
    for key, table in DIMENSION_OF.items():
        if key != skip:
            fact = keep_known(fact, dims[table], key)
    return fact


def build(fact: DataFrame, spec: Rollup, dims: dict[str, DataFrame] | None = None, since: date | None = None,
          strict: bool = False) -> DataFrame:
    """One rollup from the fact.

    The rollup's own dimension is tested after the aggregation, on groups instead of fact rows; the other two
    before it. ``strict`` multiplies each sale by the copies of its dimension rows, as an inner join would.
    """
    weight = None
    rows = fact
    if since is not None:
        # The first test reaches the scan; the second cuts the bucket that `since` falls into.
        rows = rows.where((F.col("sale_date") >= F.lit(since)) & (spec.bucket(F.col("sale_date")) >= F.lit(since)))
    wanted = set(spec.measures.values())
    columns = [*(DIMENSION_OF if spec.star else [spec.key] if spec.key else []),
               *(["sale_date"] if spec.period else []),
               *(["quantity"] if "total_quantity" in wanted else []),
               *(["total_amount"] if "total_amount" in wanted else []),
               *(["sale_id"] if "sales_count" in wanted else [])]
    rows = rows.select(*columns)
    if spec.star and strict:
        weight = F.lit(1).cast("long")
        for key, table in DIMENSION_OF.items():
            rows = rows.join(key_copies(dims[table], key, f"_{table}"), key, "inner")
            weight = weight * F.col(f"_{table}")
    elif spec.star:
        rows = star_existence(rows, dims, skip=spec.key)
    sums = [_measure(m, weight).alias(name) for name, m in spec.measures.items()]
    if not spec.keys:
        return rows.agg(*[F.coalesce(s, F.lit(0)).alias(name) for s, name in zip(sums, spec.measures)])
    group = [spec.bucket(F.col("sale_date")).alias(spec.period_column)] if spec.period else []
    out = rows.groupBy(*group, spec.key).agg(*sums)
    return keep_known(out, dims[DIMENSION_OF[spec.key]], spec.key) if spec.star and not strict else out


LEDGER = ("kind string, period date, key_id long, total_quantity long, total_amount decimal(28,2), sales_count long, "
          "star boolean")


def ledger(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Totals that all eleven rollups are sums of: per kind of key, day and key, apart for sales whose dimensions are all
    known (``star``) and the others.

    The wide data is read once. Each sale is marked by left joins to unique keys, which are the small sides.
    """
    rows, star = fact, F.lit(True)
    for key, table in DIMENSION_OF.items():
        known = dims[table].select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"_{table}", F.lit(True))
        rows = rows.join(own_shuffle(known, key), key, "left")
        star = star & F.col(f"_{table}").isNotNull()
    marked = rows.select(day("sale_date").alias("period"), star.alias("star"), *DIMENSION_OF, "quantity", "total_amount", "sale_id")
    totals = [F.sum("quantity").alias("total_quantity"), F.sum("total_amount").cast(MONEY_TOTAL).alias("total_amount"),
              F.count("sale_id").alias("sales_count")]
    each = marked.unpivot(["period", "star", "quantity", "total_amount", "sale_id"], list(DIMENSION_OF), "kind", "key_id")
    return each.groupBy("kind", "period", "key_id", "star").agg(*totals).select(*[c.split()[0] for c in LEDGER.split(", ")])


def from_ledger(totals: DataFrame) -> DataFrame:
    """All eleven rollups as state rows (``ROLLUP_STATE``). The ledger is read per branch, so store or persist it first."""
    def named(rows: DataFrame, period: str | None, star: bool) -> DataFrame:
        """One state row per rollup that the row's kind of key has at this level."""
        names: dict[str, list[str]] = {}
        for s in ROLLUPS.values():
            if s.key and (s.period, s.star) == (period, star):
                names.setdefault(s.key, []).append(s.name)
        several = any(len(n) > 1 for n in names.values())
        pick = F.coalesce(*[F.when(F.col("kind") == key, F.array(*map(F.lit, n)) if several else F.lit(n[0]))
                            for key, n in names.items()])
        return rows.select((F.explode(pick) if several else pick).alias("rollup"), "period", "key_id", *STATE_MEASURES)

    star = totals.where("star")
    monthly = add_up(star.withColumn("period", month("period")), ["kind", "period", "key_id"], STATE_MEASURES)
    ever = add_up(totals.withColumn("period", F.lit(None).cast("date")), ["kind", "period", "key_id"], STATE_MEASURES)
    # Each kind of key covers every sale, so the grand total takes one of them.
    grand = add_up(totals.where(F.col("kind") == "product_id").withColumn("kind", F.lit(None).cast("string")), ["kind"],
                   STATE_MEASURES)
    grand = grand.select(F.lit("average_sale_check").alias("rollup"), F.lit(None).cast("date").alias("period"),
                         F.lit(None).cast("long").alias("key_id"), *STATE_MEASURES)
    return (named(star, "day", True).unionByName(named(monthly, "month", True))
            .unionByName(named(ever, None, False)).unionByName(grand))


# A key with more than this share of the sales is summed within the map tasks first; the others are too small to be hot.
HOT_SHARE = 0.001
# Sales that one task sums up.
SALES_A_TASK = 1_000_000


def _marked(fact: DataFrame, dims: dict[str, DataFrame], path: str) -> DataFrame:
    """Sales in the columns that rollups need, stored below ``path``, with ``star`` where all dimensions are known.

    Only keys that their dimension lacks are joined to the sales. They are few as a rule, and then broadcast; if they are
    many, each join shuffles the sales once.
    """
    spark = fact.sparkSession

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    complete = F.lit(True)
    for key in DIMENSION_OF:
        complete = complete & F.col(key).isNotNull()
    sales = fact.select(*[F.col(k).cast("long").alias(k) for k in DIMENSION_OF], day("sale_date").alias("period"),
                        F.col("quantity").cast("long").alias("quantity"), "total_amount", F.col("sale_id").isNotNull().alias("sold"),
                        complete.alias("star"))
    sales = stored(sales, "sales")
    missing = [absent_from(sales.select(key).where(F.col(key).isNotNull()).distinct(), dims[table], key)
               .select(F.lit(key).alias("kind"), F.col(key).alias("key_id")) for key, table in DIMENSION_OF.items()]
    unknown = stored(reduce(DataFrame.unionByName, missing), "unknown")
    kinds = {r["kind"] for r in unknown.select("kind").distinct().collect()}
    for key in DIMENSION_OF:
        if key in kinds:
            lacked = unknown.where(F.col("kind") == key).select(F.col("key_id").alias(key), F.lit(True).alias("_unknown"))
            sales = sales.join(lacked, key, "left").withColumn("star", F.col("star") & F.col("_unknown").isNull()).drop("_unknown")
    return stored(sales, "marked") if kinds else sales


def _by_key(sales: DataFrame, key: str, tasks: int | None) -> DataFrame:
    """State rows of all rollups by one key. Sales are dealt out once, by the key, into ``tasks``, and all levels of a key are
    summed where it lies; without ``tasks`` each level is a partial and a final sum, as hot keys need it."""
    rows = sales.select(F.col(key).alias("key_id"), "period", "star", "quantity", "total_amount", "sold")
    if tasks:
        rows = rows.repartition(tasks, "key_id")
    daily = rows.groupBy("key_id", "period", "star").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_amount").cast(MONEY_TOTAL).alias("total_amount"),
        F.count(F.when(F.col("sold"), True)).alias("sales_count"))
    names: dict[tuple, list[str]] = {}
    for spec in ROLLUPS.values():
        if spec.key == key:
            names.setdefault((spec.period, spec.star), []).append(spec.name)
    period = {"day": F.col("period"), "month": month("period"), None: F.lit(None).cast("date")}
    levels = [(star, F.struct(F.lit(n).alias("level"), period[kind].alias("period"))) for n, (kind, star) in enumerate(names)]
    shown = F.when(F.col("star"), F.array(*[at for _, at in levels])).otherwise(F.array(*[at for star, at in levels if not star]))
    each = daily.withColumn("_at", F.explode(shown)).select("_at.level", "_at.period", "key_id", *STATE_MEASURES)
    sums = add_up(each, ["level", "period", "key_id"], STATE_MEASURES)
    named = F.element_at(F.array(*[F.array(*map(F.lit, n)) for n in names.values()]), F.col("level") + 1)
    return sums.select(F.explode(named).alias("rollup"), "period", "key_id", *STATE_MEASURES)


def build_all(fact: DataFrame, dims: dict[str, DataFrame], path: str) -> DataFrame:
    """All eleven rollups from the fact, as state rows. The sales are written to ``path`` in between, and summed whenever the
    result is read. Rows of a key lie in one task, unless the key is hot.
    """
    sales = _marked(fact, dims, path)
    tasks = 1 + sales.count() // SALES_A_TASK
    # All keys with a greater share are among these, and some others may be.
    frequent = sales.freqItems(list(DIMENSION_OF), HOT_SHARE).first()
    parts = []
    for key in DIMENSION_OF:
        hot = F.col(key).isNull() | F.col(key).isin([k for k in frequent[f"{key}_freqItems"] if k is not None])
        parts += [_by_key(sales.where(~hot), key, tasks), _by_key(sales.where(hot), key, None)]
    grand = sales.groupBy(F.lit("average_sale_check").alias("rollup")).agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_amount").cast(MONEY_TOTAL).alias("total_amount"),
        F.count(F.when(F.col("sold"), True)).alias("sales_count"))
    parts.append(grand.select("rollup", F.lit(None).cast("date").alias("period"), F.lit(None).cast("long").alias("key_id"), *STATE_MEASURES))
    return reduce(DataFrame.unionByName, parts)


def from_state(state: DataFrame, spec: Rollup) -> DataFrame:
    """One rollup, in its own columns, from merged state rows."""
    rows = state.where(F.col("rollup") == spec.name)
    measures = [F.col(m).alias(name) for name, m in spec.measures.items()]
    if not spec.keys:
        totals = rows.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast(rows.schema[m].dataType).alias(m)
                            for m in spec.measures.values()])
        return totals.select(*measures)
    period = [F.col("period").alias(spec.period_column)] if spec.period else []
    return rows.select(*period, F.col("key_id").alias(spec.key), *measures)


def to_state(rollup: DataFrame, spec: Rollup) -> DataFrame:
    """State rows of one rollup; measures it does not carry are null."""
    back = {m: name for name, m in spec.measures.items()}
    types = {"total_quantity": "long", "total_amount": MONEY_TOTAL, "sales_count": "long"}
    return rollup.select(
        F.lit(spec.name).alias("rollup"),
        (F.col(spec.period_column) if spec.period else F.lit(None)).cast("date").alias("period"),
        (F.col(spec.key) if spec.key else F.lit(None)).cast("long").alias("key_id"),
        *[(F.col(back[m]) if m in back else F.lit(None)).cast(types[m]).alias(m) for m in STATE_MEASURES])
