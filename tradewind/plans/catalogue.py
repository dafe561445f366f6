"""The product catalogue: create, append, upsert, list and validate a lake table partitioned by category.

An upsert of a table whose format has no merge of its own goes through a stage that lies with the table. Once the stage is complete
it is marked as decided, and from then on the upsert happens: whoever stops after that, the next writer finishes it first, and readers
(``read``) already see it.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import at, missing_names, money, or_empty
from tradewind.functions.ids import assign_ids, highest_id
from tradewind.operators.access import OK, authorise, own_product
from tradewind.operators.keyed import keep_known
from tradewind.operators.merge import merge_rows, require_unique
from tradewind.schemas import CATALOGUE
from tradewind.session import work_dir
from tradewind.sources import files
from tradewind.sources.tables import setting, table_exists

COLUMNS = CATALOGUE.fieldNames()
# Fields an update record must carry (fixed values, in the order they are reported).
REQUIRED = ("product_id", "product_name", "price", "product_description", "created_at", "updated_at", "category",
            "seller_id")
# An update leaves this column of a stored product alone.
KEPT = ("created_at",)
_MERGING_FORMATS = {"iceberg", "delta"}
# Below a table's place; names that begin so are no data to Spark.
_STAGES, _DECIDED = "_upserts", "_decided"


def create(spark: SparkSession, database: str, location: str | None = None, table: str = "products",
           fmt: str = "parquet", replace: bool = False) -> str:
    """Create the database and the empty table; ``replace`` drops an old one first. Returns the full name."""
    where = "" if location is None else f" LOCATION '{_quoted(location)}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    name = f"{database}.{table}"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOGUE.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} PARTITIONED BY (category)")
    return name


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def require_table(spark: SparkSession, name: str) -> None:
    database, table = name.rsplit(".", 1)
    if not table_exists(spark, database, table):
        raise LookupError(f"table {name} does not exist")


def _merges(spark: SparkSession, name: str) -> bool:
    """Does the table's own format support a merge?"""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Provider")
    provider = rows.select("data_type").first()
    return provider is not None and provider[0].lower() in _MERGING_FORMATS


def _conformed(products: DataFrame) -> DataFrame:
    return products.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOGUE.fields])


def _by_category(products: DataFrame) -> DataFrame:
    """Few files per category, and several tasks for a category that is too large for one."""
    return products.hint("rebalance", "category")


def append(spark: SparkSession, name: str, products: DataFrame) -> None:
    require_table(spark, name)
    recover(spark, name)
    rows = _by_category(_conformed(products))
    if _merges(spark, name):
        rows.writeTo(name).append()
    else:
        rows.write.insertInto(name)


def parse_records(documents: DataFrame, column: str = "document") -> DataFrame:
    """Update records from JSON text, with the names of their missing fields (absent, null or of a wrong type).

    Numbers are read as text and cast, so an id sent as a string is the same as one sent as a number.
    """
    kinds = {"product_id": "long", "seller_id": "long", "price": CATALOGUE["price"].dataType,
             "created_at": "timestamp", "updated_at": "timestamp"}
    raw = F.from_json(column, T.StructType([T.StructField(f, T.StringType()) for f in REQUIRED]))
    fields = {f: F.col(f"_raw.{f}").try_cast(kinds[f]) if f in kinds else F.col(f"_raw.{f}") for f in REQUIRED}
    return (documents.withColumn("_raw", raw)
            .select(*[c for c in documents.columns], *[v.alias(f) for f, v in fields.items()])
            .withColumn("missing_fields", missing_names({f: F.col(f) for f in REQUIRED})))


def complete(records: DataFrame) -> DataFrame:
    return records.where(F.size("missing_fields") == 0)


def incomplete(records: DataFrame) -> DataFrame:
    return records.where(F.size("missing_fields") > 0)


def upsert(spark: SparkSession, name: str, source: DataFrame) -> None:
    """Update products that exist, insert the others. A repeated source key is refused, as MERGE would.

    The source is written down first: it is read several times, and must be the same rows every time. One process at a time
    writes a table. An upsert that stopped before it was decided has changed nothing; one that stopped later is finished by the next
    call of ``upsert``, ``append`` or ``recover``, in any session.
    """
    require_table(spark, name)
    recover(spark, name)
    merges = _merges(spark, name)
    stage = work_dir(spark, "upsert") if merges else new_stage(spark, name)
    _conformed(source).write.parquet(f"{stage}/source")
    edits = spark.read.schema(CATALOGUE).parquet(f"{stage}/source")
    require_unique(edits, "product_id")
    if merges:
        changed = {c: F.col(f"source.{c}") for c in COLUMNS if c != "product_id" and c not in KEPT}
        (edits.alias("source").mergeInto(name, F.expr(f"{name}.product_id = source.product_id"))
         .whenMatched().update(changed).whenNotMatched().insertAll().merge())
    else:
        stage_upsert(spark, name, edits, stage)
        decide(spark, stage)
        apply_staged(spark, name, stage)
        clear(spark, stage)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location")
    return rows.select("data_type").first()[0].rstrip("/")


def new_stage(spark: SparkSession, name: str) -> str:
    """Stages sort by the time they were begun."""
    return f"{_location(spark, name)}/{_STAGES}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def decide(spark: SparkSession, stage: str) -> None:
    """Record that a complete stage is to be applied."""
    files.mark(spark, f"{stage}/{_DECIDED}")


def clear(spark: SparkSession, stage: str) -> None:
    """Forget a stage. The record goes first: a stage that is partly gone must not be applied again."""
    files.remove(spark, f"{stage}/{_DECIDED}")
    files.remove(spark, stage)


def _stages(spark: SparkSession, name: str) -> tuple[list[str], list[str]]:
    """Stages left behind by upserts that stopped: the decided ones, oldest first, and the others."""
    folder = f"{_location(spark, name)}/{_STAGES}"
    found = [f"{folder}/{n}" for n in files.names(spark, folder)]
    decided = [f for f in found if files.exists(spark, f"{f}/{_DECIDED}")]
    return decided, [f for f in found if f not in decided]


def recover(spark: SparkSession, name: str) -> int:
    """Finish the upserts that were decided but not finished, and remove what others left. Returns how many it finished."""
    decided, others = _stages(spark, name)
    for stage in others:
        files.remove(spark, stage)
    for stage in decided:
        apply_staged(spark, name, stage)
        clear(spark, stage)
    return len(decided)


def read(spark: SparkSession, name: str) -> DataFrame:
    """The table with all that is decided, also where an upsert stopped half-way: the categories that it touches are read from its
    stage, and only the others from the table."""
    require_table(spark, name)
    rows = spark.table(name)
    for stage in _stages(spark, name)[0]:
        touched = _touched(spark, stage)
        kept = _in_categories(rows, touched, outside=True)
        rows = kept.unionByName(spark.read.schema(CATALOGUE).parquet(f"{stage}/rows").select(*rows.columns))
    return rows


def stage_upsert(spark: SparkSession, name: str, source: DataFrame, stage: str) -> None:
    """Write the new content of every category that the upsert enters or leaves below ``stage``.

    Only those categories are read and rewritten.
    """
    target = spark.table(name)
    entered = source.select("category").distinct()
    left = keep_known(target.select("product_id", "category"), source, "product_id").select("category").distinct()
    entered.union(left).distinct().write.parquet(f"{stage}/touched")
    rewritten = merge_rows(_in_categories(target, _touched(spark, stage)), source, "product_id", KEPT)
    rewritten.write.parquet(f"{stage}/rows")


def _touched(spark: SparkSession, stage: str) -> DataFrame:
    return spark.read.schema("category string").parquet(f"{stage}/touched")


def _names(touched: DataFrame) -> list[str | None]:
    """Names of partitions: metadata, of which the driver holds a table's full list anyway when it plans a scan."""
    return [r[0] for r in touched.collect()]


def _in_categories(target: DataFrame, touched: DataFrame, outside: bool = False) -> DataFrame:
    """Rows of some categories, or of all others. Partition names in the filter prune folders while planning, however many they are."""
    names = _names(touched)
    named = F.col("category").isin([c for c in names if c is not None])
    if outside:
        return target.where(~F.coalesce(named, F.lit(None in names)))
    return target.where(named | F.col("category").isNull() if None in names else named)


def apply_staged(spark: SparkSession, name: str, stage: str) -> None:
    """Put the staged rows in place of the touched categories, and drop categories that became empty.

    It reads only the stage, so running it again after a failure, as ``recover`` does, gives the same table.
    """
    overwrite_staged(spark, name, stage)
    drop_emptied(spark, name, stage)
    spark.catalog.refreshTable(name)


def overwrite_staged(spark: SparkSession, name: str, stage: str) -> None:
    rows = spark.read.schema(CATALOGUE).parquet(f"{stage}/rows")
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        _by_category(rows.select(*COLUMNS)).write.insertInto(name, overwrite=True)


def drop_emptied(spark: SparkSession, name: str, stage: str) -> None:
    """Drop the touched categories that the stage leaves without rows."""
    rows = spark.read.schema(CATALOGUE).parquet(f"{stage}/rows")
    touched, filled = _touched(spark, stage), rows.select("category").distinct()
    emptied = touched.join(filled, touched["category"].eqNullSafe(filled["category"]), "left_anti")
    gone = ", ".join("PARTITION (category = " + ("null" if c is None else f"'{_quoted(c)}'") + ")" for c in _names(emptied))
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")


def to_json_lines(products: DataFrame) -> DataFrame:
    """One JSON document per product, left distributed. Null fields are omitted."""
    return products.select("product_id", F.to_json(F.struct(*products.columns)).alias("document"))


def added_products(requests: DataFrame, sessions: DataFrame, users: DataFrame, now: datetime, base_ms: int,
                   order: list[str], products: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Products of authorised add requests, ready to append, and the requests that were refused.

    ``products`` is the catalogue that they go into: their ids begin above its highest.
    """
    checked = authorise(requests.withColumn("needed_role", F.lit("seller")), sessions, users)
    accepted = checked.where(F.col("status") == OK)
    highest = None if products is None else highest_id(products, "product_id")
    numbered = assign_ids(accepted, base_ms, order, "product_id", highest)
    stamped = (numbered.withColumn("seller_id", F.col("user_id")).withColumn("price", money("price"))
               .withColumn("product_description", or_empty("product_description"))
               .withColumn("created_at", at(now)).withColumn("updated_at", at(now)))
    return _conformed(stamped), checked.where(F.col("status") != OK)


def checked_edits(requests: DataFrame, sessions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Edit requests with their status: session, role, product and ownership. An id sent as text is cast first."""
    typed = requests.withColumn("product_id", F.col("product_id").cast("string").try_cast("long"))
    return own_product(authorise(typed.withColumn("needed_role", F.lit("seller")), sessions, users), products)


def edited_products(checked: DataFrame, now: datetime, order: str = "request_id") -> DataFrame:
    """Accepted edits laid over the stored rows: what is not given stays, the time of change is new.

    Several edits of one product come out as one row, as if made one after the other: per column the last value given.
    """
    def last_given(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order))).alias(column)

    stored = [c for c in checked.columns if c.startswith("old_")]
    edits = (checked.where(F.col("status") == OK).groupBy("product_id")
             .agg(last_given("product_name"), last_given("price"), F.max(F.struct(*stored)).alias("_stored"))
             .select("product_id", "product_name", "price", "_stored.*"))

    def laid_over(column: str) -> Column:
        return F.coalesce(F.col(column), F.col(f"old_{column}")).alias(column)

    return _conformed(edits.select(
        "product_id", laid_over("product_name"), or_empty("old_product_description").alias("product_description"),
        laid_over("price"), F.col("old_seller_id").alias("seller_id"), F.col("old_created_at").alias("created_at"),
        at(now).alias("updated_at"), or_empty("old_category").alias("category")))
