"""Registration of users, and the session log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.ids import highest_id, number_rows
from tradewind.operators.access import ROLES, valid_role
from tradewind.operators.keyed import absent_from, insert_if_absent
from tradewind.sources import folded

# What became of a registration.
REGISTERED, DUPLICATE, BAD_ROLE = "registered", "duplicate", "bad_role"
ACCOUNT_TABLE = {"customer": "customers", "seller": "sellers"}


def registration_outcomes(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Each request (``request_id``, ``username``, ``user_role``, ``created_at``) with its ``outcome``.

    The first valid request for a name that no user has yet is registered. Requests are matched back by their id,
    which is unique, so a name that is requested very often is never joined on.
    """
    valid = requests.where(valid_role())
    names = users.select(F.col("user_login").alias("username"))
    first = insert_if_absent(valid.select("username", "created_at", "request_id"), names, "username",
                             "created_at", "request_id")
    won = first.select("request_id", F.lit(True).alias("_won"))
    outcome = (F.when(F.col("_won"), REGISTERED)
               .when(F.coalesce(valid_role(), F.lit(False)), DUPLICATE)
               .otherwise(BAD_ROLE))
    return requests.join(won, "request_id", "left").withColumn("outcome", outcome).drop("_won")


def new_users(outcomes: DataFrame, users: DataFrame) -> DataFrame:
    """User rows of the registered, numbered after the highest user id there is, in order of registration."""
    last = users.agg(F.max("user_id")).first()[0]
    registered = outcomes.where(F.col("outcome") == REGISTERED)
    numbered = number_rows(registered.select("username", "user_role", "created_at", "request_id"),
                           0 if last is None else last + 1, ["created_at", "request_id"], "user_id")
    return numbered.select("user_id", F.col("username").alias("user_login"), "user_role")


def new_accounts(outcomes: DataFrame, accounts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows to add to ``customers`` and ``sellers``: registered users by role, unless the name is taken there."""
    registered = outcomes.where(F.col("outcome") == REGISTERED)
    added = {}
    for role in ROLES:
        table = ACCOUNT_TABLE[role]
        of_role = registered.where(F.col("user_role") == role)
        rows = of_role.select("username", "created_at", F.col("created_at").alias("updated_at"))
        added[table] = absent_from(rows, accounts[table], "username")
    return added


def numbered_accounts(added: DataFrame, existing: DataFrame) -> DataFrame:
    """New account rows with ids after the highest one of their table, in order of creation."""
    last = highest_id(existing, "id")
    numbered = number_rows(added, 0 if last is None else last + 1, ["created_at", "username"], "id")
    return numbered.select("id", "username", "created_at", "updated_at")


REGISTRATION = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("username", T.StringType()), T.StructField("user_role", T.StringType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("outcome", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("account_id", T.LongType())])
USERS = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("user_login", T.StringType()),
                      T.StructField("user_role", T.StringType())])
ACCOUNTS = T.StructType([T.StructField("id", T.LongType()), T.StructField("username", T.StringType()),
                         T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])
TABLES = {"users": USERS, "customers": ACCOUNTS, "sellers": ACCOUNTS}


@dataclass(frozen=True)
class Registry:
    """``users``, ``customers`` and ``sellers`` below one folder, changed together, a batch of registrations at a time.

    A batch is decided first: outcomes and ids are written down. Its rows then go to the three tables, each in place of what the batch
    wrote there before, and last the batch is committed. Readers see committed batches only. A batch that comes again is not decided
    again: if it is committed it adds nothing, and if it stopped half-way its decisions are carried out, by whoever registers next.
    """

    root: str

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        committed = folded.last(spark, f"{self.root}/committed")
        return folded.read(spark, f"{self.root}/{name}", TABLES[name], -1 if committed is None else committed)

    def found(self, tables: dict[str, DataFrame]) -> None:
        """Begin with the rows that there are, as batch 0."""
        for name, rows in tables.items():
            folded.write(rows.select(*TABLES[name].fieldNames()), f"{self.root}/{name}", 0)
        self._commit(next(iter(tables.values())).sparkSession, 0)

    def register(self, requests: DataFrame, batch_id: int) -> None:
        """Carry out a batch of registrations (``request_id``, ``username``, ``user_role``, ``created_at``); batch ids count from 1."""
        spark = requests.sparkSession
        self.finish(spark)
        if folded.has(spark, f"{self.root}/committed", batch_id):
            return
        rows = decided(requests, {name: self.table(spark, name) for name in TABLES})
        folded.write(rows.select(*REGISTRATION.fieldNames()), f"{self.root}/decided", batch_id)
        self._carry_out(spark, batch_id)

    def finish(self, spark: SparkSession) -> list[int]:
        """Carry out what was decided and never committed."""
        committed = f"{self.root}/committed"
        left = [b for b in folded.batches(spark, f"{self.root}/decided") if not folded.has(spark, committed, b)]
        for batch_id in left:
            self._carry_out(spark, batch_id)
        return left

    def _carry_out(self, spark: SparkSession, batch_id: int) -> None:
        rows = folded.read_batch(spark, f"{self.root}/decided", batch_id, REGISTRATION)
        added = rows.where(F.col("user_id").isNotNull())
        folded.write(added.select("user_id", F.col("username").alias("user_login"), "user_role"), f"{self.root}/users", batch_id)
        for role, name in ACCOUNT_TABLE.items():
            own = rows.where((F.col("user_role") == role) & F.col("account_id").isNotNull())
            own = own.select(F.col("account_id").alias("id"), "username", "created_at", F.col("created_at").alias("updated_at"))
            folded.write(own, f"{self.root}/{name}", batch_id)
        self._commit(spark, batch_id)

    def _commit(self, spark: SparkSession, batch_id: int) -> None:
        folded.write(spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")), f"{self.root}/committed", batch_id)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """All requests so far with what became of them."""
        return folded.read(spark, f"{self.root}/decided", REGISTRATION)


def decided(requests: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Requests with outcome, and the ids of the user and the account that come of them, above the highest there are."""
    outcomes = registration_outcomes(requests, tables["users"])
    registered = outcomes.where(F.col("outcome") == REGISTERED).select("request_id", "username", "user_role", "created_at")

    def numbered(rows: DataFrame, existing: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
        last = highest_id(existing, key)
        return number_rows(rows, 0 if last is None else last + 1, order, name).select("request_id", name)

    users = numbered(registered, tables["users"], "user_id", "user_id", ["created_at", "request_id"])
    accounts = [numbered(absent_from(registered.where(F.col("user_role") == role), tables[name], "username"), tables[name], "id",
                         "account_id", ["created_at", "username"]) for role, name in ACCOUNT_TABLE.items()]
    return outcomes.join(users, "request_id", "left").join(accounts[0].unionByName(accounts[1]), "request_id", "left")


def sessionise_logins(log: DataFrame) -> DataFrame:
    """Sessions from a log of ``login`` and ``logout`` events (``session_token``, ``user_id``, ``action``, ``ts``).

    A session starts at its first login and ends at its last logout, null while it is open. Logouts of a token
    that never logged in make no session.
    """
    return started(session_parts(log))


def session_parts(log: DataFrame) -> DataFrame:
    """What a part of the log says of each token. A logout may come without its login, which is in another part."""
    when = {a: F.when(F.col("action") == a, F.col("ts")) for a in ("login", "logout")}
    return log.groupBy("session_token").agg(
        F.min("user_id").alias("user_id"), F.min(when["login"]).alias("session_start"),
        F.max(when["logout"]).alias("session_end"))


def merge_parts(parts: DataFrame) -> DataFrame:
    """The same for several parts together: in any order, and a part that is given twice changes nothing."""
    return parts.groupBy("session_token").agg(F.min("user_id").alias("user_id"), F.min("session_start").alias("session_start"),
                                              F.max("session_end").alias("session_end"))


def started(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("session_start").isNotNull())


