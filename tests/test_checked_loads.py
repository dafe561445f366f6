from collections import Counter

import pytest
from helpers import ids, rows

from tradewind.plans.checked_loads import CheckedTable, not_null, one_of, text_length
from tradewind.sources import files

SCHEMA = "id long, name string, role string, owner long"


def table(spark, place, owners=(1, 2)):
    return CheckedTable(f"{place}/users", frame(spark).schema, {**not_null("id", "name"), **text_length("name", 5), **one_of("role", "a", "b")},
                        {"owner": ids(spark, "owner", *owners)}, "name", ("id",))


def frame(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def test_rows_that_break_something_are_named(spark, place):
    checked = table(spark, place)
    given = frame(spark, (1, "x", "a", 1), (2, "x", "b", 2), (3, None, "c", 9), (4, "toolong", "a", None), (None, "y", None, 1), (6, "z", None, 2),
                  (7, "w", "a", 3), (8, "w", "a", 1), (5, "w", "b", 1))
    assert checked.load(given, 0) == {"read": 9, "loaded": 3, "quarantined": 6}
    assert rows(checked.rows(spark), "id", "name") == [(1, "x"), (5, "w"), (6, "z")]
    assert dict(rows(checked.quarantined(spark), "id", "broken")) == {
        2: ["name unique"], 3: ["name not null", "role in a, b", "owner references"], 4: ["name length <= 5"], None: ["id not null"],
        7: ["owner references"], 8: ["name unique"]}


def test_loads_know_earlier_ones_and_may_run_again(spark, place):
    checked = table(spark, place)
    checked.load(frame(spark, (9, "x", "a", 1)), 0)
    for _ in range(2):  # a load that runs again replaces itself, and is not compared with itself
        assert checked.load(frame(spark, (1, "x", "a", 1), (2, "y", "a", 1)), 1) == {"read": 2, "loaded": 1, "quarantined": 1}
    assert rows(checked.rows(spark), "id") == [(2,), (9,)] and rows(checked.quarantined(spark), "id") == [(1,)]


def test_a_load_that_stopped_is_not_seen(spark, place):
    checked = table(spark, place)
    checked.load(frame(spark, (1, "x", "a", 1), (2, "x", "a", 1)), 0)
    files.remove(spark, f"{place}/users/batch/0/_SUCCESS")
    assert checked.rows(spark).count() == checked.quarantined(spark).count() == 0


@pytest.mark.parametrize("rule", ["unique", "references"])
def test_a_value_of_a_third_of_the_rows_is_split(spark, place, rule):
    """Plans of both kinds of join, with broadcasting off: the executed plan splits the hot value, and no row is lost."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        given = spark.range(60000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('n', id) end as name", "'a' as role",
                                              "case when id % 3 = 0 then 1 else id end as owner").repartition(16).cache()
        given.count()
        if rule == "unique":
            checked = CheckedTable(place, given.schema, unique="name", order=("id",))
            want = Counter({0: 40001, 1: 19999})
        else:
            checked = CheckedTable(place, given.schema, references={"owner": spark.range(1, 60000, 2).withColumnRenamed("id", "owner")})
            want = Counter(0 if n % 3 == 0 or n % 2 else 1 for n in range(60000))
        judged = checked.judged(given)
        assert Counter(len(r["_broken"]) for r in judged.collect()) == want
        assert "skew=true" in judged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
