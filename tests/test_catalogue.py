import json
from decimal import Decimal as D

import pytest
from helpers import PRODUCT, product, rows, ts
from pyspark.sql import functions as F

from tradewind.operators.merge import RepeatedSourceKey
from tradewind.plans import catalogue
from tradewind.sources import files


@pytest.fixture
def lake(spark, place):
    name = catalogue.create(spark, f"lake_{place.rsplit('-', 1)[1]}", place, replace=True)
    catalogue.append(spark, name, products(spark, product(1, "A"), product(2, "A"), product(3, "B"), product(4, "it's")))
    return name


def products(spark, *items):
    return spark.createDataFrame(list(items), PRODUCT)


def shown(spark, name):
    return rows(spark.table(name), "product_id", "product_name", "category")


def test_create_keeps_or_replaces(spark, lake):
    database = lake.split(".")[0]
    catalogue.create(spark, database)
    assert spark.table(lake).count() == 4
    catalogue.create(spark, database, replace=True)
    assert spark.table(lake).count() == 0


def test_append_needs_the_table(spark):
    with pytest.raises(LookupError):
        catalogue.append(spark, "default.no_such_products", products(spark, product(1, "A")))


def test_upsert_updates_inserts_and_leaves_the_rest(spark, lake):
    old = product(2, "A")
    catalogue.upsert(spark, lake, products(
        spark, product(2, "A", name="it's \\ new", price="99.99", seller=7, created=ts(20), updated=ts(21)),
        product(9, "C", created=ts(20), updated=ts(21))))
    assert shown(spark, lake) == [(1, "p1", "A"), (2, "it's \\ new", "A"), (3, "p3", "B"), (4, "p4", "it's"), (9, "p9", "C")]
    (row,) = spark.table(lake).where("product_id = 2").collect()
    assert (row.price, row.seller_id, row.created_at, row.updated_at) == (D("99.99"), 7, old[5], ts(21))


def test_moving_products_empties_and_fills_categories(spark, lake):
    catalogue.upsert(spark, lake, products(spark, product(3, "A"), product(4, "new one"), product(1, "B")))
    assert shown(spark, lake) == [(1, "p1", "B"), (2, "p2", "A"), (3, "p3", "A"), (4, "p4", "new one")]
    parts = rows(spark.sql(f"show partitions {lake}"))
    assert len(parts) == 3


def test_categories_are_pruned_however_many_they_are(spark, lake):
    touched = spark.createDataFrame([(f"c{n}",) for n in range(3000)] + [(None,)], "category string")
    plan = catalogue._in_categories(spark.table(lake), touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "Join" not in plan


def test_categories_come_and_go(spark, lake):
    catalogue.upsert(spark, lake, products(spark, product(3, "A"), product(4, None), product(1, "C")))
    assert shown(spark, lake) == [(1, "p1", "C"), (2, "p2", "A"), (3, "p3", "A"), (4, "p4", None)]
    catalogue.upsert(spark, lake, products(spark, product(1, "A"), product(4, "A")))
    assert shown(spark, lake) == [(1, "p1", "A"), (2, "p2", "A"), (3, "p3", "A"), (4, "p4", "A")]
    assert len(rows(spark.sql(f"show partitions {lake}"))) == 1


def test_category_may_be_null(spark, lake):
    catalogue.upsert(spark, lake, products(spark, product(3, None)))
    assert (3, "p3", None) in shown(spark, lake)
    catalogue.upsert(spark, lake, products(spark, product(3, "B")))
    assert (3, "p3", "B") in shown(spark, lake) and len(shown(spark, lake)) == 4


def test_only_touched_categories_are_rewritten(spark, lake):
    files = {r[0] for r in rows(spark.table(lake).where("category <> 'A'").select(F.input_file_name()))}
    catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x")))
    assert files == {r[0] for r in rows(spark.table(lake).where("category <> 'A'").select(F.input_file_name()))}


def test_repeated_source_key_is_refused(spark, lake):
    before = shown(spark, lake)
    with pytest.raises(RepeatedSourceKey):
        catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x"), product(1, "A", name="y")))
    assert shown(spark, lake) == before


def test_applying_a_stage_again_changes_nothing(spark, lake, place):
    stage = f"{place}-stage"
    catalogue.stage_upsert(spark, lake, products(spark, product(3, "A", name="x")), stage)
    catalogue.apply_staged(spark, lake, stage)
    once = shown(spark, lake)
    catalogue.apply_staged(spark, lake, stage)
    assert shown(spark, lake) == once == [(1, "p1", "A"), (2, "p2", "A"), (3, "x", "A"), (4, "p4", "it's")]


STEPS = ("stage_upsert", "decide", "overwrite_staged", "drop_emptied", "apply_staged")


class Stopped(RuntimeError):
    pass


def stopped_after(monkeypatch, step):
    """Let an upsert die as soon as a step is done."""
    real = getattr(catalogue, step)

    def stopping(*args):
        real(*args)
        raise Stopped

    monkeypatch.setattr(catalogue, step, stopping)


def leftovers(spark, lake):
    return [stage for kind in catalogue._stages(spark, lake) for stage in kind]


@pytest.mark.parametrize("step", STEPS)
def test_an_upsert_that_stops_is_finished_or_undone(spark, lake, step, monkeypatch):
    """Category B loses its only product, C is new, A changes; then another upsert comes, from a process that knows nothing of it."""
    before = shown(spark, lake)
    with monkeypatch.context() as m:
        stopped_after(m, step)
        with pytest.raises(Stopped):
            catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x"), product(3, "C"), product(9, None)))
    after = [(1, "x", "A"), (2, "p2", "A"), (3, "p3", "C"), (4, "p4", "it's"), (9, "p9", None)]
    decided = step != "stage_upsert"
    seen = rows(catalogue.read(spark, lake), "product_id", "product_name", "category")
    assert seen == (after if decided else before) and len(leftovers(spark, lake)) == 1
    catalogue.upsert(spark, lake, products(spark, product(2, "A", name="y")))
    assert shown(spark, lake) == sorted([(r[0], "y", r[2]) if r[0] == 2 else r for r in (after if decided else before)], key=repr)
    parts = rows(spark.sql(f"show partitions {lake}"))
    assert len(parts) == (4 if decided else 3) and leftovers(spark, lake) == []


def test_a_torn_overwrite_is_done_again(spark, lake, monkeypatch):
    """The write of new partitions dies between taking the old ones away and putting the new ones in place."""
    with monkeypatch.context() as m:
        stopped_after(m, "decide")
        with pytest.raises(Stopped):
            catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x"), product(3, "A")))
    spark.sql(f"alter table {lake} drop partition (category = 'A')")
    assert shown(spark, lake) == [(3, "p3", "B"), (4, "p4", "it's")]
    assert catalogue.recover(spark, lake) == 1 and catalogue.recover(spark, lake) == 0
    assert shown(spark, lake) == [(1, "x", "A"), (2, "p2", "A"), (3, "p3", "A"), (4, "p4", "it's")]


def test_rows_appended_after_a_stop_are_kept(spark, lake, monkeypatch):
    with monkeypatch.context() as m:
        stopped_after(m, "overwrite_staged")
        with pytest.raises(Stopped):
            catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x")))
    catalogue.append(spark, lake, products(spark, product(7, "A")))
    assert leftovers(spark, lake) == []
    catalogue.upsert(spark, lake, products(spark, product(8, "A")))
    assert [r[:2] for r in shown(spark, lake)] == [(1, "x"), (2, "p2"), (3, "p3"), (4, "p4"), (7, "p7"), (8, "p8")]


def test_a_stage_that_is_half_removed_is_not_applied(spark, lake, monkeypatch):
    with monkeypatch.context() as m:
        stopped_after(m, "apply_staged")
        with pytest.raises(Stopped):
            catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x")))
    (stage,) = leftovers(spark, lake)
    files.remove(spark, f"{stage}/_decided")
    files.remove(spark, f"{stage}/rows")
    assert rows(catalogue.read(spark, lake)) == rows(spark.table(lake))
    assert catalogue.recover(spark, lake) == 0 and leftovers(spark, lake) == []
    assert (1, "x", "A") in shown(spark, lake)


def test_a_refused_source_leaves_nothing_to_finish(spark, lake):
    with pytest.raises(RepeatedSourceKey):
        catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x"), product(1, "A", name="y")))
    assert catalogue.recover(spark, lake) == 0 and leftovers(spark, lake) == []


def test_repeated_target_rows_are_all_updated(spark, lake):
    catalogue.append(spark, lake, products(spark, product(1, "B", name="copy")))
    catalogue.upsert(spark, lake, products(spark, product(1, "A", name="x")))
    assert [r for r in shown(spark, lake) if r[0] == 1] == [(1, "x", "A"), (1, "x", "A")]


def test_listing_omits_nulls(spark):
    got = catalogue.to_json_lines(products(spark, (1, "a", None, D("2.50"), 3, None, ts(1), "A"))).collect()
    assert json.loads(got[0].document) == {"product_id": 1, "product_name": "a", "price": 2.5, "seller_id": 3,
                                           "updated_at": "2024-01-01T00:00:00.000Z", "category": "A"}


def test_missing_fields_are_named(spark):
    full = {"product_id": "7", "product_name": "n", "price": 1.5, "product_description": "", "created_at": "2024-01-01T00:00:00",
            "updated_at": "2024-01-02T00:00:00", "category": "A", "seller_id": 3}
    texts = [full, {**full, "product_id": "x", "price": None}, {k: v for k, v in full.items() if k != "category"}, "nonsense"]
    documents = spark.createDataFrame([(i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)],
                                      "n int, document string")
    records = catalogue.parse_records(documents)
    assert rows(catalogue.complete(records), "n", "product_id", "price") == [(0, 7, D("1.50"))]
    assert rows(catalogue.incomplete(records), "n", "missing_fields") == [
        (1, ["product_id", "price"]), (2, ["category"]), (3, list(catalogue.REQUIRED))]


ACCESS = [("t1", 1), ("t2", 2), ("t9", 9)]


def access(spark):
    sessions = spark.createDataFrame([(t, u, ts(1), None) for t, u in ACCESS],
                                     "session_token string, user_id long, session_start timestamp, session_end timestamp")
    users = spark.createDataFrame([(1, "one", "seller"), (2, "two", "customer")], "user_id long, user_login string, user_role string")
    return sessions, users


def test_edit_path(spark, lake):
    sessions, users = access(spark)
    requests = spark.createDataFrame(
        [(1, "t1", "1", "first", D("5.00")), (2, "t1", "1", "second", None), (3, "t2", "1", "x", None), (4, "t1", "77", "x", None),
         (5, "no", "1", "x", None), (6, "t9", "1", "x", None), (7, "t1", "abc", "x", None), (8, "t1", "3", None, D("6.00"))],
        "request_id long, session_token string, product_id string, product_name string, price decimal(18,2)")
    checked = catalogue.checked_edits(requests, sessions, users, spark.table(lake).unionByName(
        products(spark, product(50, "A", seller=2))))
    assert rows(checked, "request_id", "status") == [(1, 200), (2, 200), (3, 403), (4, 404), (5, 401), (6, 404), (7, 404), (8, 200)]
    catalogue.upsert(spark, lake, catalogue.edited_products(checked, ts(25)))
    got = rows(spark.table(lake).where("product_id in (1, 3)"), "product_id", "product_name", "price", "created_at", "updated_at")
    assert got == [(1, "second", D("5.00"), ts(1), ts(25)), (3, "p3", D("6.00"), ts(1), ts(25))]


def test_own_products_only(spark):
    sessions, users = access(spark)
    requests = spark.createDataFrame([(1, "t1", "50", "x", None)],
                                     "request_id long, session_token string, product_id string, product_name string, price decimal(18,2)")
    checked = catalogue.checked_edits(requests, sessions, users, products(spark, product(50, "A", seller=2)))
    assert rows(checked, "status") == [(403,)]


def test_add_path(spark, lake):
    sessions, users = access(spark)
    requests = spark.createDataFrame(
        [(n, "t1" if n % 2 else "t2", f"new {n}", None, "Z", 1.005 * n) for n in range(1, 9)],
        "request_id long, session_token string, product_name string, product_description string, category string, price double")
    added, refused = catalogue.added_products(requests, sessions, users, ts(25), 1000, ["request_id"])
    catalogue.append(spark, lake, added)
    got = rows(spark.table(lake).where("category = 'Z'"), "product_id", "product_name", "product_description", "seller_id", "created_at")
    assert got == [(1_000_000 + i, f"new {n}", "", 1, ts(25)) for i, n in enumerate((1, 3, 5, 7))]
    assert rows(refused, "status") == [(403,)] * 4
