import pytest
from helpers import rows, ts

from tradewind.plans.accounts import ACCOUNTS, USERS, Registry
from tradewind.sources import folded

REQUEST = "request_id long, username string, user_role string, created_at timestamp"


def requests(spark, *given):
    return spark.createDataFrame([(n, name, role, ts(day)) for n, name, role, day in given], REQUEST)


@pytest.fixture
def registry(spark, place):
    made = Registry(f"{place}/accounts")
    made.found({"users": spark.createDataFrame([(5, "ann", "customer")], USERS),
                "customers": spark.createDataFrame([(8, "ann", ts(1), ts(1)), (9, "old", ts(1), ts(1))], ACCOUNTS),
                "sellers": spark.createDataFrame([], ACCOUNTS)})
    return made


FIRST = ((1, "bob", "seller", 3), (2, "ann", "customer", 2), (3, "bob", "customer", 4), (4, "old", "customer", 2), (5, "eve", "admin", 2),
         (6, "dan", "customer", 5))


def shown(spark, registry):
    return {name: rows(registry.table(spark, name), *("user_id user_login" if name == "users" else "id username").split())
            for name in ("users", "customers", "sellers")}


AFTER = {"users": [(5, "ann"), (6, "old"), (7, "bob"), (8, "dan")], "customers": [(10, "dan"), (8, "ann"), (9, "old")], "sellers": [(0, "bob")]}


def test_a_batch_adds_to_all_three_tables_once(spark, registry):
    for _ in range(2):
        registry.register(requests(spark, *FIRST), 1)
        assert shown(spark, registry) == AFTER
    assert dict(rows(registry.outcomes(spark), "request_id", "outcome")) == {
        1: "registered", 2: "duplicate", 3: "duplicate", 4: "registered", 5: "bad_role", 6: "registered"}
    registry.register(requests(spark, (7, "dan", "seller", 6), (8, "kim", "seller", 6)), 2)
    assert shown(spark, registry) == {**AFTER, "users": AFTER["users"] + [(9, "kim")], "sellers": [(0, "bob"), (1, "kim")]}


@pytest.mark.parametrize("stop", ["decided", "users", "customers", "sellers", "committed"])
def test_a_batch_that_stops_is_seen_whole_or_not_at_all(spark, registry, stop, monkeypatch):
    before, real = shown(spark, registry), folded.write

    def stopping(rows, root, batch_id):
        if root.endswith(f"/{stop}"):
            raise RuntimeError("stopped")
        return real(rows, root, batch_id)

    with monkeypatch.context() as m:
        m.setattr(folded, "write", stopping)
        with pytest.raises(RuntimeError):
            registry.register(requests(spark, *FIRST), 1)
    assert shown(spark, registry) == before
    again = Registry(registry.root)
    if stop == "decided":
        again.register(requests(spark, *FIRST), 1)
    else:  # another batch comes first, and brings a name that the stopped one has taken
        again.register(requests(spark, (9, "dan", "seller", 1)), 2)
        assert dict(rows(again.outcomes(spark), "request_id", "outcome"))[9] == "duplicate"
    assert shown(spark, again) == AFTER
