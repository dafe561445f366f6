from decimal import Decimal as D

import pytest
from helpers import PRODUCT, product, rows, ts

from tradewind.streaming import jobs
from tradewind.streaming.gate import PurchaseGate

REQUEST = "request_id long, session_token string, product_id long, quantity int, ts timestamp"


class Shop:
    """Requests on a folder, tables that can change, and a gate that can be made anew, as a new process would."""

    def __init__(self, spark, place):
        self.spark, self.place = spark, place
        self.sessions = [("t1", 1), ("t2", 2), ("t9", 9)]
        self.products = [product(1, "A", price="2.50", seller=7), product(2, "A", seller=8)]

    def tables(self):
        sessions = self.spark.createDataFrame([(t, u, ts(1), None) for t, u in self.sessions],
                                              "session_token string, user_id long, session_start timestamp, session_end timestamp")
        users = self.spark.createDataFrame([(1, "one", "customer"), (2, "two", "seller")], "user_id long, user_login string, user_role string")
        return sessions, users, self.spark.createDataFrame(self.products, PRODUCT)

    def gate(self, highest=None):
        return PurchaseGate(f"{self.place}/gate", self.tables, 1000, highest)

    def ask(self, *requests):
        self.requests(*requests).coalesce(1).write.mode("append").parquet(f"{self.place}/requests")

    def requests(self, *requests):
        return self.spark.createDataFrame([(*r, 3, ts(5)) for r in requests], REQUEST)

    def run(self, gate=None, after=None):
        stream = self.spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", "1").parquet(f"{self.place}/requests")
        jobs.publish_stream(stream, (gate or self.gate()).purchases, f"{self.place}/checkpoint", "parquet", f"{self.place}/topic",
                            after).awaitTermination()

    def sent(self):
        return rows(self.spark.read.parquet(f"{self.place}/topic"), "key", "value")

    def decided(self):
        return rows(self.gate().decisions(self.spark), "request_id", "status", "sell_id")


def message(sale, item, price, seller):
    return (str(sale), f'{{"customer_id":1,"product_id":{item},"sell_id":{sale},"price":{price},"seller_id":{seller},"quantity":3}}')


def test_accepted_and_refused_are_all_requests(spark, place):
    shop = Shop(spark, place)
    shop.ask((5, "t1", 1), (6, "no", 1), (7, "t2", 1), (8, "t9", 1), (9, "t1", 77), (10, "t1", 2))
    shop.ask((3, "t1", 1), (4, None, 1))
    shop.run()
    shop.run()  # nothing new
    assert [(r, s) for r, s, _ in shop.decided()] == sorted(
        [(5, 200), (6, 401), (7, 403), (8, 404), (9, 400), (10, 200), (3, 200), (4, 401)], key=repr)
    ids = sorted(i for _, _, i in shop.decided() if i is not None)
    assert ids == [1_000_000, 1_000_001, 1_000_002] and sorted(int(k) for k, _ in shop.sent()) == ids


def test_a_batch_that_runs_again_gives_the_same(spark, place):
    """Between the two runs a session ends, a price changes, and the requests come in another order."""
    shop = Shop(spark, place)
    first = rows(shop.gate().purchases(shop.requests((1, "t1", 1), (2, "t9", 1), (3, "t1", 2)), 0))
    shop.sessions, shop.products = [("t9", 1)], [product(1, "A", price="9.99", seller=1)]
    again = rows(shop.gate().purchases(shop.requests((3, "t1", 2), (2, "t9", 1), (1, "t1", 1)), 0))
    assert first == again and len(first) == 2
    later = shop.gate().purchases(shop.requests((4, "t9", 1)), 1)
    assert rows(later, "request_id", "sell_id", "price") == [(4, 1_000_002, D("9.99"))]
    assert rows(shop.gate().id_ranges(spark)) == [(0, 1_000_000, 1_000_001), (1, 1_000_002, 1_000_002)]


@pytest.mark.parametrize("stop", ["deciding", "recording", "publishing"])
def test_a_stop_at_any_step(spark, place, stop, monkeypatch):
    shop = Shop(spark, place)
    shop.ask((1, "t1", 1), (2, "t1", 2), (3, "no", 1))

    def stopping(*args, **more):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if stop == "publishing":
            m.setattr(jobs, "to_messages", stopping)
        else:
            from tradewind.sources import folded

            real = folded.write
            m.setattr(folded, "write", lambda rows, root, n: stopping() if root.endswith("decisions" if stop == "deciding" else "ids") else real(rows, root, n))
        with pytest.raises(Exception, match="stopped"):
            shop.run()
    shop.products = [product(1, "A", price="4.00", seller=7), product(2, "A", seller=8)]
    shop.ask((4, "t1", 1))
    shop.run()
    # What was decided before the stop keeps the price of that time.
    price = "4.00" if stop == "deciding" else "2.50"
    assert shop.sent() == [message(1_000_000, 1, price, 7), message(1_000_001, 2, "10.00", 8), message(1_000_002, 1, "4.00", 7)]
    assert shop.decided() == [(1, 200, 1_000_000), (2, 200, 1_000_001), (3, 401, None), (4, 200, 1_000_002)]


def test_ids_go_on_above_others_and_over_folds(spark, place):
    shop = Shop(spark, place)
    for n in range(5):
        shop.ask((n, "t1", 1), (100 + n, "no", 1))
    gate = shop.gate(highest=5_000_000)
    shop.run(gate, after=lambda session, batch_id: gate.fold(session, batch_id))
    ids = sorted(i for _, _, i in shop.decided() if i is not None)
    assert ids == [5_000_001 + n for n in range(5)] and len(shop.decided()) == 10
    assert sorted(r.last_id for r in gate.id_ranges(spark).collect()) == ids
