from tradewind.llm import revisits

SCHEMA = "record_id long, kind string, url string, at long, etag string, last_modified string, headers map<string,string>, status int"


def capture(number, kind, url, at, etag=None, modified=None, headers=None):
    return (number, kind, url, at, etag, modified, headers, 200)


def resolved(spark, *rows, **options):
    found = revisits.resolve(spark.createDataFrame(list(rows), SCHEMA), **options).collect()
    return {r["record_id"]: r for r in found}


def test_latest_earlier_response(spark):
    day = revisits.STEP
    rows = [capture(1, "response", "http://www.a.org/x/", 10, "e1"), capture(2, "response", "https://a.org/x#f", 20, "e2"),
            capture(3, "revisit", "http://A.org:80/x?utm_source=q", 20, "e1"), capture(4, "revisit", "http://a.org/x", 9 * day, "e2"),
            capture(5, "revisit", "http://a.org/x", 10, "e1"), capture(6, "revisit", "http://b.org/x", 50, "e1"),
            capture(7, "revisit", "http://a.org/x", 30), capture(8, "revisit", "http://a.org/x", 31, "zz"),
            capture(9, "revisit", None, 30, "e1"), capture(10, "revisit", "http://a.org/x", None, "e1"), capture(11, "other", "http://a.org/x", 5)]
    found = resolved(spark, *rows)
    assert {k: (r["response_id"], r["status"]) for k, r in found.items()} == {
        3: (1, "resolved"), 4: (2, "resolved"), 5: (None, "missing"), 6: (None, "missing"), 7: (2, "unchecked"), 8: (2, "changed"),
        9: (None, "missing"), 10: (None, "missing")}


def test_any_step_gives_the_same(spark):
    rows = [capture(n, "response" if n % 3 else "revisit", f"http://h.org/{n % 2}", n * 7 % 50, f"e{n % 4}") for n in range(60)]
    want = {k: (r["response_id"], r["status"]) for k, r in resolved(spark, *rows).items()}
    for r in (x for x in rows if x[1] == "revisit"):
        past = [(x[3], x[0]) for x in rows if x[1] == "response" and x[2] == r[2] and x[3] < r[3]]
        assert want[r[0]][0] == (max(past)[1] if past else None)
    for step in (1, 7, 1000):
        assert {k: (r["response_id"], r["status"]) for k, r in resolved(spark, *rows, step=step).items()} == want


def test_permitted_headers(spark):
    rows = [capture(1, "response", "http://a.org", 1, "e", headers={"ETag": "e", "Server": "s", "Date": "1", "date": "0"}),
            capture(2, "revisit", "http://a.org", 2, "e", headers={"DATE": "2", "Server": "t", "Expires": None})]
    assert resolved(spark, *rows)[2]["headers"] == {"etag": "e", "server": "s", "date": "2"}


def test_repeats_and_an_empty_table(spark):
    again = [capture(1, "response", "http://a.org", 1, "e")] * 2 + [capture(2, "revisit", "http://a.org", 2, "e")] * 2
    assert revisits.resolve(spark.createDataFrame(again, SCHEMA)).count() == 2
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
