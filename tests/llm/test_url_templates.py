import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tradewind.llm import url_templates
from tradewind.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, label int, host string, template int"


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(r), r, v) for v, r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = ["http://a.example.org/es/1?x", "HTTPS://Example.ORG/en/12#t", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/fr", "http://com/de/x",
        "http://xcom/de/", "http://org", "http://org/", "http://ÉA.org:80/q", "http://u@x.com/de/?a://b/c", "no url", "", None, "://", "http://?q", "x://a#b/c",
        "http://a.com/de/\nnext", "http://a//b", "http://a.net/" + "s/" * 500]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(n, u, None, "x", 1) for n, u in enumerate(URLS)] * 2, SCHEMA)
    found = url_templates.judge(pages, URL_RULES).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        host, path, rule, verdict = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] == (verdict or "allow")


def test_bad_templates_are_rejected(spark):
    rows = []
    for n in range(400):
        rows.append((n, f"http://h.net/blog/post-{n}", 0 if n % 4 else None, "", 0))
        rows.append((1000 + n, f"http://h.net/spam/{n:x}/{chr(97 + n % 26)}{n}", 1 if n % 3 else None, "", 0))
        rows.append((2000 + n, f"http://h.net/{'uvw'[n % 3]}/item{n}word", 0, "", 0))
        rows.append((3000 + n, f"http://h.net/wiki/{''.join(chr(97 + int(d)) for d in str(n))}", 0, "", 0))
    found = {r["page_id"]: r for r in url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()}
    assert len(found) == 1600
    assert {r["verdict"] for n, r in found.items() if 1000 <= n < 2000} == {"block"}
    assert {r["verdict"] for n, r in found.items() if not 1000 <= n < 2000} == {"allow"}
    assert len({r["template"] for n, r in found.items() if 2000 <= n < 3000}) == 1, "alike branches are merged"
    assert {r["template"].rsplit("/", 1)[1] for n, r in found.items() if n >= 3000} == {"*"}, "a variable segment"


def test_a_bad_section_of_a_wide_host_is_rejected(spark):
    names = [f"s{chr(97 + n)}s" for n in range(25)]
    for sections in (names[:10], names):  # few, and more than a node has before it counts as variable
        rows = [(k * 1000 + n, f"http://wide.net/{s}/page-{n}", int(k == 3), "", 0) for k, s in enumerate(sections) for n in range(60)]
        rows += [(50_000 + n, f"http://bad.net/{s}/page-{n}-{k}", int(k != 3), "", 0) for k, s in enumerate(sections) for n in range(60)]
        found = url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
        assert len(found) == len(rows)
        for r in found:
            assert r["verdict"] == ("block" if (r["path"].startswith("/sds/")) == (r["host"] == "wide.net") else "allow"), r


def test_bad_branches_at_any_depth_are_rejected(spark):
    deep = "/".join("abcdefghi")
    rows = [(n, f"http://deep.net/{deep}/{kind}/more/p{n}x", int(kind == "spam"), "", 0)
            for n in range(300) for kind in ("spam" if n % 3 == 0 else "news",)]
    rows += [(1000 + n, f"http://deep.net/{deep}", 0, "", 0) for n in range(5)]
    found = url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    assert len(found) == 305 and all(r["verdict"] == ("block" if "/spam/" in r["path"] else "allow") for r in found)


def sums(rows, key):
    out = {}
    for r in rows:
        if (k := key(r)) is not None:
            n, labelled, bad = out.get(k, (0, 0, 0))
            out[k] = (n + r["n"], labelled + r["k"], bad + r["b"])
    return out


def differs(share, bad, labelled, z=url_templates.Z):
    return abs(bad - share * labelled) >= z * math.sqrt(max(share * (1 - share), 1e-4) * max(labelled, 1))


def plain_tree(pages, depth):
    """Template by (host, shape), with one dictionary after the other."""
    def shape(path):
        return re.sub(r"[0-9]+", "{n}", re.sub(r"(?i)\b[0-9a-f]{12,}\b", "{x}", path))

    shapes = {}
    for _, url, label in pages:
        host, path = plain(url)[:2]
        r = shapes.setdefault((host, shape(path)), {"host": host, "shape": shape(path), "base": "", "rest": shape(path), "n": 0, "k": 0, "b": 0})
        r["n"], r["k"], r["b"] = r["n"] + 1, r["k"] + (label is not None), r["b"] + (label or 0)
    rows, out = list(shapes.values()), {}
    while rows:
        for r in rows:
            parts = r["rest"].removeprefix("/").split("/")
            r["level"] = [parts[d] if r["rest"] != "" and d < len(parts) else None for d in range(depth)]
            r["next"] = "/" + "/".join(parts[depth:]) if len(parts) > depth else None
        for d in range(depth):
            parent = lambda r: (r["host"], r["base"], *r["level"][:d])  # noqa: E731, B023
            own = sums(rows, lambda r: (*parent(r), r["level"][d]) if r["level"][d] is not None else None)
            for r in rows:
                if r["level"][d] is None:
                    continue
                kids = [v for k, v in own.items() if k[:-1] == parent(r)]
                labelled, bad = own[(*parent(r), r["level"][d])][1:]
                share = sum(v[2] for v in kids) / max(sum(v[1] for v in kids), 1)
                stays = labelled >= url_templates.ENOUGH or labelled >= url_templates.LEAST and differs(share, bad, labelled)
                r["new"] = r["level"][d] if len(kids) < 2 or stays else "*"
            for r in rows:
                if r["level"][d] is not None:
                    r["level"][d] = r["new"]
        for r in rows:
            r["merged"] = list(r["level"])
        for d in reversed(range(depth)):
            node = lambda r: (r["host"], r["base"], *r["merged"])
            own = sums(rows, node)
            parent = lambda k: (*k[:2 + d], *k[3 + d:])  # noqa: E731, B023
            alike = set()
            for k, v in own.items():
                kids = [w for j, w in own.items() if j[2 + d] is not None and parent(j) == parent(k)]
                if k[2 + d] is not None and len(kids) > 1:
                    share = sum(w[2] for w in kids) / max(sum(w[1] for w in kids), 1)
                    if not differs(share, v[2], v[1]):
                        alike.add(k)
            for r in [r for r in rows if node(r) in alike]:
                r["found"] = True
            for r in rows:
                if r.pop("found", False):
                    r["merged"][d] = "*"
        for r in rows:
            own = [m for m in r["merged"] if m is not None]
            r["template"] = r["base"] + ("/" + "/".join(own) if r["merged"][0] is not None else "")
        whole = sums(rows, lambda r: (r["host"], r["template"]))
        below = sums(rows, lambda r: (r["host"], r["template"]) if r["next"] is not None else None)
        later = []
        for r in rows:
            key = (r["host"], r["template"])
            if r["next"] is not None and 0 < whole[key][2] < whole[key][1] and below[key][1] >= url_templates.LEAST:
                later.append({**r, "base": r["template"], "rest": r["next"]})
            else:
                out[r["host"], r["shape"]] = r["template"]
        rows = later
    return out


@pytest.mark.parametrize("seed", range(3))
def test_the_tree_equals_a_plain_one(spark, seed):
    rng, pages = random.Random(seed), []
    for n in range(700):
        parts = [rng.choice("abcdefgh"[:rng.choice((2, 8))]) for _ in range(rng.randint(0, 4))]
        bad = "a" in parts[:1] and "b" in parts[1:3] or len(parts) > 3 and parts[3] == "c"
        label = rng.choice((int(bad), int(bad), None, rng.randint(0, 1)))
        pages.append((n, f"http://{rng.choice('xy')}.net" + "".join(f"/{p}" for p in parts) + rng.choice(("", "/", f"/{n % 5}p")), label))
    frame = spark.createDataFrame([(*p, "", 0) for p in pages], SCHEMA)
    host, path = url_templates.host_and_path(F.col("url"))
    found = url_templates.templates(frame.select(F.col("label").cast("long").alias("label"), host.alias("host"), path.alias("path")), depth=2)
    rows = {(r["host"], r["shape"]): r["template"] for r in found.collect()}
    want = plain_tree(pages, 2)
    assert rows == want and len(set(want.values())) > 5
    assert max(t.count("/") for t in want.values()) > 2, "some templates are refined"


def test_the_threshold_comes_from_held_out_labels(spark):
    """Sections of 9 in 10, 4 in 10 and 1 in 10 bad pages: held-out pages say where to cut, and what the cut costs."""
    rng = random.Random(3)
    rows = [(n, f"http://h.net/{s}/p{n}", int(rng.random() < share), "", 0)
            for k, (s, share) in enumerate((("worst", 0.9), ("mixed", 0.4), ("fine", 0.1))) for n in range(k * 1000, k * 1000 + 1000)]
    host, path = url_templates.host_and_path(F.col("url"))
    frame = spark.createDataFrame(rows, SCHEMA).select("page_id", "url", F.col("label").cast("long").alias("label")).withColumns(
        {"host": host, "path": path})
    found = url_templates.learn_threshold(frame, 20.0, 4)
    assert 0.4 < found.share < 0.9 and found.blocked_bad / found.blocked > 0.85 and found.kept_bad / found.kept < 0.3
    assert 500 < found.blocked + found.kept < 700
    verdicts = {r["page_id"]: r["verdict"] for r in url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()}
    assert {verdicts[n] for n in range(1000)} == {"block"} and {verdicts[n] for n in range(1000, 3000)} == {"allow"}


def test_labels_without_a_pattern_reject_nothing(spark):
    rng = random.Random(4)
    rows = [(n, f"http://h.net/{rng.choice('abc')}/p{n}", int(rng.random() < 0.3), "", 0) for n in range(2000)]
    assert {r["verdict"] for r in url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()} == {"allow"}


def test_thresholds_of_counted_pages():
    chosen = url_templates.chosen
    assert chosen([]).share is None and chosen([(10, 50, 0)]).share is None and chosen([(10, 50, 50)]).share is None
    assert chosen([(10, 90, 9), (120, 60, 50)]) == url_templates.Threshold(0.6, 60, 50, 90, 9)
    assert chosen([(10, 50, 15), (20, 50, 16)]).share is None


def test_nulls_and_very_long_paths(spark):
    rows = [(None, "http://h.net/a", 1, "", 0), (None, None, None, "", 0), (None, None, None, None, None), (1, "http://h.net/" + "a/" * 40 + "x" * 100_000, 0, "", 0)]
    found = url_templates.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    assert len(found) == 4 and {r["verdict"] for r in found} == {"allow"}


def test_an_empty_table(spark):
    assert url_templates.judge(spark.createDataFrame([], SCHEMA), URL_RULES).count() == 0
