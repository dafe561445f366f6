import zlib
from collections import defaultdict

from llm_fixtures import awkward, nothing  # noqa: F401
from tradewind.llm import sharding
from tradewind.llm.util import table


def by_shard(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["shard"]].append(r)
    return out


def test_shards_are_even_and_gapless(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sharding.shard_documents(docs)[0].collect()
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in rows)
    shards = by_shard(rows)
    assert sorted(shards) == list(range(8)) and len(rows) == len(text)
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())
    sizes = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(sizes) - min(sizes) < 0.01 * max(sizes)


def test_edits_move_few_slots(spark):
    weights = [(n * 7919) % 1000 + (50_000 if n == 3 else 0) for n in range(512)]
    first = sharding.first_map(512, 4)
    second = sharding.rebalanced(first, weights, 4)
    loads = [sum(w for w, s in zip(weights, second) if s == k) for k in range(4)]
    assert max(loads) - min(loads) < 10 and sum(a != b for a, b in zip(first, second)) < 256
    third = sharding.grown(second, weights, 4)
    assert all(b in (a, 4) for a, b in zip(second, third))
    loads = [sum(w for w, s in zip(weights, third) if s == k) for k in range(5)]
    assert max(loads) < 1.3 * min(loads)
    stored = sharding.map_table(spark, [first, second, third])
    assert [[r["shard"] for r in stored.where(f"version = {v}").orderBy("slot").collect()] for v in (1, 2, 3)] == [first, second, third]


def test_slots_do_not_depend_on_other_rows(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    some = {r["doc_id"]: r["virtual_slot"] for r in sharding.shard_documents(docs.where("doc_id < 50"))[0].collect()}
    every = {r["doc_id"]: r["virtual_slot"] for r in sharding.shard_documents(docs)[0].collect()}
    assert all(every[k] == v for k, v in some.items())


def test_awkward_rows(spark, awkward, nothing):
    rows = sharding.shard_documents(awkward)[0].collect()
    assert len(rows) == 14 and sorted(r["size"] for r in rows)[:4] == [1, 1, 1, 4]
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by_shard(rows).values())
    assert sharding.shard_documents(nothing)[0].count() == 0
