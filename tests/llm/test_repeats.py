import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import awkward, nothing  # noqa: F401
from tradewind.llm import lpf, repeats


def plain(docs, length):
    raw = [(n, (t or "").encode()) for n, t in docs]
    count = Counter(r[k:k + length] for _, r in raw for k in range(len(r) - length + 1))
    out = []
    for n, r in raw:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if count[r[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((n, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_factors_equal_plain_ones():
    rng = random.Random(2)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(12, 40))) for _ in range(12)]
    text = np.array([x for s in strings for x in [*s.encode(), -1]])
    starts = np.cumsum([0, *(len(s) + 1 for s in strings)])[:-1]
    at = np.array([b + k for b, s in zip(starts, strings) for k in range(len(s) - 7)])
    origin = np.array(rng.sample(range(1000), len(at)))
    order, previous, following = lpf.factors(text, at, origin, 8)
    whole = {p: tuple(text[p:p + 8]) for p in at.tolist()}
    assert [whole[p] for p in order.tolist()] == sorted(whole.values())
    of = dict(zip(at.tolist(), origin.tolist()))
    for p, before, after in zip(order.tolist(), previous.tolist(), following.tolist()):
        same = [of[q] for q in whole if whole[q] == whole[p] and q != p]
        assert (before == 8) == any(o < of[p] for o in same) and (after == 8) == any(o > of[p] for o in same)


def corpus(rng):
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, docs = [text(n) for n in (35, 50, 90, 300)], []
    for _ in range(60):
        docs.append("".join(text(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 9):] * rng.randint(0, 1)
                            for _ in range(rng.randint(1, 4))))
    return [*docs, docs[0], docs[0], "ab" * 60, "x" * 33, "x" * 31, "", None, shared[3][10:60]]


@pytest.mark.parametrize("shard", [4096, 5])
def test_removal_equals_brute_force(spark, shard):
    """With a small shard, anchors with many places are divided."""
    docs = list(enumerate(corpus(random.Random(9))))
    found = repeats.deduplicate(spark.createDataFrame(docs, "doc_id long, text string"), 32, 8, keep_first=False, shard=shard)
    assert sorted(map(tuple, found.drop("kept").collect()), key=repr) == plain(docs, 32)


def test_first_copy_stays(spark):
    rng = random.Random(8)
    a, b, c = ("".join(rng.choice("abcdefghijk ") for _ in range(80)) for _ in range(3))
    docs = [(1, a + b), (2, c + a), (3, a + b), (4, b)]
    found = repeats.deduplicate(spark.createDataFrame(docs, "doc_id long, text string"), 32, 8).collect()
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in found} == {1: a + b, 2: c, 3: "", 4: ""}


def test_awkward_rows(spark, awkward, nothing):
    found = repeats.deduplicate(awkward, keep_first=False).drop("kept").collect()
    assert sorted(map(tuple, found), key=repr) == plain([(r["doc_id"], r["text"]) for r in awkward.collect()], 200)
    assert repeats.deduplicate(nothing).count() == 0
