import re
from collections import Counter

import numpy as np

from llm_fixtures import awkward, nothing  # noqa: F401
from tradewind.llm import boosting, quality
from tradewind.llm.util import table


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", "".join(words))), duplicates, len(repeated)


def test_statistics_equal_plain_ones():
    for text in ("", " ", "a b a b a b", "x\n\ny\nx\n x\nx", "a#b *c* | d | e", "café   \U0001F600 a\x1cb", "a a a a", "one two"):
        assert quality.measure(text)[:5] == plain(text)


def test_forest_keeps_its_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + x[:, 1] ** 2 > 0.9).astype(float)
    forest = boosting.fit(x, y, {0: 1, 2: -1}, trees=30)
    assert ((forest.score(x) > 0) == (y > 0)).mean() > 0.95
    line = np.linspace(0, 1, 200)
    for base in rng.random((20, 3)):
        for f, sign in ((0, 1), (2, -1)):
            probe = np.repeat(base[None], 200, 0)
            probe[:, f] = line
            assert (np.diff(forest.score(probe)) * sign >= -1e-9).all()


def test_flat_scoring_equals_walking_the_trees():
    rng = np.random.default_rng(2)
    x = rng.random((400, 4))
    forest = boosting.fit(x, (x[:, 0] > x[:, 1]).astype(float), {}, trees=5, depth=3)
    for row, score in zip(x[:50], forest.score(x[:50])):
        total = forest.base
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(row[f[at]] > t[at])
            total += leaf[at - len(f)]
        assert abs(total - score) < 1e-9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    model = quality.train(table(spark, folder, "documents"), table(spark, folder, "labels"))
    assert model.held_out["good_kept"] > 0.99 and model.held_out["bad_rejected"] > 0.9, model.held_out


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (9, None), (None, 1)], "doc_id long, quality int")
    found = quality.judge(awkward, labels).collect()
    assert len(found) == 14 and all(r["base_failed"] and not r["kept"] for r in found if not (r["text"] or "").strip())
    assert sorted(tuple(r[c] for c in quality.BASE) for r in found) == sorted(plain(r["text"]) for r in awkward.collect())
    assert quality.judge(nothing, labels).count() == 0
    assert quality.judge(awkward, labels.limit(0)).where("not base_failed and not kept").count() == 0
    assert quality.kept(awkward, labels).columns == awkward.columns
