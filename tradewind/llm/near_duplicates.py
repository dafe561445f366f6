"""Near-duplicate documents: banded MinHash candidates, a sequential Bayesian test, and exact verification of what is left.

Documents with equal sets of shingles are one node. Nodes that share a band meet in a bucket. Two nodes are compared in the first
bucket that they share: their signatures step by step until they are too unlike, then their full sets. Buckets are divided into
blocks, and a unit of work compares two blocks; it puts out only links that join what it hasn't joined yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import bloom, sketches
from tradewind.llm.graph import components
from tradewind.llm.util import arrow_batches, stored, text_or_empty
from tradewind.operators.keyed import own_shuffle

#: Chance at which a pair at the threshold may be lost by the signatures' test; the bands lose one in 2.5 million.
MISS = 1e-6
#: Nodes of a block, and pairs that are compared at a time.
BLOCK, PAIRS = 256, 200_000
SKETCH = "node binary, n_shingles long, sketch binary, bands array<long>"


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text) and the sketch of each document."""
    @F.pandas_udf(SKETCH)
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sketches._Words()
        for texts in batches:
            sets = [sketches.shingles(t, words, known) for t in texts]
            least = np.array([sketches.signature(s) for s in sets], np.uint32).reshape(-1, sketches.HASHES)
            small, bands = sketches.bytes_of(least), sketches.bands_of(least).view(np.int64)
            yield pd.DataFrame({
                "node": [xxhash.xxh128_digest(s.tobytes()) for s in sets], "n_shingles": [len(s) for s in sets],
                "sketch": [x.tobytes() for x in small], "bands": list(bands)})

    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("t", F.xxhash64("text"))
    return rows.select("doc_id", "t", sketch("text").alias("s")).select("doc_id", "t", "s.*")


class _Units:
    """Rows of whole units, in the order of units: pairs of nodes that first meet in their unit and pass the test."""

    def __init__(self, rows: pd.DataFrame, limits: list[tuple[int, int]]):
        self.rows, self.limits = rows, limits
        self.block, self.band = rows["block"].to_numpy(np.int64), rows["band"].to_numpy(np.int64)
        self.sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        self.short = np.array(rows["bands"].to_list(), np.int64).reshape(len(rows), sketches.BANDS)
        same = np.ones(max(len(rows) - 1, 0), bool)
        for c in ("key", "one", "two"):
            v = rows[c].to_numpy()
            same &= v[1:] == v[:-1]
        self.starts = np.concatenate(([0], np.flatnonzero(~same) + 1, [len(rows)])) if len(rows) else np.zeros(1, np.int64)

    def found(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of units, both rows and the matches of pairs; all of a unit come together."""
        unit, a, b, held = [], [], [], 0
        for n, (start, end) in enumerate(zip(self.starts[:-1].tolist(), self.starts[1:].tolist())):
            one, two = np.triu_indices(end - start, 1)
            one, two = one + start, two + start
            if self.rows["one"].iat[start] != self.rows["two"].iat[start]:
                across = self.block[one] != self.block[two]
                one, two = one[across], two[across]
            unit.append(np.full(len(one), n))
            a.append(one)
            b.append(two)
            held += len(one)
            if held >= PAIRS:
                yield self._tested(np.concatenate(unit), np.concatenate(a), np.concatenate(b))
                unit, a, b, held = [], [], [], 0
        if held:
            yield self._tested(np.concatenate(unit), np.concatenate(a), np.concatenate(b))

    def _tested(self, unit, a, b):
        before = np.arange(sketches.BANDS)[None, :] < self.band[a][:, None]
        fresh = ~((self.short[a] == self.short[b]) & before).any(1)
        unit, a, b = unit[fresh], a[fresh], b[fresh]
        live, count = sketches.survivors(a, b, self.sketch, self.limits)
        return unit[live], a[live], b[live], count


def _by_unit(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of whole units."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < most:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = (rows["key"] == rows["key"].iloc[-1]) & (rows["one"] == rows["one"].iloc[-1]) & (rows["two"] == rows["two"].iloc[-1])
        if not last.all():
            yield rows[~last].reset_index(drop=True)
            held = [rows[last]]
    if held:
        yield pd.concat(held, ignore_index=True)


UNIT = "key long, one int, two int, block int, band int, node binary, sketch binary, bands array<int>"


def candidates(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes in units. A bucket of m nodes has m / ``block`` blocks, and each block meets each other one in a unit."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # The sizes come partitioned by key; shuffled by the join itself, they let a hot band be split.
    placed = banded.join(own_shuffle(shared, "key"), "key").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = placed.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block",
                          "band", "node")
    short = nodes.select("node", "sketch", F.transform("bands", lambda b: b.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("bands"))
    return units.join(short, "node").select("key", "one", "two", "block", "band", "node", "sketch", "bands")


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, miss: float, block: int) -> DataFrame:
    """Pairs of nodes ``a``, ``b`` whose full sets are alike, enough of them to join all that are joined."""
    limits = sketches.least_matches(percent / 100, miss)
    units = candidates(nodes, block).repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")

    def involved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_unit(batches, 2000):
            pick = np.zeros(len(rows), bool)
            for _, a, b, _ in _Units(rows, limits).found():
                pick[a] = pick[b] = True
            yield rows[pick]

    wanted = stored(units.mapInPandas(involved, UNIT), "units")
    picked = stored(wanted.select("node").distinct().join(nodes.select("node", "doc", "t"), "node"), "picked")
    shared = bloom.filter_of(picked, "t")
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("t", F.xxhash64("text")).where(
        bloom.passes(shared, F.col("t")))
    of_node = texts.join(picked, (texts["t"] == picked["t"]) & texts["doc_id"].eqNullSafe(picked["doc"])).select(
        "node", "text").dropDuplicates(["node"])
    full = wanted.join(of_node, "node").repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sketches._Words()
        for rows in _by_unit(batches, 1):
            sets: dict[int, np.ndarray] = {}

            def of(row: int) -> np.ndarray:
                if row not in sets:
                    sets[row] = sketches.shingles(rows["text"].iat[row], words, known)
                return sets[row]

            out = []
            root = list(range(len(rows)))
            for unit, a, b, count in _Units(rows, limits).found():
                for i in np.lexsort((-count, unit)).tolist():
                    x, y = int(a[i]), int(b[i])
                    top = [x, y]
                    for k in (0, 1):
                        while root[top[k]] != top[k]:
                            root[top[k]] = root[root[top[k]]]
                            top[k] = root[top[k]]
                    if top[0] != top[1] and alike(of(x), of(y), percent):
                        root[max(top)] = min(top)
                        out.append((rows["node"].iat[x], rows["node"].iat[y]))
            yield pd.DataFrame(out, columns=["a", "b"])

    columns = [c.split()[0] for c in UNIT.split(", ")]
    return full.select(*columns, "text").mapInPandas(verified, "a binary, b binary")


def alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(other) - common)


def cluster(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text), ``n_shingles``, ``component_id`` and ``kept`` of each document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. A document's set is its distinct runs of ``words`` words (A-Z
    lower-cased, split at white space of ASCII), of fewer words all of them as one run. Documents whose sets have an intersection of ``percent``
    of their union are linked; ``component_id`` is the least id that links lead to, and the document of that id is kept. A
    null or empty text, or one without words, is linked with nothing and kept. Repeated rows are one document, and a document
    without an id is dropped for any with one; where all of a component lack ids, those of one set are kept. An empty table gives no
    rows.
    """
    arrow_batches(docs.sparkSession)
    rows = stored(sketched(docs, words), "sketches")
    some = rows.where("n_shingles > 0")
    first = some.groupBy("node").agg(F.min("doc_id").alias("doc"))
    # Of documents without an id, any will do.
    chosen = some.join(first.withColumnRenamed("node", "_n"), (F.col("node") == F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("doc")))
    nodes = stored(chosen.select("node", "doc", "t", "sketch", "bands").dropDuplicates(["node"]), "nodes")
    found = components(links(docs, nodes, words, percent, miss, block))
    of_node = nodes.select("node", "doc").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = of_node.groupBy("root").agg(F.min("doc").alias("component_id"))
    labels = of_node.join(own_shuffle(lowest, "root"), "root").select("node", "component_id", (F.col("node") == F.col("root")).alias("_root"))
    out = rows.select("doc_id", "t", "n_shingles", "node").join(labels.withColumnRenamed("component_id", "_c"), "node", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_c"))
    chosen = F.when(own.isNull() & F.col("doc_id").isNull(), F.coalesce("_root", F.lit(True))).otherwise(
        F.col("doc_id").eqNullSafe(own))
    return out.select("doc_id", "t", "n_shingles", own.alias("component_id"), chosen.alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the document that ``cluster`` keeps, once. Columns stay as they are."""
    key = lambda text: F.concat_ws(":", F.col("doc_id").cast("string"), text.cast("string"))
    kept = cluster(docs, words, percent).where("kept").select(key(F.col("t")).alias("_key")).distinct()
    keyed = docs.withColumn("_key", key(F.xxhash64(text_or_empty())))
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
