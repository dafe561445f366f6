"""Ranked search of all documents for each test item, with equal bags scored once.

A document is its bag: how often it has each term of the items' vocabulary, and a measure ``m`` of its length. Documents with one bag
score alike for every item, so bags are hashed, grouped and compared in full, each class is scored once, and only the classes that
reach an item's list are expanded to their documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.decontamination import words_of
from tradewind.llm.util import arrow_batches, stored, text_or_empty

TOP = 50
#: Items are searched in blocks of so many (item, term) pairs and items at most, so that what is broadcast has a bound. One item alone
#: may have more.
PAIRS, ITEMS = 1 << 20, 20_000
#: Scores, and contributions to scores, that a task holds at a time.
CELLS = 1 << 20
#: Fixed values of the score.
TF, LENGTH, SLOPE = 1_000_000_000, 20, 50


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id`` and ``term``. Rows with one id are one item; items without an id are one too."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sorted(set(words_of(t))) for t in batch.column(1).to_pylist()], pa.list_(pa.binary()))],
                ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", text_or_empty().alias("text")).mapInArrow(terms, f"item_id {kind}, terms array<binary>")
    return found.select("item_id", F.explode("terms").alias("term")).distinct()


def _blocks(pairs: DataFrame, most_pairs: int, most_items: int) -> list[DataFrame]:
    """The pairs dealt by item into blocks within the bounds; only a block of one item may have more pairs."""
    items = stored(pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "search-items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("items")).first()
    parts = max(1, -(-total["n"] // most_pairs), -(-total["items"] // most_items))
    while True:
        own = F.pmod(F.xxhash64("item_id"), F.lit(parts))
        sizes = items.groupBy(own.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
        over = (F.col("items") > most_items) | ((F.col("n") > most_pairs) & (F.col("items") > 1))
        if sizes.where(over).isEmpty():
            return [pairs.where(own == b) for b in range(parts)]
        parts *= 2


def bags(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``doc_id``, the number ``n`` of a document's terms, and the terms of the vocabulary that it has, ascending, with their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                own = Counter(words)
                bag = sorted((number[t], own[t]) for t in own.keys() & number.keys())
                sizes.append(len(words))
                terms.append([t for t, _ in bag])
                counts.append([c for _, c in bag])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        count, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


def scores(terms: np.ndarray, counts: np.ndarray, rows: np.ndarray, m: np.ndarray, weights: dict, items: int) -> np.ndarray:
    """Scores of some bags (a row each) for all items, in 64-bit integers."""
    part = (TF * counts) // (1000 * counts + LENGTH * m[rows])
    first, many = weights["first"][terms], weights["many"][terms]
    total = np.zeros(len(m) * items, np.int64)
    ends = np.cumsum(many)
    at = 0
    while at < len(terms):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")))
        own = many[at:to]
        which = np.repeat(np.arange(at, to), own)
        posting = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own) + first[which]
        np.add.at(total, rows[which] * items + weights["item"][posting], part[which] * weights["w"][posting])
        at = to
    return total.reshape(len(m), items)


def _best(table: pa.Table, top: int) -> pa.Table:
    """The rows of each item with the highest scores, equal ones by the first document; rows without one last."""
    keys = [("item", "ascending"), ("score", "descending"), ("first", "ascending"), ("class", "ascending")]
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_end"))
    item = table["item"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else np.zeros(0, np.int64)
    rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
    return table.take(np.flatnonzero(rank < top))


def score_classes(classes: DataFrame, weights: Broadcast, items: int, top: int) -> DataFrame:
    """For each task the best classes of each item: ``item`` (its number), ``class``, ``first``, ``score``."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = None, np.zeros(items, np.int64)
        for batch in batches:
            # In the order of the first documents, a lower row wins a tie.
            batch = batch.take(pc.sort_indices(batch, sort_keys=[("first", "ascending")], null_placement="at_end"))
            step = max(1, CELLS // items)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                terms, counts = part.column("terms"), part.column("counts")
                rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(terms).to_numpy())
                found = scores(terms.flatten().to_numpy(), counts.flatten().to_numpy(), rows, part.column("m").to_numpy(), weights.value, items)
                row, item = np.nonzero((found > 0) & (found >= least))
                value = found[row, item]
                order = np.lexsort((row, -value, item))
                row, item, value = row[order], item[order], value[order]
                starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else np.zeros(0, np.int64)
                rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
                row, item, value = (x[rank < top] for x in (row, item, value))
                new = pa.table({"item": pa.array(item, pa.int32()), "class": part.column("class").take(pa.array(row)),
                                "first": part.column("first").take(pa.array(row)), "score": pa.array(value, pa.int64())})
                best = _best(new if best is None else pa.concat_tables([best, new]), top)
                own, many = np.unique(best["item"].to_numpy(), return_counts=True)
                last = np.cumsum(many) - 1
                least[own[many == top]] = best["score"].to_numpy()[last[many == top]]
        if best is not None:
            yield from best.combine_chunks().to_batches(max_chunksize=10_000)

    kind = classes.schema["first"].dataType.simpleString()
    return classes.select("class", "first", "m", "terms", "counts").mapInArrow(score, f"item int, class long, first {kind}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, most_pairs: int = PAIRS, most_items: int = ITEMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``top`` best documents with a score above 0.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns, whatever their names, are left out. Terms
    are runs of ASCII letters and digits and of any other characters beyond ASCII, A-Z lower-cased. Equal scores rank by ascending
    ``doc_id``, documents without one last. Rows of ``docs`` are documents of their own, also with one id; rows of ``items`` with one
    id (or none) are one item with all their terms. Null and empty texts have no terms: as documents they count nowhere, as items
    they find nothing. Texts of any length are read whole. Without items or documents with terms there are no rows.

    A class is found by a 64-bit hash of its bag, and told from others of that hash by the bag itself, wherever classes are grouped or
    joined. Each task keeps the best classes of each item only, and a class of any size gives its first ``top`` documents.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    pairs = stored(item_terms(items), "search-terms")
    found = [_search(docs, part, top) for part in _blocks(pairs, most_pairs, most_items)]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _search(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """The same for one block of items."""
    spark = docs.sparkSession
    given = pairs.toArrow().combine_chunks()
    term = given["term"].combine_chunks().dictionary_encode() if len(given) else pa.array([], pa.binary()).dictionary_encode()
    terms, numbers = term.dictionary.to_pylist(), term.indices.to_numpy()
    # Items are numbered by their ids; a null one gets a number as well.
    ids = given.select(["item_id"]).group_by(["item_id"]).aggregate([])["item_id"].combine_chunks()
    item = pc.index_in(given["item_id"], value_set=ids).to_numpy().astype(np.int64)
    vocabulary = spark.sparkContext.broadcast({t: n for n, t in enumerate(terms)})
    bag = stored(bags(docs, vocabulary), "search-bags")
    vocabulary.destroy()
    total = bag.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    having = bag.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[having["t"].to_numpy()] = having["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)
    order = np.argsort(numbers, kind="stable")
    many = np.bincount(numbers, minlength=len(terms)).astype(np.int64)
    weights = spark.sparkContext.broadcast({"first": np.cumsum(many) - many, "many": many, "item": item[order], "w": weight[numbers[order]]})

    m = F.lit(100 - SLOPE) + F.expr(f"({SLOPE} * n * {total['docs']}L) div {max(total['terms'], 1)}L")
    keyed = bag.where(F.size("terms") > 0).withColumn("m", m).withColumn("h", F.xxhash64("m", "terms", "counts"))
    bag_of = ["h", "m", "terms", "counts"]
    classes = stored(keyed.groupBy(*bag_of).agg(F.min("doc_id").alias("first")).withColumn("class", F.monotonically_increasing_id()),
                     "search-classes")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "class")
    best = score_classes(classes, weights, len(ids), top).withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= top)
    best = stored(best.select("item", "class", "score"), "search-best")
    weights.destroy()

    wanted = classes.join(best.select("class").distinct(), "class", "left_semi").drop("first")
    members = keyed.select("doc_id", *bag_of).join(wanted, bag_of).select("class", "doc_id")
    in_class = Window.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"))
    members = members.withColumn("r", F.row_number().over(in_class)).where(F.col("r") <= top).drop("r")
    names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(ids)), pa.int32()), "item_id": ids}),
                                  f"item int, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    in_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.join(members, "class").withColumn("rank", F.row_number().over(in_item)).where(F.col("rank") <= top)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
