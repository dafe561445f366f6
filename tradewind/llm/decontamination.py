"""Benchmark decontamination: every window of the test items is searched in FM-indexes of the training shards.

A shard is one batch of documents inside a task. Words are numbered by the items' own vocabulary; only runs of such words
that are long enough for a window are indexed, as nothing else can hold one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.fm_index import FMIndex
from tradewind.llm.util import arrow_batches, text_or_empty

WINDOW = 10
#: Bytes of test items that are held in memory at a time; more are searched in blocks, one after the other.
BLOCK_BYTES = 32 << 20
HITS = "n_words long, hits array<struct<first:long,after:long,start:long,end:long>>, items array<string>"

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def windows_of(items: list[tuple[str | None, str]], size: int = WINDOW) -> dict:
    """Distinct windows of test items as rows of word numbers, and the items of each. Plain data, as it is broadcast."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple, set] = {}
    for item, text in items:
        row = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for at in range(max(len(row) - size, 0) + 1 if row else 0):
            owners.setdefault(tuple(row[at:at + size]), set()).add(item)
    phrases = np.zeros((len(owners), size), np.int64)
    for row, window in zip(phrases, owners):
        row[:len(window)] = window
    return {"vocabulary": vocabulary, "phrases": phrases, "lengths": np.array([len(w) for w in owners], np.int64),
            "items": [sorted(x for x in own if x is not None) for own in owners.values()]}


def find(texts: list[str], windows: dict) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """Words, hit spans of words (unmerged) and items with occurring windows, for each text of a shard."""
    get, lengths = windows["vocabulary"].get, windows["lengths"]
    counts, parts = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    found: list[tuple[int, list, set]] = [(n, [], set()) for n in counts]
    if not len(lengths) or not parts:
        return found
    codes = np.concatenate(parts)
    starts = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))[:-1]
    edge = np.diff(np.concatenate(([0], (codes > 0).astype(np.int8), [0])))
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_enough = after - first >= lengths.min()
    first, after = first[long_enough], after[long_enough]
    if not len(first):
        return found
    sizes = after - first + 1  # with the zero that follows
    base = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    kept = np.arange(sizes.sum()) - np.repeat(base, sizes) + np.repeat(first, sizes)
    index = FMIndex(codes[kept], len(windows["vocabulary"]) + 1)
    low, high = index.search(windows["phrases"], lengths)
    many = high - low
    if not many.sum():
        return found
    which = np.repeat(np.arange(len(many)), many)
    rows = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    at = kept[index.locate(rows)]
    doc = np.searchsorted(starts, at, side="right") - 1
    for d, w, window in zip(doc.tolist(), (at - starts[doc]).tolist(), which.tolist()):
        found[d][1].append((w, w + int(lengths[window])))
        found[d][2].update(windows["items"][window])
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order; those that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for first, after in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], after))
        else:
            out.append((first, after))
    return out


def places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Word spans with the code points that they cover."""
    if not spans:
        return []
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(data.translate(_TO_WORDS))]
    length = lambda a, b: len(data[a:b].decode("utf-8", "surrogatepass"))
    out, done, chars = [], 0, 0
    for first, after in spans:
        start = chars + length(done, at[first][0])
        done, chars = at[after - 1][1], start + length(at[first][0], at[after - 1][1])
        out.append((first, after, start, chars))
    return out


def _searching(shared: Broadcast):
    @F.pandas_udf(HITS)
    def search(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, hits, names in batches:
            out = []
            for text, old, had, (n, spans, own) in zip(texts, hits, names, find(list(texts), shared.value)):
                before = [] if old is None else [(h["first"], h["after"]) for h in old]
                spans = places(text, merged(before + spans))
                known = own if had is None else own.union(had)
                out.append((n, [dict(zip(("first", "after", "start", "end"), s)) for s in spans], sorted(known)))
            yield pd.DataFrame(out, columns=["n_words", "hits", "items"])

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``hits``, ``items`` and ``clean_text``.

    ``docs`` needs ``text``, ``benchmark`` needs ``item_id`` and ``text``; other columns of ``docs`` stay, except that one named like a
    column of the result is replaced. ``hits`` are merged spans of words in windows that an item has too (``first``, ``after`` in words;
    ``start``, ``end`` in code points), ``items`` the ids (as strings, in order) of items with an occurring window, and ``clean_text`` is the
    text without the hits. An item of fewer than ``window`` words, but not none, is one window. A null text has no words and stays null;
    a null item has none either; an item without an id is searched but not listed. Repeated rows and items change nothing; empty
    tables are allowed on either side.

    No shuffle: documents stay where they are. Items are searched in blocks of at most about ``BLOCK_BYTES``, so memory doesn't grow
    with the benchmark.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_or_empty().alias("text")).where("text <> ''")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    rows = docs.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.lit(None).cast(
        "array<struct<first:long,after:long,start:long,end:long>>"), "items": F.lit(None).cast("array<string>")})
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(windows_of([(r["item_id"], r["text"]) for r in own], window))

        found = rows.withColumn("_found", _searching(shared)(text_or_empty(), F.col("hits"), F.col("items")))
        rows = found.withColumns({c: F.col("_found")[c] for c in ("n_words", "hits", "items")}).drop("_found")
    return rows.withColumn("clean_text", F.when(F.size("hits") > 0, without(F.col("text"), F.col("hits"))).otherwise(
        F.col("text")))


def without(text: Column, spans: Column) -> Column:
    """A text without sorted spans that don't overlap, given by code points."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(spans, start, lambda s, x: F.struct(
        x["end"].alias("at"), F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).alias("out")))
    return F.concat(cut["out"], F.substring(text, cut["at"] + 1, F.length(text)))
