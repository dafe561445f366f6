"""Repeated byte strings of a corpus, by suffix arrays over the places where a repetition can be.

Every string of ``length`` bytes has an anchor that its own bytes decide: the place of its least k-mer hash. Strings that are
equal have equal anchors, so only what lies around an anchor with two places or more is compared. Places whose whole
surroundings are equal are settled by their hash; for the rest, the surroundings of one anchor meet in one shard, whose suffix
array gives previous and next factors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import bloom
from tradewind.llm.lpf import factors
from tradewind.llm.util import arrow_batches, stored, text_or_empty
from tradewind.operators.keyed import own_shuffle

LENGTH, KMER = 200, 32
#: Surroundings that a shard takes; anchors with more places are divided by a part of what surrounds them.
SHARD = 4096
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                               0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """The least (or greatest) of each run of ``size`` values."""
    have = 1
    while 2 * have <= size:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[:len(values) - (size - have)], values[size - have:]) if size > have else values


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH, kmer: int = KMER) -> tuple:
    """Anchors of concatenated texts: places, hashes, and the first and last start of the strings that each is the anchor of.

    The anchor of a string of ``length`` bytes of one text is its first k-mer (of a power of two bytes) of least hash.
    """
    window, fits = length - kmer + 1, sizes >= length
    if not fits.any():
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    value = data.astype(np.uint64) * _MIX[5] + _MIX[6]
    have, level = 1, 0
    while have < kmer:
        value = (value[:-have] * _MIX[level % 5]) ^ (value[have:] + (value[:-have] >> np.uint64(29)))
        value *= _MIX[(level + 1) % 5]
        have, level = 2 * have, level + 1
    value ^= value >> np.uint64(32)
    value |= np.uint64(1)
    least = _sliding(value, window, np.minimum)  # by first byte of the string; 0 where that isn't in one text
    within = np.zeros(len(data) + 1, np.int32)
    np.add.at(within, starts[fits], 1)
    np.add.at(within, (starts + sizes - length + 1)[fits], -1)
    least[np.cumsum(within)[:len(least)] == 0] = 0
    padded = np.concatenate((np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)))
    at = np.flatnonzero(_sliding(padded, window, np.maximum) == value)
    # Runs of strings of one least hash, dealt to the places that have it: each string to the first in it.
    edge = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((edge[1:], [len(least)])) - 1
    edge, last = edge[least[edge] > 0], last[least[edge] > 0]
    kinds, kind = np.unique(value[at], return_inverse=True)
    order = np.lexsort((at, kind))
    known = kind[order] * (len(data) + 1) + at[order]
    which, first = np.searchsorted(kinds, least[edge]), edge
    out = []
    while len(first):
        place = at[order[np.searchsorted(known, which * (len(data) + 1) + first)]]
        end = np.minimum(last, place)
        out.append((place, first, end))
        left = end < last
        which, first, last = which[left], end[left] + 1, last[left]
    place, first, end = (np.concatenate([x[n] for x in out]) for n in range(3))
    return place, value[place], first, end


def _batch(texts: pd.Series) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    return raw, np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts by hash and byte length; equal texts are one below."""
    text = text_or_empty()
    return docs.select("doc_id", text.alias("text")).withColumns({"t": F.xxhash64("text"), "n": F.octet_length("text")})


def _anchors(texts: DataFrame, length: int, kmer: int) -> DataFrame:
    """Anchors of the texts, with the hash of what surrounds them: all strings they are the anchor of.

    ``at`` holds the position, and how many bytes before it the first and the last of these strings start.
    """
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw, data, starts, sizes = _batch(batch["text"])
            at, value, first, last = anchors(data, starts, sizes, length, kmer)
            row = np.searchsorted(starts, at, side="right") - 1
            pos, lead, tail = at - starts[row], at - first, at - last
            around = [xxhash.xxh64_intdigest(raw[r][p - a:p - b + length], a)
                      for r, p, a, b in zip(row.tolist(), pos.tolist(), lead.tolist(), tail.tolist())]
            yield pd.DataFrame({"anchor": value.view(np.int64), "t": batch["t"].to_numpy()[row],
                                "n": batch["n"].to_numpy()[row], "at": (pos << 24) | (lead << 12) | tail,
                                "around": np.array(around, np.uint64).view(np.int64), "doc": batch["doc_id"].to_numpy()[row]})

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "t", "n").where(F.col("n") >= length).mapInPandas(
        emit, f"anchor long, t long, n int, at long, around long, doc {kind}")


def _part(name: str) -> Column:
    return {"pos": F.shiftright("at", 24), "lead": F.shiftright("at", 12).bitwiseAND(F.lit(4095)),
            "tail": F.col("at").bitwiseAND(F.lit(4095))}[name].cast("int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, shard: int = SHARD) -> DataFrame:
    """Bytes of each distinct text (``t``, ``n``) in strings of ``length`` that start elsewhere too: ``start``, ``end``, ``later``.

    ``later`` tells that all strings of the span start at an earlier place too, by the least ``doc_id`` of their text and position. Whole
    copies of a text don't count as elsewhere here.
    """
    arrow_batches(docs.sparkSession)
    texts = _keyed(docs)
    order, origin = F.struct("doc", "t", "n", "at"), F.xxhash64("t", "n", "at")
    found = stored(_anchors(texts, length, kmer), "anchors")
    repeated = stored(found.groupBy("anchor").agg((F.min(origin) != F.max(origin)).alias("two")).where("two").select("anchor"), "repeated")
    # Anchors that occur once have no part in what follows; the filter lets a few through. A text counts once.
    found = found.where(bloom.passes(bloom.filter_of(repeated, "anchor"), F.col("anchor")))
    places = stored(found.groupBy("anchor", "t", "n", "at", "around").agg(F.min("doc").alias("doc")), "places")
    same = places.groupBy("anchor", "around").agg(F.min(order).alias("_first"), (F.min(origin) != F.max(origin)).alias("two")).where(
        "two").drop("two")
    # An anchor may be that of a third of all places, so both sides of the joins by it are shuffled for the join alone.
    judged = places.join(own_shuffle(same, "anchor"), ["anchor", "around"], "left").select(
        "anchor", "t", "n", "at", "doc", F.col("_first").isNotNull().alias("settled"), (order == F.col("_first")).alias("leads"))
    judged = stored(judged, "judged")
    whole = judged.where("settled").select(
        "t", "n", (_part("pos") - _part("lead")).alias("start"), (_part("pos") - _part("tail") + length).alias("end"),
        (~F.col("leads")).alias("later"))
    # Surroundings that are equal meet the others by one of them.
    edge = judged.where("not settled or leads").drop("leads")
    counts = edge.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    edge = stored(edge.join(own_shuffle(counts, "anchor"), "anchor"), "edges")
    small = _surroundings(texts, edge.where(F.col("c") <= shard), length).repartition("anchor").sortWithinPartitions("anchor")
    small = small.select("t", "n", "doc", "at", "settled", "bytes", F.col("anchor").alias("group"), F.lit(0).alias("low"),
                         F.lit(length).alias("high"))
    spans = whole.unionByName(small.mapInPandas(_shards(length, shard), SPANS))
    big = edge.where(F.col("c") > shard)
    return spans if big.isEmpty() else spans.unionByName(_divided(_surroundings(texts, big, length), length, kmer, shard))


SPANS = "t long, n int, start int, end int, later boolean"


def _surroundings(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Places with the bytes around them. Each text is met once for all its places, and texts without any stay where they are."""
    by_text = stored(places.groupBy("t", "n", "doc").agg(F.collect_list(F.struct("anchor", "at", "settled")).alias("of")), "edges-by-text")

    @F.pandas_udf("array<struct<anchor:long,at:long,settled:boolean,bytes:binary>>")
    def cut(text: pd.Series, of: pd.Series) -> pd.Series:
        out = []
        for one, places in zip(text, of):
            raw = one.encode("utf-8", "surrogatepass")
            own = []
            for p in places:
                pos, lead, tail = p["at"] >> 24, (p["at"] >> 12) & 4095, p["at"] & 4095
                own.append({"anchor": p["anchor"], "at": p["at"], "settled": p["settled"], "bytes": raw[pos - lead:pos - tail + length]})
            out.append(own)
        return pd.Series(out, dtype=object)

    some = texts.where(bloom.passes(bloom.filter_of(by_text, "t"), F.col("t"))).withColumnsRenamed({"t": "_t", "n": "_n"})
    joined = some.join(by_text, (F.col("_t") == F.col("t")) & (F.col("_n") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("doc")))
    return joined.select("t", "n", "doc", F.explode(cut("text", "of")).alias("p")).select("t", "n", "doc", "p.*")


def _divided(parts: DataFrame, length: int, kmer: int, shard: int) -> DataFrame:
    """Spans of anchors with more places than a shard takes.

    ``low`` and ``high`` bound how many bytes before the anchor a string may start. The range is halved until a group fits: places that
    share a string of a range share all bytes that the range's strings have in common, so these divide a group, and the more the
    narrower the range is. Where it is a single string, all of a group are equal.
    """
    order, out = F.struct("doc", "t", "n", "at"), []
    rows = parts.withColumns({"group": F.col("anchor"), "low": F.lit(0), "high": F.lit(length - kmer), "whole": F.lit(False)})
    rows = stored(rows.drop("anchor"), "divided")
    while True:
        counts = rows.groupBy("group", "low").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        sized = stored(rows.join(counts, ["group", "low"]), "divided-sized")
        small = sized.where(F.col("c") <= shard).repartition("group", "low").sortWithinPartitions("group", "low")
        out.append(small.select("t", "n", "doc", "at", "settled", "bytes", "group", "low", "high").mapInPandas(_shards(length, shard), SPANS))
        big = sized.where((F.col("c") > shard)).drop("c")
        if big.isEmpty():
            break
        single = big.where("low = high and whole")
        firsts = single.groupBy("group", "low").agg(F.min(order).alias("_first"))
        start, later = _part("pos") - F.col("low"), order != F.col("_first")
        out.append(single.join(firsts, ["group", "low"]).where(~F.col("settled") | later).select(
            "t", "n", start.alias("start"), (start + length).alias("end"), later.alias("later")))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        half = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
        halves = F.when(F.col("low") == F.col("high"), F.array(half(F.col("low"), F.col("high")))).otherwise(
            F.array(half(F.col("low"), middle), half(middle + 1, F.col("high"))))
        rows = big.where("not (low = high and whole)").withColumn("_h", F.explode(halves)).withColumns(
            {"low": F.col("_h.low"), "high": F.col("_h.high"), "whole": F.lit(True)}).drop("_h")
        rows = rows.where((F.col("low") <= _part("lead")) & (F.col("high") >= _part("tail")))
        common = F.substring("bytes", _part("lead") - F.col("low") + 1, F.lit(length) - (F.col("high") - F.col("low")))
        rows = stored(rows.withColumn("group", F.xxhash64("group", "low", "high", common)), "divided")
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return spans


def _shards(length: int, most: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= most and count:
                whole = pd.concat(held)
                # The last group may go on in the next batch.
                last = (whole["group"].to_numpy() == whole["group"].iloc[-1]) & (whole["low"].to_numpy() == whole["low"].iloc[-1])
                if (~last).any():
                    yield _found(whole[~last], length)
                    held, count = [whole[last]], int(last.sum())
        if held:
            yield _found(pd.concat(held), length)

    return compare


def _found(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of the surroundings of one shard. Strings of different groups may be equal too, which finds nothing untrue."""
    raw, at = list(rows["bytes"]), rows["at"].to_numpy(np.int64)
    pos, lead, tail = at >> 24, (at >> 12) & 4095, at & 4095
    sizes = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.full(int((sizes + 1).sum()), -1, np.int64)
    inside = np.arange(len(text)) - np.repeat(starts, sizes + 1) < np.repeat(sizes, sizes + 1)
    text[inside] = np.frombuffer(b"".join(raw), np.uint8)
    low, high = rows["low"].to_numpy(np.int64), rows["high"].to_numpy(np.int64)
    first, last = lead - np.minimum(high, lead), lead - np.maximum(low, tail)
    many = np.maximum(last - first + 1, 0)
    which = np.repeat(np.arange(len(raw)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[which]
    if not len(which):
        return pd.DataFrame({"t": [], "n": [], "start": [], "end": [], "later": []}).astype(
            {"t": "int64", "n": "int32", "start": "int32", "end": "int32", "later": bool})
    absolute = (pos - lead)[which] + offset
    # Places in the order of documents, texts and positions.
    ranked = rows[["doc", "t", "n"]].groupby(["doc", "t", "n"], dropna=False, sort=True).ngroup().to_numpy()
    origin = np.unique(ranked[which] * (int(absolute.max()) + 1) + absolute, return_inverse=True)[1]
    order, previous, following = factors(text, starts[which] + offset, origin, length)
    back = np.empty(len(text), np.int64)
    back[starts[which] + offset] = np.arange(len(which))
    item = back[order]
    later = previous >= length
    # Of settled ones only that there is an earlier place is news.
    hit = later | (following >= length) & ~rows["settled"].to_numpy(bool)[which[item]]
    item, later = item[hit], later[hit]
    spans = pd.DataFrame({"row": which[item], "start": absolute[item], "later": later}).sort_values(["row", "start"])
    row, start, later = (spans[c].to_numpy() for c in ("row", "start", "later"))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length) | (later[1:] != later[:-1])
    head = np.flatnonzero(new)
    tail_at = np.concatenate((head[1:], [len(row)]))[:len(head)] - 1
    own = row[head]
    return pd.DataFrame({"t": rows["t"].to_numpy()[own], "n": rows["n"].to_numpy(np.int32)[own], "start": start[head].astype(np.int32),
                         "end": (start[tail_at] + length).astype(np.int32), "later": later[head]})


def deduplicate(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, keep_first: bool = True, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary) and ``kept_sha256`` of each document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. Texts are UTF-8 bytes; a null or empty text has none. Bytes in
    strings of ``length`` that start elsewhere too, in any text, are removed; strings are judged on the input. With ``keep_first`` the first
    place of a string stays: that of the least ``doc_id`` (null first), then the least position; of rows with one id and one text
    all stay. Without it every place is removed. ``kept`` may not be valid UTF-8 at its cuts. An empty table gives no rows.
    """
    texts = _keyed(docs)
    spans = repeated_spans(docs, length, kmer, shard)
    if keep_first:
        spans = spans.where("later")
    per_text = spans.groupBy("t", "n").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    copies = texts.groupBy("t", "n").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc"))
    about = copies.where("copies > 1").join(per_text, ["t", "n"], "full_outer")
    about = stored(about.select("t", "n", F.coalesce("copies", F.lit(1)).alias("copies"), "doc", "spans"), "spans")

    @F.pandas_udf("n_removed long, n_spans long, kept binary, kept_sha256 string")
    def cut(text: pd.Series, gone: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for one, whole, own in zip(text, gone, spans):
            raw = one.encode("utf-8", "surrogatepass")
            merged: list[list[int]] = []
            if whole:
                merged = [[0, len(raw)]]
            elif own is not None:
                for start, end in sorted((s["start"], s["end"]) for s in own):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
            edges = [0, *(x for m in merged for x in m), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(raw) - len(kept), len(merged), kept, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept", "kept_sha256"])

    gone = F.coalesce((F.col("copies") > 1) & (F.col("n") >= length), F.lit(False))
    if keep_first:
        gone = gone & ~F.col("doc_id").eqNullSafe(F.col("doc"))
    # Only texts that can lose something go to the join.
    passes = bloom.passes(bloom.filter_of(about, "t"), F.col("t"))
    checked = texts.withColumn("_may", passes)
    joined = checked.where("_may").join(about, ["t", "n"], "left").withColumn("_f", cut("text", gone, "spans"))
    touched = joined.select("doc_id", F.col("n").cast("long").alias("n_bytes"), *[F.col("_f")[c].alias(c) for c in (
        "n_removed", "n_spans", "kept", "kept_sha256")])
    nothing, raw = F.lit(0).cast("long"), F.col("text").cast("binary")
    rest = checked.where("not _may").select("doc_id", F.col("n").cast("long").alias("n_bytes"), nothing.alias("n_removed"),
                                            nothing.alias("n_spans"), raw.alias("kept"), F.sha2(raw, 256).alias("kept_sha256"))
    return touched.unionByName(rest)
