"""Shards from fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and never changes. A map, one row per slot, says which shard holds a slot; a later
version of the map differs from the one before it by edited rows only, and that is all that moves.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.util import stored, text_or_empty

#: A map and everything gathered per slot have this many rows, whatever the input; at 100 TB a slot is some 24 GB.
SLOTS = 4096
MAP = "version int, slot int, shard int"


def slot_of(key: Column, fallback: Column, slots: int) -> Column:
    """A record without a key goes by its fallback, so that such records don't share one slot."""
    return F.pmod(F.when(key.isNull(), F.xxhash64(fallback)).otherwise(F.xxhash64(key)), F.lit(slots)).cast("int")


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1: as many slots for each shard, in runs."""
    return [slot * shards // slots for slot in range(slots)]


def rebalanced(of_slot: list[int], weights: list[int], shards: int) -> list[int]:
    """Move one slot after another from the heaviest to the lightest shard while that brings the two closer."""
    edited, loads = list(of_slot), [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(edited):
        loads[shard] += weights[slot]
        members[shard].add(slot)
    while True:
        heavy, light = max(range(shards), key=loads.__getitem__), min(range(shards), key=loads.__getitem__)
        gap = loads[heavy] - loads[light]
        fits = [s for s in members[heavy] if 0 < weights[s] < gap]
        if not fits:
            return edited
        slot = min(fits, key=lambda s: (abs(gap - 2 * weights[s]), s))
        members[heavy].remove(slot)
        members[light].add(slot)
        edited[slot] = light
        loads[heavy] -= weights[slot]
        loads[light] += weights[slot]


def grown(of_slot: list[int], weights: list[int], shards: int) -> list[int]:
    """The map for one more shard: the heaviest shards hand slots over to it until it has its share; nothing else moves."""
    edited, loads = list(of_slot), [0] * shards
    members: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(edited):
        loads[shard] += weights[slot]
        members[shard].append((weights[slot], slot))
    for own in members:
        own.sort()
    share, got = sum(weights) / (shards + 1), 0
    heap = [(-load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    while heap and got < share:
        load, shard = heapq.heappop(heap)
        while members[shard]:
            weight, slot = members[shard].pop()
            if 0 < weight <= min(share - got, -load - share):
                edited[slot] = shards
                got += weight
                heapq.heappush(heap, (load + weight, shard))
                break
    return edited


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """All versions of a map, written to the shared folder; version n is the n-th list."""
    rows = [(n, slot, shard) for n, one in enumerate(versions, 1) for slot, shard in enumerate(one)]
    return stored(spark.createDataFrame(rows, MAP).coalesce(1), "slot-map")


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Records with their shard and place in it, and the versioned map.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. Size is the text's UTF-8 bytes plus one, of a
    null or empty text 1. A record with a null id is placed by its text. Repeated rows are records of their own, in one
    slot. An empty table gives no records and a map of even runs. Places (``slot`` of the result) run from 0 without a
    gap in each shard: by virtual slot, in it by id, size and checksum.
    Law ``bytes``: version 1 of the map has even runs, version 2 edits them until the shards' bytes are near equal.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    rows = stored(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"),
                              slot_of(F.col("doc_id"), text, slots).alias("virtual_slot")), "measured")
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    weights, counts = [0] * slots, [0] * slots
    for row in sums:
        weights[row["virtual_slot"]], counts[row["virtual_slot"]] = row["size"], row["rows"]
    first = first_map(slots, shards)
    versions = map_table(spark, [first, rebalanced(first, weights, shards)])
    latest = versions.where("version = 2").join(
        spark.createDataFrame(list(enumerate(counts)), "slot int, rows long"), "slot")
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # rows of the map
    starts = latest.select(F.col("slot").alias("virtual_slot"), "shard",
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    placed = rows.withColumn("_row", F.row_number().over(inside) - 1).join(F.broadcast(starts), "virtual_slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("_start") + F.col("_row")).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"), versions
