"""Texts encoded through a table of their distinct words.

Texts are packed into blocks as they lie in their partition. A block holds its distinct words, dealt by hash into buckets, and for
each text the places of its words among them. Only distinct words move: a bucket of the word table gets its words from all blocks,
encodes each once, and the ids go back to the blocks, where they are joined to the texts by position. Ids are turned into text by a
join of each block's distinct ids with the vocabulary.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.util import arrow_batches, text_or_empty
from tradewind.session import work_dir

#: A block is closed when its texts have this many characters; a longer text is a block of its own.
BLOCK_CHARS = 32 << 20
#: Words of a block whose ids are put together at a time.
SLICE = 1 << 18
#: Bytes of input for each bucket of the word table, and the least and the most buckets.
BUCKET_BYTES, BUCKETS = 8 << 20, (64, 16384)
#: Words that a task remembers at a time. Beyond, it begins anew, and a word that comes back is encoded again.
REMEMBERED = 1 << 20
#: Words that are encoded at a time.
ENCODED = 1 << 13

_BLOCK = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("key", pa.binary()), ("texts", pa.binary())])
_IDS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary())])


@dataclass(frozen=True)
class Codec:
    """How a tokenizer splits, encodes and decodes. The functions make, inside a task, what does the work."""

    #: A function from a text to words, whose ids in sequence are the text's ids.
    splitter: Callable[[], Callable[[str], list[str]]]
    #: A function from distinct words to the ids of each.
    encoder: Callable[[], Callable[[list[str]], list[list[int]]]]
    #: Ids with the bytes that they stand for: of the vocabulary's size, whatever the texts.
    pieces: list[tuple[int, bytes]]
    #: From the joined bytes of a text's ids to the text.
    text: Callable[[bytes], str]


@dataclass(frozen=True)
class Result:
    """What comes out beside ``doc_id``: columns as Spark's DDL, made from a block's texts.

    ``make`` gets where the ids of each text end and begin (one more offset than texts), all ids, and the decoded texts.
    """

    columns: str
    make: Callable[[np.ndarray, np.ndarray, list[str]], list[pa.Array]]


def whole() -> Result:
    def make(ends: np.ndarray, ids: np.ndarray, texts: list[str]) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))), pa.array(texts, pa.string())]

    return Result("ids array<int>, decoded string", make)


def packed(*arrays: np.ndarray) -> bytes:
    """Integer arrays in one compressed string. Bytes of equal weight lie together, which suits small numbers."""
    flat = np.concatenate([np.array([len(arrays), *map(len, arrays)]), *arrays]).astype("<u4")
    return zstandard.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel()
    sizes = flat[1:1 + int(flat[0])].astype(np.int64)
    return np.split(flat[1 + len(sizes):], np.cumsum(sizes)[:-1])


def packed_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.compress(len(words).to_bytes(4, "little") + sizes + b"".join(words), 3)


def unpacked_words(data: bytes) -> list[str]:
    data = zstandard.decompress(data)
    many = int.from_bytes(data[:4], "little")
    ends = (4 + 4 * many + np.cumsum(np.frombuffer(data, "<u4", many, 4))).tolist()
    return [data[a:b].decode() for a, b in zip([4 + 4 * many, *ends], ends)]


class _Block:
    def __init__(self):
        self.seen: dict[str, int] = defaultdict(count().__next__)
        self.keys: list[pa.Array] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, key: pa.Array, words: list[str], size: int) -> None:
        self.places.append(np.fromiter(map(self.seen.__getitem__, words), np.int32, len(words)))
        self.keys.append(key)
        self.size += size

    def rows(self, name: int, buckets: int) -> pa.RecordBatch:
        """A row of words for each bucket, and one of bucket -1 with the texts.

        Words count in the order of bucket and use. In texts they are numbered by use, the most used first, which packs well.
        """
        words = [w.encode() for w in self.seen]
        flat = np.concatenate(self.places)
        used = np.bincount(flat, minlength=len(words))
        bucket = np.array([xxhash.xxh64_intdigest(w) % buckets for w in words], np.int32)
        order = np.lexsort((-used, bucket))
        filled, starts = np.unique(bucket[order], return_index=True)
        rows = [(name, b, packed_words([words[i] for i in order[a:z]]), None, None)
                for b, a, z in zip(filled.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)])]
        by_use = np.argsort(-used, kind="stable")
        number, place = np.empty(len(words), np.int32), np.empty(len(words), np.int32)
        number[by_use] = np.arange(len(words))
        place[order] = np.arange(len(words))
        key, sink = pa.concat_arrays(self.keys), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("key", key.type)])) as out:
            out.write_batch(pa.record_batch([key], ["key"]))
        sizes = np.array([len(p) for p in self.places], np.int64)
        rows.append((name, -1, None, sink.getvalue().to_pybytes(), packed(place[by_use], sizes, number[flat])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)


def buckets_for(docs: DataFrame) -> int:
    """Buckets of the word table, by the size that the optimizer knows of the input (files' sizes for a scan)."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least, most = BUCKETS
    return min(max(size // BUCKET_BYTES, least), most)


def blocks(docs: DataFrame, splitter: Callable, chars: int, buckets: int) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) packed; document ids are kept as Arrow data of their own type."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, name, block = splitter(), TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row in range(batch.num_rows):
                text = texts[row].as_py()
                if block.keys and block.size + len(text) > chars:
                    yield block.rows(name, buckets)
                    name, block = name + 1, _Block()
                block.add(ids.slice(row, 1), split(text), len(text))
        if block.keys:
            yield block.rows(name, buckets)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(pack, "block long, bucket int, words binary, key binary, texts binary")


def encoded(words: DataFrame, encoder: Callable) -> DataFrame:
    """Rows of ``block``, ``bucket``, ``words`` with the ids of the words, dealt by block. Rows of a bucket are encoded one after the
    other; a word that an earlier one had isn't encoded again."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bucket = encoder(), None
        known: dict[str, bytes] = {}  # ids as they are sent: a list of numbers takes several times the memory
        for batch in batches:
            rows = []
            for name, own, data in zip(*(c.to_pylist() for c in batch.columns)):
                if own != bucket or len(known) > REMEMBERED:
                    bucket, known = own, {}
                words = unpacked_words(data)
                new = [w for w in words if w not in known]
                for at in range(0, len(new), ENCODED):
                    some = new[at:at + ENCODED]
                    known.update((w, np.array(i, "<u4").tobytes()) for w, i in zip(some, ids_of(some)))
                ids = [known[w] for w in words]
                rows.append((name, own, packed(np.array([len(i) // 4 for i in ids], np.int64), np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _IDS)], schema=_IDS)

    placed = words.repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(encode, "block long, bucket int, ids binary").repartition("block")


def pieces_of(ids: DataFrame, vocabulary: list[tuple[int, bytes]]) -> DataFrame:
    """The id-to-piece join: for each block the pieces of its distinct ids. The vocabulary has a fixed size, so it may be broadcast."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All columns are taken in, so that these rows and the texts' ones come out of one shuffle.
        for batch in batches:
            used = [np.unique(unpacked(x)[1]).astype(np.int32) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(used, pa.list_(pa.int32()))], ["block", "used"])

    pieces = F.broadcast(ids.sparkSession.createDataFrame(vocabulary, "id int, piece binary"))
    used = ids.mapInArrow(distinct, "block long, used array<int>").select("block", F.explode("used").alias("id"))
    used = used.groupBy("block").agg(F.collect_set("id").alias("used"))
    each = used.select("block", F.explode("used").alias("id")).join(pieces, "id")
    return each.groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("vocabulary"))


def tokenize(docs: DataFrame, codec: Codec, result: Result | None = None, chars: int = BLOCK_CHARS, buckets: int | None = None) -> DataFrame:
    """``doc_id`` and the columns of ``result`` (``ids`` and ``decoded``) for each row of ``docs`` (``doc_id``, ``text``).

    A word goes to the table once for each block that has it, so the most frequent one costs as many rows as there are blocks. No
    task holds more than a block with its words, or ``REMEMBERED`` words of a bucket. Blocks are written bucketed by block, so
    that afterwards only words and ids move.
    """
    result = result or whole()
    arrow_batches(docs.sparkSession)
    packed_blocks = _bucketed(blocks(docs, codec.splitter, chars, buckets or buckets_for(docs)), "block")
    ids = encoded(packed_blocks.where("bucket >= 0").select("block", "bucket", "words"), codec.encoder)
    texts = packed_blocks.where("bucket = -1").select("block", "key", "texts").join(pieces_of(ids, codec.pieces), "block", "left")
    to_text, make = codec.text, result.make

    def unpack(own: pa.Table, found: pa.Table) -> pa.Table:
        parts = [unpacked(x) for _, x in sorted(zip(found["bucket"].to_pylist(), found["ids"].to_pylist()))]
        none = np.zeros(0, np.int64)
        sizes = np.concatenate([none, *(p[0] for p in parts)]).astype(np.int64)
        ids = np.concatenate([none, *(p[1] for p in parts)]).astype("<u4")
        ends = np.cumsum(sizes)
        (key,), (data,), (vocabulary,) = (own[c].to_pylist() for c in ("key", "texts", "vocabulary"))
        piece = {p["id"]: p["piece"] for p in vocabulary or ()}
        pieces = [piece.get(i, b"") for i in ids.tolist()]
        bytes_of = [b"".join(pieces[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        place, lengths, numbers = unpacked(data)
        keys = pa.ipc.open_stream(key).read_all().column(0)
        bounds = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        out, at = [], 0
        while at < len(lengths):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
            words = place[numbers[bounds[at]:bounds[to]]].astype(np.int64) if len(numbers) else none
            many = sizes[words]
            start = np.repeat(ends[words] - np.cumsum(many), many)
            tokens = ids[start + np.arange(len(start))]
            own = bounds[at:to + 1] - bounds[at]
            texts = [to_text(b"".join([bytes_of[w] for w in words[a:b].tolist()])) for a, b in zip(own[:-1].tolist(), own[1:].tolist())]
            columns = [keys.slice(at, to - at), *make(np.concatenate(([0], np.cumsum(many)))[own], tokens, texts)]
            out.append(pa.Table.from_arrays(columns, [f"c{n}" for n in range(len(columns))]))
            at = to
        return pa.concat_tables(out)

    columns = result.columns.split(", ")
    schema = ", ".join([f"c0 {docs.schema['doc_id'].dataType.simpleString()}", *(f"c{n} {c.split(' ')[1]}" for n, c in enumerate(columns, 1))])
    found = texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(unpack, schema)
    return found.toDF("doc_id", *(c.split(" ")[0] for c in columns))


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    """The rows in files of the shared folder, bucketed by a column, so that a join on it doesn't move them.

    Spark writes buckets for a table only. The table's entry is dropped once its files are known; they stay.
    """
    spark = rows.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(parts, key).option("path", work_dir(spark, "blocks")).format("parquet").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found
