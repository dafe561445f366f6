"""A table written batch by batch, whose older batches are folded together.

    <root>/batch/N/          what batch N wrote; replaced as a whole when the batch runs again
    <root>/folded/A-B-L/     batches A to B in fewer, larger files; L counts how often its rows were folded

A folder counts once its writer has finished it. A reader takes the widest ranges and the batches that none of them holds, so it never
sees a batch twice, whatever a fold or a removal left behind when it stopped half-way. One process writes and folds a table at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources import files

#: So many ranges of one level are folded into one of the next: a row is rewritten as often as there are levels.
FAN = 8

Range = tuple[int, int, int]


def _batch(root: str, batch_id: int) -> str:
    return f"{root}/batch/{batch_id}"


def _range(root: str, part: Range) -> str:
    return f"{root}/folded/{'-'.join(map(str, part))}"


def batches(spark: SparkSession, root: str) -> list[int]:
    """Finished batches that still have their own folder."""
    return sorted(int(n) for n in files.names(spark, f"{root}/batch") if n.isdigit() and files.finished(spark, _batch(root, int(n))))


def _ranges(spark: SparkSession, root: str) -> list[Range]:
    """All finished ranges, the widest first."""
    found = [tuple(map(int, n.split("-"))) for n in files.names(spark, f"{root}/folded") if files.finished(spark, f"{root}/folded/{n}")]
    return sorted(found, key=lambda r: (r[0] - r[1], -r[2]))


def ranges(spark: SparkSession, root: str) -> list[Range]:
    """Ranges that no wider one holds, in the order of their batches."""
    out: list[Range] = []
    for part in _ranges(spark, root):
        if not any(a <= part[0] and part[1] <= b for a, b, _ in out):
            out.append(part)
    return sorted(out)


def _unfolded(spark: SparkSession, root: str, parts: list[Range]) -> list[int]:
    return [b for b in batches(spark, root) if not any(first <= b <= last for first, last, _ in parts)]


def paths(spark: SparkSession, root: str, upto: int | None = None) -> list[str]:
    """The folders that make up the table now; with ``upto`` without batches above it that are in no range."""
    parts = ranges(spark, root)
    own = [b for b in _unfolded(spark, root, parts) if upto is None or b <= upto]
    return [_range(root, p) for p in parts] + [_batch(root, b) for b in own]


def paths_after(spark: SparkSession, root: str, batch_id: int | None) -> list[str]:
    """The folders that hold the batches after one (all, if it is none); a range among them may hold earlier ones too."""
    parts = ranges(spark, root)
    low = -1 if batch_id is None else batch_id
    return ([_range(root, p) for p in parts if p[1] > low]
            + [_batch(root, b) for b in _unfolded(spark, root, parts) if b > low])


def read(spark: SparkSession, root: str, schema: T.StructType, upto: int | None = None, by: str | None = None) -> DataFrame:
    """The table's rows; none before anything is written. ``by`` is the column that its folders are divided by, if they are: a
    filter on it opens only what it asks for."""
    return _read(spark, paths(spark, root, upto), schema, by)


def _read(spark: SparkSession, places: list[str], schema: T.StructType, by: str | None = None) -> DataFrame:
    if not places:
        return spark.createDataFrame([], schema)
    if by is None:
        return spark.read.schema(schema).parquet(*places)
    # Each folder is divided for itself, and one read takes one such root only. There are few: a level's ranges, and new batches.
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in places])


def _writer(rows: DataFrame, by: str | None) -> DataFrameWriter:
    writer = rows.write.mode("overwrite")
    return writer.partitionBy(by) if by else writer


def last(spark: SparkSession, root: str) -> int | None:
    """The newest finished batch."""
    ids = [*batches(spark, root), *(b for _, b, _ in ranges(spark, root))]
    return max(ids, default=None)


def has(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether a batch is finished, in its own folder or in a range."""
    return files.finished(spark, _batch(root, batch_id)) or any(a <= batch_id <= b for a, b, _ in ranges(spark, root))


def read_batch(spark: SparkSession, root: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows that a finished batch wrote, while it has its own folder: it has until the fold after the next."""
    return spark.read.schema(schema).parquet(_batch(root, batch_id))


def write(rows: DataFrame, root: str, batch_id: int, by: str | None = None) -> int:
    """Write a batch, in place of what it wrote before. Returns its number of rows, counted by the write itself."""
    seen = Observation("batch")
    _writer(rows.observe(seen, F.count(F.lit(1)).alias("rows")), by).parquet(_batch(root, batch_id))
    return seen.get["rows"]


def fold(spark: SparkSession, root: str, schema: T.StructType, upto: int | None = None, whole: bool = False,
         shape: Callable[[DataFrame], DataFrame] = lambda rows: rows, by: str | None = None) -> Range | None:
    """Fold the batches up to ``upto`` (all, if none is given) that are in no range, and then ranges of one level where ``FAN`` of them
    have come together; with ``whole`` everything into one range. Returns the last range written. The rows of the table stay the same,
    but for what ``shape`` does to the rows of a range: sort them, or merge rows that readers would merge too.

    A batch that may still run again must be above ``upto``. What is replaced stays for readers that hold it, until ``prune``.
    """
    def written(places: list[str], part: Range) -> Range:
        rows = _read(spark, places, schema, by).select(*schema.fieldNames())
        _writer(shape(rows.hint("rebalance", *([by] if by else []))), by).parquet(_range(root, part))
        return part

    parts, made = ranges(spark, root), None
    new = [b for b in _unfolded(spark, root, parts) if upto is None or b <= upto]
    if whole:
        if new or len(parts) > 1:
            first = min([p[0] for p in parts] + new)
            end = max([p[1] for p in parts] + new)
            places = [_range(root, p) for p in parts] + [_batch(root, b) for b in new]
            made = written(places, (first, end, max([p[2] for p in parts], default=-1) + 1))
        return made
    if new:
        made = written([_batch(root, b) for b in new], (new[0], new[-1], 0))
        parts.append(made)
    while made:
        same = [p for p in parts if p[2] == made[2]]
        if len(same) < FAN:
            break
        made = written([_range(root, p) for p in same], (same[0][0], same[-1][1], made[2] + 1))
        parts = [p for p in parts if p not in same] + [made]
    return made


def prune(spark: SparkSession, root: str) -> list[str]:
    """Remove folders whose batches a wider range holds, and ranges that were never finished.

    Called before a fold, it leaves what that fold replaces to readers until the next one. Stopped half-way, it is finished by
    the next call, as a folder that is partly gone is still held by the range.
    """
    parts, removed = ranges(spark, root), []
    for name in files.names(spark, f"{root}/folded"):
        if tuple(map(int, name.split("-"))) not in parts and files.remove(spark, f"{root}/folded/{name}"):
            removed.append(f"folded/{name}")
    for name in files.names(spark, f"{root}/batch"):
        if any(first <= int(name) <= end for first, end, _ in parts) and files.remove(spark, f"{root}/batch/{name}"):
            removed.append(f"batch/{name}")
    return removed
