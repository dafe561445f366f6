"""Loads that enforce constraints: rows that break one go into quarantine, with what they break, and all others into the table.

A load judges its rows in one pass and writes them once, the good and the quarantined together, so that loaded plus quarantined is what
was read, also after a load that stopped and ran again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.keyed import first_by_key, own_shuffle
from tradewind.sources import folded

_JUDGED = [T.StructField("_broken", T.ArrayType(T.StringType())), T.StructField("_good", T.BooleanType())]


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def text_length(column: str, limit: int) -> dict[str, Column]:
    """Null texts are the not-null rule's business."""
    return {f"{column} length <= {limit}": F.coalesce(F.length(column) <= limit, F.lit(True))}


def one_of(column: str, *values: str) -> dict[str, Column]:
    return {f"{column} in {', '.join(values)}": F.coalesce(F.col(column).isin(*values), F.lit(True))}


@dataclass(frozen=True)
class CheckedTable:
    """A table below ``root`` with its constraints.

    ``rules`` are conditions on a row by name; false and null break them. ``references`` gives for a column the table that must have
    its value, in a column of that name; a null refers to nothing. ``unique`` is a column of which the table holds each value once: of
    rows that break nothing else, and whose value no earlier load brought, the one that comes first by ``order`` is kept. ``order``
    must tell any two rows apart. Null values of it are not compared.
    """

    root: str
    schema: T.StructType
    rules: dict[str, Column] = field(default_factory=dict)
    references: dict[str, DataFrame] = field(default_factory=dict)
    unique: str | None = None
    order: tuple[str, ...] = ()

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *_JUDGED])

    def judged(self, rows: DataFrame, taken: DataFrame | None = None) -> DataFrame:
        """Rows with ``_broken``, the names of what they break. ``taken`` has values of the unique column that are there already.

        All rows stay, and the wide side of each join is theirs, so adaptive execution can split a value that very many have.
        """
        names = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in self.rules.items()]
        judged = rows.withColumn("_broken", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))

        def also(frame: DataFrame, broken: Column, name: str) -> DataFrame:
            return frame.withColumn("_broken", F.when(broken, F.array_append("_broken", F.lit(name))).otherwise(F.col("_broken")))

        for column, parent in self.references.items():
            known = parent.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_known", F.lit(True))
            judged = judged.join(own_shuffle(known, column), column, "left")
            judged = also(judged, F.col(column).isNotNull() & F.col("_known").isNull(), f"{column} references").drop("_known")
        if self.unique:
            good = judged.where((F.size("_broken") == 0) & F.col(self.unique).isNotNull())
            first = first_by_key(good.select(self.unique, *self.order), self.unique, *self.order)
            first = first.select(self.unique, F.struct(*self.order).alias("_first"))
            judged = judged.join(own_shuffle(first, self.unique), self.unique, "left")
            repeated = ~F.struct(*self.order).eqNullSafe(F.col("_first"))
            if taken is not None:
                there = taken.select(self.unique).where(F.col(self.unique).isNotNull()).distinct().withColumn("_there", F.lit(True))
                judged = judged.join(own_shuffle(there, self.unique), self.unique, "left")
                repeated = repeated | F.col("_there").isNotNull()
            # Rows that break something else are not compared.
            judged = also(judged, (F.size("_broken") == 0) & F.col(self.unique).isNotNull() & repeated, f"{self.unique} unique")
        return judged.select(*rows.columns, "_broken").withColumn("_good", F.size("_broken") == 0)

    def load(self, rows: DataFrame, load_id: int) -> dict[str, int]:
        """Load rows, in place of what this load wrote before. Returns how many were read, loaded and quarantined, counted by the write."""
        spark, seen = rows.sparkSession, Observation("load")
        given = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        judged = self.judged(given, self.rows(spark, load_id - 1) if self.unique else None)
        counted = judged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if("_good").alias("loaded"))
        folded.write(counted.sortWithinPartitions("_good"), self.root, load_id)
        found = seen.get
        return {**found, "quarantined": found["read"] - found["loaded"]}

    def rows(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The good rows; with ``upto`` those of loads up to it."""
        return folded.read(spark, self.root, self._stored(), upto).where("_good").select(*self.schema.fieldNames())

    def quarantined(self, spark: SparkSession) -> DataFrame:
        """The other rows, with ``broken``, the names of what they break."""
        rows = folded.read(spark, self.root, self._stored()).where("not _good")
        return rows.select(*self.schema.fieldNames(), F.col("_broken").alias("broken"))
