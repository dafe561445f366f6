"""Cleaning of a text corpus in stages; each stage's rows are written as Parquet and reread by the next.

Stages take (spark, docs, sf_dir) and return the columns of ``docs``, but for the last one. Null and empty texts go with the
first stage, as they have too few words; a stage given such texts, repeated rows, rows without ids or an empty table treats
them as its operator says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, decontamination, near_duplicates, pii, quality
from tradewind.llm.queries import vocabulary_path
from tradewind.llm.util import stored, table


def _set_aside(docs: DataFrame) -> DataFrame:
    """``docs`` under names that no operator uses, beside the text, so that no column of theirs is lost to a clash."""
    return docs.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(docs.columns)], "text")


def _with_text(docs: DataFrame, found: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` set aside in ``found``, with a new text, and its length where they have one."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col(f"_{n}")).alias(c) for n, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the trees keep."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word runs, a similarity of 0.8."""
    return near_duplicates.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that they share with benchmark items."""
    found = decontamination.decontaminate(_set_aside(docs), table(spark, sf_dir, "benchmark"))
    return _with_text(docs, found, F.col("clean_text"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    text = F.when(F.col("text").isNotNull(), pii.redacted(F.col("text"), F.col("spans")))
    return _with_text(docs, pii.find(_set_aside(docs)), text)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text that they stand for."""
    # Whole ids and texts come back, so blocks are smaller than where digests do.
    return bpe.tokenize(docs, vocabulary_path(), chars=2 << 20).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", redact),
          ("bpe", tokenize)]

#: SQL can express neither the trees nor the signatures. Tests hold the stages against plain versions, but for the verdict of quality's trees
#: and the spans that PII's classifier adds: of these they state how many good documents stay and what must be found.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
