"""Plans of near duplicates under skew: a third of the rows on one band or one node, and no side broadcast."""

from contextlib import ExitStack

import pytest
from pyspark.sql import functions as F

from tradewind.llm import near_duplicates, sketches
from tradewind.llm.graph import beside, components
from tradewind.sources.tables import setting

TIGHT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def tight(spark):
    with ExitStack() as stack:
        for key, value in TIGHT.items():
            stack.enter_context(setting(spark, key, value))
        yield spark


def ran(df):
    out = df.groupBy((F.hash(*df.columns) % 5).alias("g")).count()
    out.collect()
    return out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_hot_band_is_split(tight, place):
    """Band 0 is one for a third of the nodes, and pairs of nodes share the others."""
    hot = F.when((F.col("id") % 3 == 0) & (F.col("n") == 0), F.lit(7).cast("long")).otherwise(F.xxhash64((F.col("id") / 2).cast("long"), "n"))
    nodes = tight.range(0, 12_000, 1, 8).select("id", F.explode(F.sequence(F.lit(0), F.lit(sketches.BANDS - 1))).alias("n")).select("id", "n", hot.alias("key"))
    nodes = nodes.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "key"))), lambda x: x["key"]).alias("bands"))
    nodes.select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"), F.lit(b"s").alias("sketch"), "bands").write.parquet(place)
    nodes = tight.read.parquet(place)
    found = near_duplicates.candidates(nodes, 500)
    with setting(tight, "spark.sql.shuffle.partitions", "150"):  # with few, a band is little beside the 27 others
        assert "SortMergeJoin(skew=true)" in ran(found)
    size = found.where("key = 7").agg(F.countDistinct("node"), F.max("two")).first()
    assert size[0] == 4000 and size[1] == 7


def test_a_node_of_many_edges_is_split(tight, place):
    key = lambda c: F.unhex(F.md5(c.cast("string")))
    hub = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1)
    tight.range(0, 60_000, 1, 8).select(key(hub).alias("a"), key(F.col("id") + 10_000).alias("b")).write.parquet(place)
    edges = tight.read.parquet(place)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = beside(edges, least)
    assert "SortMergeJoin(skew=true)" in ran(joined)
    assert joined.count() == 60_000 and joined.where("m > b").count() == 0


def test_components_of_a_hub(tight):
    edges = tight.range(0, 900, 1, 4).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    found = components(edges).collect()
    assert len(found) == 899 and {r.root for r in found} == {0}
