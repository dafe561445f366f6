"""Streaming jobs: publish purchases, take them into the fact, keep the rollups up to date.

Every sink writes a micro-batch to its own folder with overwrite. A batch that runs again after a failure therefore replaces its own
output, and nothing is lost or doubled. Facts and dead letters are tables of batches (``sources.folded``): every so many batches the older
ones are folded into few files, so that their number doesn't grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.plans import rollup_store
from tradewind.plans.dimension_keys import DimensionKeys
from tradewind.plans.rollups import DIMENSION_OF, from_ledger, ledger
from tradewind.schemas import FACT_SALES
from tradewind.sources import folded
from tradewind.sources.tables import in_storage_order, setting
from tradewind.streaming.messages import accepted, message_key, parse, rejected, to_fact, to_messages

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                        T.StructField("timestamp", T.TimestampType())])
DEAD_LETTER = T.StructType([T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType()),
                            T.StructField("reason", T.StringType()), T.StructField("missing_fields", T.StringType())])


@dataclass(frozen=True)
class Outputs:
    """Where a consumer writes. With ``rollups``, ``dimensions`` gives the dimension tables as they are now, or ``keys`` those of a
    warehouse, of which a micro-batch then reads its own buckets instead of whole columns."""

    facts: str
    dead_letters: str
    rollups: str | None = None
    dimensions: Callable[[], dict[str, DataFrame]] | None = None
    keys: DimensionKeys | None = None

    def met(self, rows: DataFrame) -> dict[str, DataFrame]:
        """Of each dimension the keys that a micro-batch has: the batch's few keys go to the dimension, not the other way."""
        if self.keys:
            return self.keys.met(rows)
        dims = self.dimensions()
        return {table: dims[table].select(key).join(rows.select(key).distinct(), key, "left_semi")
                for key, table in DIMENSION_OF.items()}


TOPIC = "purchases"
# Producer limits (fixed values).
KAFKA_PRODUCER = {"kafka.retries": "3", "kafka.delivery.timeout.ms": "5000", "kafka.request.timeout.ms": "4000",
                  "kafka.linger.ms": "0"}


def kafka_source(servers: str, topic: str = TOPIC, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options}


def kafka_sink(servers: str, topic: str = TOPIC, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **KAFKA_PRODUCER, **options}


def read_messages(spark: SparkSession, fmt: str, location: str | None = None, **options: str) -> DataFrame:
    """A stream of messages: ``kafka``, or a folder of Parquet files standing in for the topic.

    Limit a backlog with ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``, so that a first run does not put the
    whole history into one micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(MESSAGE)
    stream = reader.load(location) if location else reader.load()
    return stream.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE.fields])


def publish(purchases: DataFrame, fmt: str, location: str | None = None, **options: str) -> None:
    """Batch publish of purchases with price and seller (``accepted_purchases``), one JSON message each."""
    writer = _sent(to_messages(purchases), fmt).write.format(fmt).options(**options).mode("append")
    writer.save(location) if location else writer.save()


def _sent(messages: DataFrame, fmt: str) -> DataFrame:
    """A broker stamps messages itself; in files the time is a column."""
    return messages.drop("timestamp") if fmt == "kafka" else messages


def publish_stream(requests: DataFrame, gate: Callable[[DataFrame, int], DataFrame], checkpoint: str, fmt: str,
                   location: str | None = None, after: Callable[[SparkSession, int], None] | None = None,
                   **options: str) -> StreamingQuery:
    """Streaming publish; ``gate`` makes purchases of a micro-batch of requests, and reads sessions, users and products anew
    each time. It gets the batch id too, and must give a batch that runs again the same ids (``streaming.gate.PurchaseGate``).
    ``after`` is called when a batch is sent, with its id: upkeep of the gate's records belongs there.

    Files of a batch are overwritten when it runs again. Kafka has no such place: there a batch that fails half-way
    is sent again, and consumers leave repeats out (``ingest`` with ``repeats``).
    """
    def send(batch: DataFrame, batch_id: int) -> None:
        writer = _sent(to_messages(gate(batch, batch_id)), fmt).write.format(fmt).options(**options)
        if fmt == "kafka":
            writer.save()
        else:
            writer.mode("overwrite").save(f"{location}/batch_id={batch_id}")
        if after:
            after(batch.sparkSession, batch_id)

    return start(requests, send, checkpoint)


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
           continuous: bool = False) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    # Available-now drains what is there and stops; a continuous job polls every second.
    writer = writer.trigger(processingTime="1 second") if continuous else writer.trigger(availableNow=True)
    return writer.start()


#: State of a stream is kept on disk and in memory by RocksDB, as the keys of a day do not fit a heap.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def first_sent(parsed: DataFrame, delay: str = "1 day") -> DataFrame:
    """Parsed messages without those that were sent before: a good one by its sale id, any other by its whole text.

    The stream remembers a message for ``delay`` from its arrival, over restarts too. Time is counted by arrival, not by the time
    in the message, so a message that comes late is never taken for too old and dropped.
    """
    keyed = parsed.withColumn("_key", message_key()).withColumn("_arrived", F.current_timestamp())
    return keyed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def store_batch(batch: DataFrame, batch_id: int, out: Outputs, batch_time: datetime,
                reference_defaults: bool = False) -> None:
    """Write one micro-batch of messages."""
    store_parsed(parse(batch), batch_id, out, batch_time, reference_defaults)


def store_parsed(messages: DataFrame, batch_id: int, out: Outputs, batch_time: datetime,
                 reference_defaults: bool = False) -> None:
    """Write one micro-batch: good messages to the fact and the rollups, the others to the dead letters.

    Dimensions are read here, once per batch: a sale counts in the joined rollups only if its seller, product and
    customer are known when it arrives, and is not looked at again later.
    """
    # All outputs come from one reading of the source; lost cached blocks are computed again from it.
    parsed = messages.persist()
    try:
        rows = to_fact(accepted(parsed), batch_time, reference_defaults)
        folded.write(in_storage_order(rows, "fact_sales"), out.facts, batch_id)
        folded.write(rejected(parsed), out.dead_letters, batch_id)
        if out.rollups:
            totals = ledger(rows, out.met(rows)).persist()
            try:
                rollup_store.write_delta(from_ledger(totals), out.rollups, batch_id)
            finally:
                totals.unpersist()
    finally:
        parsed.unpersist()


def fold_outputs(spark: SparkSession, out: Outputs, before: int) -> None:
    """Fold what batches below ``before`` wrote, after removing what earlier folds replaced."""
    for root, schema, shape in ((out.facts, FACT_SALES, lambda rows: in_storage_order(rows, "fact_sales")),
                                (out.dead_letters, DEAD_LETTER, lambda rows: rows)):
        folded.prune(spark, root)
        folded.fold(spark, root, schema, before - 1, shape=shape)
    if out.rollups:
        rollup_store.compact(spark, out.rollups)
        rollup_store.prune(spark, out.rollups)


def ingest(messages: DataFrame, out: Outputs, checkpoint: str, batch_time: datetime | None = None,
           reference_defaults: bool = False, continuous: bool = False, fold_every: int | None = None,
           repeats: str | None = None) -> StreamingQuery:
    """Messages into the fact, and from there into the rollups.

    With ``fold_every`` outputs are folded after so many batches, all but the newest batch's, which may run again. With ``repeats``, a
    time, messages that were sent before within it are left out (``first_sent``).

    One query feeds all outputs: a second stream reading the fact's files would count a batch twice when it is replaced.
    ``batch_time`` defaults to the time each micro-batch starts.
    """
    parsed = first_sent(parse(messages), repeats) if repeats else parse(messages)

    def each(batch: DataFrame, batch_id: int) -> None:
        store_parsed(batch, batch_id, out, batch_time or datetime.now(timezone.utc), reference_defaults)
        if fold_every and (batch_id + 1) % fold_every == 0:
            fold_outputs(batch.sparkSession, out, batch_id)

    with setting(messages.sparkSession, *STATE_STORE):
        return start(parsed, each, checkpoint, continuous)


def read_facts(spark: SparkSession, location: str) -> DataFrame:
    return folded.read(spark, location, FACT_SALES).select(*FACT_SALES.fieldNames())


def read_dead_letters(spark: SparkSession, location: str) -> DataFrame:
    return folded.read(spark, location, DEAD_LETTER).select(*DEAD_LETTER.fieldNames())
