"""Streaming topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from topicstream import storage
from topicstream.options import COMMIT_INTERVAL_SECONDS, DEFAULT_PRODUCER
from topicstream.schema import ARRIVAL_DATE, SHARD_ID
from topicstream.sources.bounded import DEFAULT_COMPRESSION, file_limit, to_write
from topicstream.sources.topics import Topic


def write_topic(
    records: DataFrame,
    topic: Topic,
    *,
    checkpoint: str,
    producer: str = DEFAULT_PRODUCER,
    interval_seconds: float | None = COMMIT_INTERVAL_SECONDS,
    available_now: bool = False,
    compact: bool = True,
    max_records_per_file: int | None = None,
    expire: bool = False,
    compression: str = DEFAULT_COMPRESSION,
    query_name: str | None = None,
) -> StreamingQuery:
    """Write prepared records to a topic and return the running query; ``stop()`` ends it.

    Everything read in a trigger is committed at once, together with the read position: a failed trigger leaves
    nothing visible and is replayed in full by the next run from the same checkpoint. A commit comes every
    ``interval_seconds``, or with ``None`` as soon as the last one is done. ``available_now`` drains what is there and
    stops.

    Files, ``compact``, ``max_records_per_file`` and the checks of the records are as in
    :func:`topicstream.append_topic`: one shuffle keeps a commit from ending in tasks x shards small files, which would
    also lengthen the commit log that sinks and readers keep on the driver.

    A producer and a checkpoint belong together from their first run on: the producer's commit log counts the
    checkpoint's triggers, and Spark would skip those of another one as done already. A mix-up raises.

    ``expire`` takes files older than the topic's lifecycle out of the commit log, which keeps the log of a
    long-lived topic short; readers no longer see them, also those that have yet to read them.
    """
    if not records.isStreaming:
        raise ValueError("write_topic takes a stream; use append_topic for a bounded DataFrame")
    if not checkpoint or not checkpoint.strip():
        raise ValueError("a streaming write needs a checkpoint location")
    spark = records.sparkSession
    checkpoint = checkpoint.strip().rstrip("/")
    _claim(spark, topic, producer, checkpoint)
    records = to_write(records, topic, compact)
    writer = (
        records.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(ARRIVAL_DATE, SHARD_ID)
        .option("path", topic.producer_path(producer))
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", file_limit(topic, max_records_per_file))
        .option("compression", compression)
    )
    if expire:
        writer = writer.option("retention", f"{topic.lifecycle_days}d")
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval_seconds is not None:
        writer = writer.trigger(processingTime=f"{int(interval_seconds * 1000)} milliseconds")
    storage.need_microsecond_timestamps(spark)
    return writer.start()


def _claim(spark: SparkSession, topic: Topic, producer: str, checkpoint: str) -> None:
    """Tie a producer to a checkpoint, or see that it is tied to this one."""
    who = f"producer {producer!r} of topic {topic.name}"
    path = topic.producer_path(producer)
    started = not storage.is_empty(spark, storage.join(checkpoint, "offsets"))
    holder = storage.read_text(spark, topic.claim_path(producer))
    if holder is None:
        if not storage.is_empty(spark, path):
            raise ValueError(f"{who} holds bounded writes; use another one")
        if started:
            raise ValueError(f"checkpoint {checkpoint} belongs to another sink; start {who} from a new one")
        storage.create_text(spark, topic.claim_path(producer), checkpoint)
    elif holder != checkpoint:
        raise ValueError(f"{who} belongs to the stream with checkpoint {holder}")
    elif not started and not storage.is_empty(spark, storage.join(path, "_spark_metadata")):
        raise ValueError(f"checkpoint {checkpoint} of {who} is gone; go on with another producer")
