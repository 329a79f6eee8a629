"""Unbounded topic scan."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from topicstream import storage
from topicstream.options import COMMIT_INTERVAL_SECONDS
from topicstream.schema import ARRIVAL_DATE, SHARD_ID
from topicstream.sources.bounded import of_shards, wanted_shards
from topicstream.sources.topics import Topic

# Spark ignores files this much older than the newest one it has seen, by default a week. No file of a topic is too old:
# one may arrive with the time of the place it was copied from.
_MAX_FILE_AGE = "36500d"
# How many of a producer's files, of how many of its days, are looked at for the size of a record.
_MEASURED_FILES = 32
_MEASURED_DAYS = 8
_BYTES_PER_COLUMN = 16


def read_topic(
    spark: SparkSession,
    topic: Topic,
    *,
    shards: Iterable[str] | None = None,
    rate: int | None = None,
    interval_seconds: float = COMMIT_INTERVAL_SECONDS,
    slots: int | None = None,
) -> DataFrame:
    """A topic's records as a stream, with ``system_time`` as the record's own clock.

    The position lives in the checkpoint of the query that writes the result: give it
    ``topic.subscription_path(name)`` and a later run goes on where the last one stopped. No watermark is set;
    add ``withWatermark("system_time", ...)`` where one is wanted.

    ``rate`` is in records per second for each task slot (by default there is no limit), for triggers
    ``interval_seconds`` apart. Spark admits whole files, so the rate becomes bytes, by the size of a record in the
    topic's files when the query starts: many small files are read at once as well as a few large ones. What a trigger
    may read is shared among the producers by the bytes they hold, and each of them may read one file in any case. A
    drain with ``availableNow`` keeps to the limit in each trigger, but does not wait between them. ``slots`` is how
    many task slots to reckon with, by default those the session has now; set it where executors come and go.
    """
    limits: dict[str, int] = {}
    wanted = None if shards is None else wanted_shards(topic, shards)
    if rate is not None:
        limits = bytes_per_trigger(spark, topic, records_per_trigger(spark, rate, interval_seconds, slots))
    parts = []
    # The order of the union is the order in the descriptor, which checkpoints rely on.
    for producer in topic.producers:
        reader = spark.readStream.schema(topic.record_schema).option("maxFileAge", _MAX_FILE_AGE)
        if limits:
            reader = reader.option("maxBytesPerTrigger", limits[producer])
        path = topic.producer_path(producer)
        # Only folders of the wanted shards are listed, admitted and remembered. A streamed producer's files are known from
        # its commit log, which is of all shards.
        if wanted and not storage.exists(spark, topic.claim_path(producer)):
            reader = reader.option("basePath", path)
            path = storage.join(path, f"{ARRIVAL_DATE}=*", f"{SHARD_ID}={{{','.join(wanted)}}}")
        parts.append(reader.parquet(path))
    return of_shards(reduce(DataFrame.unionByName, parts), topic, shards)


def records_per_trigger(spark: SparkSession, rate: int, interval_seconds: float, slots: int | None = None) -> int:
    """The most records one trigger may read."""
    return int(rate * (slots or spark.sparkContext.defaultParallelism) * interval_seconds)


def bytes_per_trigger(spark: SparkSession, topic: Topic, records: int) -> dict[str, int]:
    """By producer, the bytes that ``records`` records take in a trigger, shared by the bytes the producers hold."""
    sizes, measured_bytes, measured_records = {}, 0, 0
    for producer in topic.producers:
        path = topic.producer_path(producer)
        sizes[producer] = storage.bytes_below(spark, path)
        days = [name for name in storage.list_names(spark, path) if name.startswith(f"{ARRIVAL_DATE}=")]
        days = days[:: max(1, len(days) // _MEASURED_DAYS)][:_MEASURED_DAYS]
        sample = [
            file
            for day in days
            for file in storage.first_files(spark, storage.join(path, day), _MEASURED_FILES // _MEASURED_DAYS, ".parquet")
        ]
        if sample:
            measured_bytes += storage.size_in_bytes(spark, sample)
            measured_records += spark.read.parquet(*sample).count()  # from the footers
    # A topic without records gives no measure; a guess by its columns stands in until the next start.
    of_record = measured_bytes / measured_records if measured_records else _BYTES_PER_COLUMN * len(topic.record_schema)
    total = sum(sizes.values())
    return {
        producer: max(1, int(records * of_record * (size / total if total else 1 / len(sizes))))
        for producer, size in sizes.items()
    }


def shortest_interval(spark: SparkSession, topic: Topic, rate: int, slots: int | None = None) -> int:
    """The fewest whole seconds in which the rate lets a trigger read a full file."""
    return math.ceil(topic.max_records_per_file / records_per_trigger(spark, rate, 1, slots))
