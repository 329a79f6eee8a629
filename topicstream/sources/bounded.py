"""Bounded reads and writes of a topic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from topicstream import storage
from topicstream.functions.codec import quoted
from topicstream.options import DEFAULT_PRODUCER
from topicstream.operators.retention import utc_date
from topicstream.schema import ARRIVAL_DATE, EVENT_TIME, SHARD_ID
from topicstream.sources.topics import Topic, list_shards

DEFAULT_COMPRESSION = "zstd"


def read_topic_batch(spark: SparkSession, topic: Topic, shards: Iterable[str] | None = None) -> DataFrame:
    """The records a topic holds now, of all shards or of the given ones.

    Filters on ``shard_id`` prune folders, other filters and the column list reach the Parquet scan. Each producer
    is read through its own folder, so files that a failed streaming write left behind are not seen.
    """
    parts = [
        spark.read.schema(topic.record_schema).parquet(topic.producer_path(producer))
        for producer in topic.producers
    ]
    return of_shards(reduce(DataFrame.unionByName, parts), topic, shards)


def append_topic(
    records: DataFrame,
    topic: Topic,
    *,
    producer: str = DEFAULT_PRODUCER,
    compact: bool = True,
    max_records_per_file: int | None = None,
    compression: str = DEFAULT_COMPRESSION,
    write_id: str | None = None,
) -> None:
    """Append prepared records (see :func:`topicstream.prepare_records`) in one bounded write.

    One shuffle brings the rows of a shard together into evenly sized files; adaptive execution, which it needs, splits
    hot shards and joins small ones. With ``compact=False`` rows are written where they are and each task makes a
    file for each shard it holds, tasks x shards in all. Files are split at ``max_records_per_file``, by default the
    topic's.

    Records that do not have exactly the topic's columns and types raise before anything is written, and a shard that
    is not the topic's fails the write. The producer's folder must not belong to a streaming writer, whose readers
    would not see these files.

    A job that does not know whether an earlier try of its write came through gives both the same ``write_id``: the
    records are there once, however often and wherever the tries were cut off. They are written aside first; a marker
    then says that they are whole, and from there on any try only goes on moving the files to their places, under names that
    follow from the id. What later tries hold is not looked at once the marker is there. Two tries must not run at a time.
    """
    path = topic.producer_path(producer)
    if storage.exists(records.sparkSession, topic.claim_path(producer)):
        raise ValueError(f"producer {producer!r} of topic {topic.name} is written by a stream; use another one")
    records = to_write(records, topic, compact)
    storage.need_microsecond_timestamps(records.sparkSession)
    writer = (
        records.write.option("maxRecordsPerFile", file_limit(topic, max_records_per_file))
        .option("compression", compression)
        .partitionBy(ARRIVAL_DATE, SHARD_ID)
    )
    if write_id is None:
        writer.mode("append").parquet(path)
    else:
        _write_once(records.sparkSession, writer, topic, producer, write_id)


def _write_once(spark: SparkSession, writer: DataFrameWriter, topic: Topic, producer: str, write_id: str) -> None:
    if not write_id.strip() or write_id[0] in "_." or set(write_id) & set("/="):
        raise ValueError(f"not usable as the id of a write: {write_id!r}")
    aside = storage.join(topic.path, "writes", producer, write_id)
    staged, whole, done = (storage.join(aside, name) for name in ("staged", "whole", "done"))
    if storage.exists(spark, done):
        return
    if not storage.exists(spark, whole):
        writer.mode("overwrite").parquet(staged)
        storage.create_text(spark, whole, write_id)
    target = topic.producer_path(producer)
    for file in storage.list_files(spark, staged):
        folder, _, name = file.rpartition("/")
        if not name.startswith(("_", ".")):
            # A file that a try moved is no longer there for the next one.
            storage.move(spark, storage.join(staged, file), storage.join(target, folder, f"{write_id}-{name}"))
    storage.create_text(spark, done, write_id)
    storage.delete(spark, staged)


def drop_expired(spark: SparkSession, topic: Topic, as_of: dt.datetime) -> list[str]:
    """Delete the days that ended before the topic's lifecycle up to ``as_of`` began, and return their folders.

    Only of producers that bounded jobs write: a stream's commit log names its files, so it drops them from there
    (``expire=`` of :func:`topicstream.write_topic`), and :func:`vacuum_topic` deletes what it dropped. No job may write or
    read those days meanwhile.
    """
    first_kept = utc_date(as_of) - dt.timedelta(days=topic.lifecycle_days)
    dropped = []
    for producer in topic.producers:
        if storage.exists(spark, topic.claim_path(producer)):
            continue
        for name in storage.list_names(spark, topic.producer_path(producer)):
            level, _, day = name.partition("=")
            if level == ARRIVAL_DATE and day[:1].isdigit() and dt.date.fromisoformat(day) < first_kept:
                dropped.append(storage.join(topic.producer_path(producer), name))
                storage.delete(spark, dropped[-1])
    return dropped


def to_write(records: DataFrame, topic: Topic, compact: bool) -> DataFrame:
    """Records as they are written: checked against the topic, and with ``compact`` the rows of a shard together."""
    need_event_time(topic)
    if compact and records.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("evenly sized files need spark.sql.adaptive.enabled; turn it on or set compact=False")
    wanted = {f.name: f.dataType.simpleString() for f in topic.record_schema}
    given = {f.name: f.dataType.simpleString() for f in records.schema}
    if given != wanted or len(records.columns) != len(wanted):
        wrong = sorted(f"{n} {given.get(n, 'missing')}" for n in {*given, *wanted} if given.get(n) != wanted.get(n))
        raise ValueError(f"not records of topic {topic.name}: {wrong}, it has {wanted}")
    shard = F.col(SHARD_ID)
    strange = F.raise_error(F.concat(F.lit(f"not a shard of topic {topic.name}: "), F.coalesce(shard, F.lit("null"))))
    checked = F.when(shard.isin(list_shards(topic)), shard).otherwise(strange.cast("string"))
    columns = [checked.alias(n) if n == SHARD_ID else F.col(quoted(n)) for n in topic.record_schema.fieldNames()]
    records = records.select(*columns)
    return records.hint("rebalance", ARRIVAL_DATE, SHARD_ID) if compact else records


def need_event_time(topic: Topic) -> None:
    """Raise for a topic that records cannot be written to, as it has no column for their own clock."""
    if EVENT_TIME not in topic.schema.fieldNames():
        raise ValueError(f"topic {topic.name} has no {EVENT_TIME} column")


def file_limit(topic: Topic, max_records_per_file: int | None) -> int:
    if max_records_per_file is None:
        return topic.max_records_per_file
    if max_records_per_file < 1:
        raise ValueError(f"max_records_per_file must be positive, got {max_records_per_file}")
    return max_records_per_file


def of_shards(df: DataFrame, topic: Topic, shards: Iterable[str] | None) -> DataFrame:
    return df if shards is None else df.where(F.col(SHARD_ID).isin(wanted_shards(topic, shards)))


def wanted_shards(topic: Topic, shards: Iterable[str]) -> list[str]:
    """The given shards as text; one that the topic does not have raises."""
    wanted = [str(s) for s in shards]
    unknown = sorted(set(wanted) - set(list_shards(topic)))
    if unknown:
        raise ValueError(f"topic {topic.name} has no shards {unknown}")
    return wanted
