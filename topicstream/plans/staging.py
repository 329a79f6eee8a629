"""The given ``events`` table as a topic, for the registered queries that read one."""

from __future__ import annotations

import uuid
from typing import Annotated

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream import storage
from topicstream.functions.codec import biz_key_attributes, decode_json, event_time_from_millis
from topicstream.operators.metrics import Totals
from topicstream.operators.routing import key_hash_selector
from topicstream.options import (
    DEFAULT_PROJECT,
    ROOT,
    SINK_PROJECT,
    SINK_TOPIC,
    SOURCE_SUBSCRIPTION,
    SOURCE_TOPIC,
)
from topicstream.plans.transfer import Transfer, start_transfer
from topicstream.schema import BIGINT, DOUBLE, STRING, SYSTEM_TIME, Field, topic, topic_def
from topicstream.sources.bounded import append_topic
from topicstream.sources.records import prepare_records
from topicstream.sources.topics import Topic, create_topic

PROJECT = "sample"
SHARDS = 4


@topic(name="events_in", shard_num=SHARDS, comment="incoming events")
class EventIn:
    seq: Annotated[int, Field("seq", BIGINT, "arrival order")]
    name: Annotated[str, Field("name", STRING, "routing key")]
    age: Annotated[int, Field("age", BIGINT)]
    money: Annotated[float, Field("money", DOUBLE)]
    createTime: Annotated[str, Field("create_time", STRING, "epoch ms as text")]
    payload: Annotated[str, Field("payload", STRING, "JSON")]


@topic(name="events_out", shard_num=SHARDS, comment="checked events")
class EventOut:
    seq: Annotated[int, Field("seq", BIGINT, "arrival order")]
    name: Annotated[str, Field("name", STRING, "routing key")]
    age: Annotated[int, Field("age", BIGINT)]
    money: Annotated[float, Field("money", DOUBLE)]
    createTime: Annotated[int, Field("create_time", BIGINT, "epoch ms")]
    k: Annotated[int, Field("k", BIGINT)]


EVENT_IN = topic_def(EventIn)
EVENT_OUT = topic_def(EventOut)
BY_NAME = key_hash_selector("name")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_utc(zoneless: Column) -> Column:
    """The instant of a zone-less timestamp of the tables, which are meant as UTC, whatever the session's zone is."""
    minutes = F.unix_date(zoneless.cast("date")).cast("bigint") * 1440 + F.hour(zoneless) * 60 + F.minute(zoneless)
    seconds = F.extract(F.lit("SECOND"), zoneless)
    return F.timestamp_micros(minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed rows of ``EVENT_IN`` plus their arrival time and type."""
    arrival = in_utc(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("name"),
        F.col("user_id").alias("age"),
        F.col("value").alias("money"),
        F.unix_millis(arrival).cast("string").alias("createTime"),
        F.col("props").alias("payload"),
        F.col("event_type"),
        arrival.alias(SYSTEM_TIME),
    )


def input_records(rows: DataFrame, target: Topic) -> DataFrame:
    return prepare_records(
        rows,
        target,
        BY_NAME,
        definition=EVENT_IN,
        attributes=biz_key_attributes(F.col("name")),
        event_time=event_time_from_millis(F.col("createTime").cast("bigint")),
        system_time=F.col(SYSTEM_TIME),
        carry=("event_type", SYSTEM_TIME),
    )


def new_input_topic(spark: SparkSession, **settings) -> Topic:
    return create_topic(spark, storage.scratch_dir(spark, "topics"), PROJECT, EVENT_IN, **settings)


_staged: dict[tuple, Topic] = {}


def staged_events(spark: SparkSession, sf_dir: str) -> Topic:
    """All of ``events`` in a topic of two producers, written once per application for the table's files as they are now,
    and shared by the queries."""
    files = sorted(storage.file_times(spark, f"{sf_dir}/events.parquet"))
    key = (spark.sparkContext.applicationId, sf_dir, *files)
    if key not in _staged:
        _staged[key] = stage_events(spark, sf_dir)
    return _staged[key]


def stage_events(spark: SparkSession, sf_dir: str) -> Topic:
    created = new_input_topic(spark, producers=("clients", "servers"))
    rows = event_rows(spark, sf_dir)
    from_clients = F.col("event_type").isin("click", "view")
    append_topic(input_records(rows.where(from_clients), created), created, producer="clients")
    append_topic(input_records(rows.where(~from_clients), created), created, producer="servers")
    return created


def checked_rows(df: DataFrame) -> DataFrame:
    """The sample row map: drop error events, parse the creation time and the payload."""
    return df.where(~F.col("name").endswith("-error")).select(
        "seq",
        "name",
        "age",
        "money",
        F.col("createTime").cast("bigint").alias("createTime"),
        decode_json(F.col("payload"), "k bigint")["k"].alias("k"),
        SYSTEM_TIME,
    )


def checked_transfer() -> Transfer:
    return Transfer(
        source=EVENT_IN,
        sink=EVENT_OUT,
        transform=checked_rows,
        selector=BY_NAME,
        attributes=biz_key_attributes(F.col("name")),
        event_time=event_time_from_millis(F.col("createTime")),
        system_time=F.col(SYSTEM_TIME),
    )


def transfer_events(spark: SparkSession, sf_dir: str) -> tuple[Topic, Totals]:
    """Run the sample job as a stream over the staged topic, under a new subscription into a new topic.

    Returns that topic and the run's counters.
    """
    source = staged_events(spark, sf_dir)
    run = uuid.uuid4().hex
    sink = create_topic(spark, source.root, f"{PROJECT}-{run}", EVENT_OUT)
    props = {
        ROOT: source.root,
        DEFAULT_PROJECT: PROJECT,
        SOURCE_TOPIC: source.name,
        SOURCE_SUBSCRIPTION: f"checker-{run}",
        SINK_PROJECT: sink.project,
        SINK_TOPIC: sink.name,
    }
    query = start_transfer(spark, props, checked_transfer(), available_now=True)
    return sink, Totals(query).follow()
