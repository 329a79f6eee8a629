"""Topic creation and lookup.

Layout under the root, on any file system Spark can reach::

    <root>/<project>/<topic>/descriptor/                          one JSON row
    <root>/<project>/<topic>/producers/<n>                        names one that was added later
    <root>/<project>/<topic>/versions/<n>                         columns since a change, see alter_topic
    <root>/<project>/<topic>/data/<producer>/arrival_date=<day>/shard_id=<k>/*.parquet
    <root>/<project>/<topic>/streams/<producer>                   checkpoint of the stream that writes it, if one does
    <root>/_subscriptions/<project>/<topic>/<subscription>/       streaming checkpoint

Each producer is one writing job with a folder of its own, because a streaming file sink keeps its commit log
per folder. A reading query is a union over the producers it found when it started, in the order in which they were
declared. Declare spare ones where you can: one that never writes costs one folder listing. One that
:func:`add_producer` adds later is seen by queries that start under a new subscription; a query that goes on from a
checkpoint of fewer producers is refused by Spark, so nothing is left out without a word.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicstream import storage
from topicstream.options import DEFAULT_PRODUCER
from topicstream.schema import (
    ARRIVAL_DATE,
    ATTRIBUTES,
    DEFAULT_LIFECYCLE_DAYS,
    EVENT_TIME,
    SHARD_ID,
    SYSTEM_TIME,
    TopicDef,
    type_name,
)

DEFAULT_MAX_RECORDS_PER_FILE = 1_000_000

_ENVELOPE = (
    T.StructField(ATTRIBUTES, T.MapType(T.StringType(), T.StringType())),
    T.StructField(SYSTEM_TIME, T.TimestampType()),
    T.StructField(ARRIVAL_DATE, T.DateType()),
    T.StructField(SHARD_ID, T.StringType()),
)
_RESERVED = {f.name for f in _ENVELOPE}
_DESCRIPTOR = (
    "name string, shard_num int, lifecycle_days int, comment string, schema string,"
    " producers array<string>, max_records_per_file bigint"
)


@dataclass(frozen=True)
class Topic:
    """A created topic: where it lives and what its records look like."""

    root: str
    project: str
    name: str
    shard_num: int
    lifecycle_days: int
    comment: str
    schema: T.StructType
    producers: tuple[str, ...]
    max_records_per_file: int

    @classmethod
    def of(
        cls,
        root: str,
        project: str,
        definition: TopicDef,
        need_event_time: bool = True,
        *,
        lifecycle_days: int = DEFAULT_LIFECYCLE_DAYS,
        producers: Sequence[str] = (DEFAULT_PRODUCER,),
        max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    ) -> Topic:
        """The topic a declaration describes, without creating it.

        ``max_records_per_file`` bounds every file any producer writes. Reading is admitted by whole files, so it
        is also the step in which :func:`topicstream.read_topic` can limit its rate.
        """
        if not producers or len(set(producers)) != len(producers):
            raise ValueError(f"producers must be one or more different names, got {list(producers)}")
        _check_names((project, definition.name, *producers))
        if max_records_per_file < 1 or lifecycle_days < 1:
            raise ValueError("max_records_per_file and lifecycle_days must be positive")
        schema = definition.to_struct(need_event_time)
        clash = sorted(_RESERVED & set(schema.fieldNames()))
        if clash:
            raise ValueError(f"topic {definition.name} declares reserved columns {clash}")
        return cls(
            root=root,
            project=project,
            name=definition.name,
            shard_num=definition.shard_num,
            lifecycle_days=lifecycle_days,
            comment=definition.comment,
            schema=schema,
            producers=tuple(producers),
            max_records_per_file=max_records_per_file,
        )

    @property
    def record_schema(self) -> T.StructType:
        """Columns of a stored record: the topic's fields, then attributes, arrival time, its day, and shard."""
        return T.StructType([*self.schema.fields, *_ENVELOPE])

    @property
    def path(self) -> str:
        return topic_path(self.root, self.project, self.name)

    def producer_path(self, producer: str) -> str:
        if producer not in self.producers:
            raise ValueError(f"topic {self.name} has no producer {producer!r}, only {list(self.producers)}")
        return storage.join(self.path, "data", producer)

    def claim_path(self, producer: str) -> str:
        """File that names the checkpoint of the stream a producer belongs to, once it belongs to one."""
        self.producer_path(producer)
        return storage.join(self.path, "streams", producer)

    def subscription_path(self, subscription: str) -> str:
        """Where the read position of a named subscription is kept: the reading query's checkpoint."""
        if not subscription.strip() or "/" in subscription:
            raise ValueError(f"not usable as a subscription name: {subscription!r}")
        return storage.join(self.root, "_subscriptions", self.project, self.name, subscription)


def topic_path(root: str, project: str, name: str) -> str:
    return storage.join(root, project, name)


def create_topic(
    spark: SparkSession, root: str, project: str, definition: TopicDef, need_event_time: bool = True, **settings
) -> Topic:
    """Create a topic from its declaration. An existing topic is left alone and raises ``ValueError``.

    ``settings`` are those of :meth:`Topic.of`.
    """
    created = Topic.of(root, project, definition, need_event_time, **settings)
    descriptor = storage.join(created.path, "descriptor")
    if storage.exists(spark, descriptor):
        raise ValueError(f"topic {project}/{definition.name} exists already")
    for producer in created.producers:
        storage.make_dir(spark, created.producer_path(producer))
    # The descriptor comes last: a topic exists once it can be opened.
    row = spark.range(0, 1, 1, 1).select(
        F.lit(created.name).alias("name"),
        F.lit(created.shard_num).alias("shard_num"),
        F.lit(created.lifecycle_days).alias("lifecycle_days"),
        F.lit(created.comment).alias("comment"),
        F.lit(created.schema.json()).alias("schema"),
        F.array(*map(F.lit, created.producers)).alias("producers"),
        F.lit(created.max_records_per_file).cast("bigint").alias("max_records_per_file"),
    )
    row.write.mode("error").json(descriptor)
    return created


def open_topic(spark: SparkSession, root: str, project: str, name: str) -> Topic:
    """Look up a created topic. Its schema and shards are read once; a job keeps what it saw when it started."""
    descriptor = storage.join(topic_path(root, project, name), "descriptor")
    if not storage.exists(spark, descriptor):
        raise ValueError(f"topic {project}/{name} does not exist under {root}")
    row = spark.read.schema(_DESCRIPTOR).json(descriptor).first()
    added = _numbered(spark, storage.join(topic_path(root, project, name), "producers"))
    # Before there were plain numbers, the file's name held the producer's.
    added = [number.partition("-")[2] or content for number, content in added]
    versions = _numbered(spark, storage.join(topic_path(root, project, name), "versions"))
    return Topic(
        root=root,
        project=project,
        name=row.name,
        shard_num=row.shard_num,
        lifecycle_days=row.lifecycle_days,
        comment=row.comment,
        schema=T.StructType.fromJson(json.loads(versions[-1][1] if versions else row.schema)),
        producers=(*row.producers, *added),
        max_records_per_file=row.max_records_per_file,
    )


def add_producer(spark: SparkSession, topic: Topic, producer: str) -> Topic:
    """Let one more job write to a topic. Returns the topic as it is then; jobs that have it open do not change."""
    now = open_topic(spark, topic.root, topic.project, topic.name)
    if producer in now.producers:
        raise ValueError(f"topic {topic.name} has a producer {producer!r} already")
    _check_names([producer])
    storage.make_dir(spark, storage.join(now.path, "data", producer))
    _add_numbered(spark, storage.join(now.path, "producers"), producer)
    return open_topic(spark, topic.root, topic.project, topic.name)


def alter_topic(spark: SparkSession, topic: Topic, definition: TopicDef) -> Topic:
    """Give a topic the columns of a new declaration from now on, and return it as it is then.

    Every record keeps the columns it was written with. Who reads the topic as it is now gets them by name: null where a
    record is older than the column, and without those that are gone. A column keeps its type for good, also one that
    was gone and comes back, so no file ever disagrees with a reader. Jobs that have the topic open go on with
    the columns they know. Shards, name and the event time stay.
    """
    if (definition.name, definition.shard_num) != (topic.name, topic.shard_num):
        raise ValueError(f"topic {topic.name} keeps its name and its {topic.shard_num} shards")
    now = open_topic(spark, topic.root, topic.project, topic.name)
    schema = definition.to_struct(EVENT_TIME in now.schema.fieldNames())
    clash = sorted(_RESERVED & set(schema.fieldNames()))
    if clash:
        raise ValueError(f"topic {definition.name} declares reserved columns {clash}")
    known = {f.name: f.dataType for version in topic_versions(spark, now) for f in version}
    other = [f"{f.name} {type_name(known[f.name])}" for f in schema if known.get(f.name, f.dataType) != f.dataType]
    if other:
        raise ValueError(f"columns of topic {topic.name} keep their types: {other}")
    _add_numbered(spark, storage.join(now.path, "versions"), schema.json())
    return open_topic(spark, topic.root, topic.project, topic.name)


def topic_versions(spark: SparkSession, topic: Topic) -> list[T.StructType]:
    """The columns a topic has had, from its creation to now."""
    row = spark.read.schema(_DESCRIPTOR).json(storage.join(topic.path, "descriptor")).first()
    later = [content for _, content in _numbered(spark, storage.join(topic.path, "versions"))]
    return [T.StructType.fromJson(json.loads(text)) for text in (row.schema, *later)]


def _numbered(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Small files named by numbers, in their order, with what they hold."""
    names = storage.list_names(spark, folder)
    return [(name, storage.read_text(spark, storage.join(folder, name)) or "") for name in names]


def _add_numbered(spark: SparkSession, folder: str, text: str) -> None:
    # The number alone is the name: of two jobs that add at the same time, the second finds it taken and fails.
    taken = len(storage.list_names(spark, folder))
    storage.create_text(spark, storage.join(folder, f"{taken:06d}"), text)


def _check_names(names: Sequence[str]) -> None:
    bad = [n for n in names if not n.strip() or n[0] in "_." or set(n) & set("/=")]
    if bad:
        raise ValueError(f"not usable as names of projects, topics or producers: {bad}")


def describe_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """One row per field of the topic: position, field, type, comment."""
    rows = [
        (position, field.name, type_name(field.dataType), field.metadata.get("comment", ""))
        for position, field in enumerate(topic.schema.fields)
    ]
    return spark.createDataFrame(rows, "position int, field string, type string, comment string")


def list_shards(topic: Topic) -> list[str]:
    """The topic's shard ids. A topic without shards cannot be written to and raises."""
    if topic.shard_num < 1:
        raise ValueError(f"topic {topic.name} has no shards")
    return [str(shard) for shard in range(topic.shard_num)]


def shards_frame(spark: SparkSession, topic: Topic) -> DataFrame:
    """The topic's shards as a DataFrame with one ``shard_id`` column."""
    return spark.range(len(list_shards(topic))).selectExpr(f"cast(id as string) as {SHARD_ID}")
