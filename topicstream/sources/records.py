"""Typed rows to stored records, the same for bounded and streaming writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.functions.codec import attributes_or_none, encode_payload, field_aliases, quoted
from topicstream.operators.routing import Selector, place
from topicstream.operators.retention import utc_day
from topicstream.schema import ARRIVAL_DATE, SHARD_ID, SYSTEM_TIME, TopicDef
from topicstream.sources.bounded import need_event_time
from topicstream.sources.topics import Topic, list_shards


def prepare_records(
    df: DataFrame,
    topic: Topic,
    selector: Selector,
    *,
    definition: TopicDef | None = None,
    attributes: Column | None = None,
    event_time: Column | None = None,
    system_time: Column | None = None,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Encode rows for a topic and give each a shard.

    The payload is the fields of ``definition`` under their aliases, or without one every column by its own name.
    Columns in ``carry`` are there for the expressions only and are not written; any other column that is not
    declared, or not on the topic, raises. ``attributes`` and ``event_time`` are expressions over ``df`` as in
    :func:`topicstream.encode_record`, ``system_time`` is the arrival time, by default the time of writing.
    All of it is one narrow projection. The day of the arrival, in UTC, is a folder level of the topic; a record
    without an arrival time has none.
    """
    need_event_time(topic)
    names = [c for c in df.columns if c not in set(carry)]
    alias = {c: c for c in names} if definition is None else field_aliases(names, definition)
    columns = {alias[c]: F.col(quoted(c)) for c in names}
    arrival = (F.current_timestamp() if system_time is None else system_time).cast("timestamp")
    return df.select(
        *encode_payload(df, columns, topic.schema, event_time),
        attributes_or_none(attributes),
        arrival.alias(SYSTEM_TIME),
        utc_day(arrival).alias(ARRIVAL_DATE),
        place(list_shards(topic), selector).alias(SHARD_ID),
    )
