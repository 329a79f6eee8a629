"""The job this package exists for: read a topic, map its rows, write them to another topic."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from topicstream.functions.codec import decode_record
from topicstream.operators.metrics import with_sink_metrics, with_source_metrics
from topicstream.operators.routing import Selector
from topicstream.options import COMMIT_INTERVAL_SECONDS, sink_options, source_options
from topicstream.schema import SYSTEM_TIME, TopicDef
from topicstream.sources.bounded import append_topic, read_topic_batch
from topicstream.sources.records import prepare_records
from topicstream.sources.topics import Topic, open_topic
from topicstream.streaming.records import read_topic_records
from topicstream.streaming.sink import write_topic
from topicstream.streaming.source import read_topic, shortest_interval

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Transfer:
    """Source rows -> ``transform`` -> sink records, with the user's hooks.

    ``transform`` gets the typed columns of ``source`` plus the record columns in ``keep``. It returns the
    typed columns of ``sink``, and may return the ``keep`` columns for the hooks to use; those are not written.
    ``selector``, ``attributes``, ``event_time`` and ``system_time`` are expressions over what it returns.
    ``decode`` replaces the declared decoding for records that need another.
    """

    source: TopicDef
    sink: TopicDef
    transform: Transform
    selector: Selector
    attributes: Column | None = None
    event_time: Column | None = None
    system_time: Column | None = None
    keep: tuple[str, ...] = (SYSTEM_TIME,)
    decode: Transform | None = None

    def records(self, source_records: DataFrame, sink_topic: Topic) -> DataFrame:
        """Sink records from source records, bounded or streaming, in one narrow plan."""
        if self.decode is None:
            typed = decode_record(source_records, self.source, self.keep)
        else:
            typed = source_records.transform(self.decode)
        return prepare_records(
            typed.transform(self.transform),
            sink_topic,
            self.selector,
            definition=self.sink,
            attributes=self.attributes,
            event_time=self.event_time,
            system_time=self.system_time,
            carry=self.keep,
        )


def start_transfer(
    spark: SparkSession,
    props: Mapping[str, str],
    transfer: Transfer,
    *,
    interval_seconds: float = COMMIT_INTERVAL_SECONDS,
    slots: int | None = None,
    available_now: bool = False,
    exact_rate: bool = False,
    **writing,
) -> StreamingQuery:
    """Start the job as a stream under the source's subscription, with metrics, and return the running query.

    With ``sink.batchEnable`` it commits every ``interval_seconds``, without it as often as the rate lets it read a
    file. The rate is kept by the bytes of whole files, or with ``exact_rate`` by records
    (see :func:`topicstream.read_topic_records`). ``writing`` is passed on to :func:`topicstream.write_topic`.
    """
    source, sink = source_options(props), sink_options(props)
    source_topic = open_topic(spark, source.root, source.project, source.topic)
    sink_topic = open_topic(spark, sink.root, sink.project, sink.topic)
    # A row map gives at most one record for each it reads, so the sink's rate is kept by admitting no more.
    rate = min(source.rate, sink.rate or source.rate)
    if not sink.batch_enable:
        interval_seconds = shortest_interval(spark, source_topic, rate, slots)
    reading = {"rate": rate, "interval_seconds": interval_seconds, "slots": slots}
    if exact_rate:
        stream = read_topic_records(spark, source_topic, source.subscription, **reading)
    else:
        stream = read_topic(spark, source_topic, **reading)
    records = transfer.records(with_source_metrics(stream), sink_topic)
    return write_topic(
        with_sink_metrics(records),
        sink_topic,
        checkpoint=source_topic.subscription_path(source.subscription),
        producer=sink.producer,
        interval_seconds=interval_seconds,
        available_now=available_now,
        **writing,
    )


def run_transfer(
    spark: SparkSession, props: Mapping[str, str], transfer: Transfer, *, compact: bool = True
) -> None:
    """Run the job once over all the source topic holds, for backfills. It moves no subscription.

    ``compact`` is that of :func:`topicstream.append_topic`.
    """
    source = source_options(props)
    sink = sink_options(props)
    source_topic = open_topic(spark, source.root, source.project, source.topic)
    sink_topic = open_topic(spark, sink.root, sink.project, sink.topic)
    records = transfer.records(read_topic_batch(spark, source_topic), sink_topic)
    append_topic(records, sink_topic, producer=sink.producer, compact=compact)
